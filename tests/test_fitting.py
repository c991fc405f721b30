"""Statistics fitted from one pass, against the stages fitted one after the other."""

from __future__ import annotations

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from wardflow.operators import encode as E
from wardflow.operators import features as FE
from wardflow.operators.fitting import fit_together
from wardflow.operators.impute import EncounterImputer
from wardflow.plans.pipeline import preparation_pipeline, preparation_stages
from wardflow.plans.queries import cleaned, feature_roles_of
from wardflow.schema import KEY, LABEL, MEDICATION_COLUMNS, NUMERIC_COLUMNS, RAW_COLUMNS


def encounters(spark, n: int, blank: bool = False):
    """Rows with ties, missing tokens, NULLs, repeated and absent keys and letters beyond 16 bits; ``blank``: a column without a value."""
    def column(i, c):
        k = F.pmod(F.hash("id", F.lit(i)), F.lit(7))
        if c == KEY:
            return F.when(k < 6, (F.col("id") % (n // 2 + 1)).cast("string"))
        if c in NUMERIC_COLUMNS or c == "time_in_hospital":
            return F.when(k < 5, (k + 1).cast("string")).when(k < 6, F.lit("?")).otherwise(F.lit("x"))
        if c == "readmitted":
            return F.element_at(F.array(F.lit("NO"), F.lit("<30"), F.lit(">30"), F.lit("other"), F.lit(None)), (k % 5 + 1).cast("int"))
        if blank and c == MEDICATION_COLUMNS[3]:
            return F.lit("?")
        if c.startswith("diag_"):
            return F.element_at(F.array(*map(F.lit, ["250.1", "V45", "E9", "428", None, "?", "5"])), (k + 1).cast("int"))
        return F.element_at(F.array(*map(F.lit, ["b", "a", "\U0001f600", "ａ", None, "?", "b"])), (k + 1).cast("int"))

    return spark.range(n).select(*[column(i, c).alias(c) for i, c in enumerate(RAW_COLUMNS)])


@pytest.mark.parametrize("flow", [{}, {"strict": True, "categories": ["diag_1"]}])
def test_preparation_equals_stages_fitted_alone(spark, flow):
    raw = encounters(spark, 400).cache()
    one = preparation_pipeline(raw, **flow)
    by_pass, by_stage = one.fit(raw), Pipeline(stages=one.getStages()).fit(raw)
    assert by_pass.stages[1].fill_values() == by_stage.stages[1].fill_values()
    assert by_pass.stages[4].labelsArray == by_stage.stages[4].labelsArray
    assert sorted(map(str, by_pass.transform(raw).select(KEY, LABEL, "classWeight", E.FEATURES).collect())) == \
        sorted(map(str, by_stage.transform(raw).select(KEY, LABEL, "classWeight", E.FEATURES).collect()))


@pytest.mark.parametrize("blank", [False, True])
def test_indexer_equals_the_fit_on_filled_rows(spark, blank):
    c = cleaned(encounters(spark, 300, blank)).cache()
    cats = feature_roles_of(FE.engineer_rows(c))["categorical"]
    alone = EncounterImputer().fit(c)
    rows = FE.engineer_rows(alone.transform(c))
    together = fit_together(c, FE.engineer_rows, cats)
    assert together.indexer.labelsArray == E.index_categories(cats).fit(rows).labelsArray
    assert together.imputer.fill_values() == alone.fill_values()
    assert (together.n_positive, together.n_negative) == (c.where("label = 1").count(), c.where("label = 0").count())


def test_preparation_is_fitted_from_one_pass(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    base = encounters(spark, 200)
    raw = base.mapInArrow(count, base.schema)
    preparation_pipeline(raw).fit(raw)
    assert seen.value == 200  # before: one pass each for means, modes, class counts and indexes


def test_too_many_categories_fail(spark):
    raw = encounters(spark, 100)
    with pytest.raises(ValueError, match="race"):
        preparation_pipeline(raw, max_categories=2).fit(raw)
    with pytest.raises(ValueError, match="labelled"):
        preparation_pipeline(raw).fit(raw.limit(0))


def test_records_without_a_label(spark):
    raw = encounters(spark, 100).drop("readmitted")
    model = preparation_pipeline(raw).fit(raw)
    assert model.transform(raw).count() == 100 and len(preparation_stages()) == 4
