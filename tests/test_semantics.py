"""Semantic traps on tiny frames."""

import math
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from wardflow.operators import clean as C
from wardflow.operators import evaluate as EV
from wardflow.operators import features as FE
from wardflow.operators import profile as P
from wardflow.operators.encode import index_categories, one_hot
from wardflow.operators.impute import EncounterImputer, EncounterImputerModel
from wardflow.operators.score import split_valid, validate_records
from wardflow.operators.split import hash_split
from wardflow.schema import RECORD_FIELDS
from wardflow.sources.files import read_code_maps


def test_null_tokens_only_touch_strings(spark):
    df = spark.createDataFrame([("?", 1, "a"), ("x", 2, "?")], "s string, n int, t string")
    out = C.null_tokens(df).collect()
    assert out[0]["s"] is None and out[0]["n"] == 1 and out[1]["t"] is None


def test_binary_label_null_is_positive_and_strict_drops(spark):
    df = spark.createDataFrame([("NO",), ("<30",), (">30",), (None,), ("X",)], "readmitted string")
    binary = [r.label for r in C.binary_label(df).collect()]
    assert binary == [0.0, 1.0, 1.0, 1.0, 1.0]
    strict = [r.label for r in C.strict_label(df).collect()]
    assert strict == [0.0, 1.0, 1.0]
    assert "readmitted" not in C.binary_label(df).columns


def test_cast_numeric_lenient_and_strict(spark):
    df = spark.createDataFrame([("5",), ("five",), (None,)], "time_in_hospital string")
    assert [r[0] for r in C.cast_numeric(df, ["time_in_hospital"]).collect()] == [5, None, None]
    with pytest.raises(Exception):
        C.cast_numeric(df, ["time_in_hospital"], strict=True).collect()


def test_int_mean_fill_truncates_and_mode_ignores_nulls_ties_lowest(spark):
    df = spark.createDataFrame(
        [(1, "b"), (2, "a"), (None, None), (None, None), (None, None), (5, "b"), (3, "a")], "n int, c string")
    model = EncounterImputer(numericCols=["n"], categoricalCols=["c"]).fit(df)
    fills = model.fill_values()
    assert fills["n"] == 2          # mean 2.75 -> 2, as an int cast would do
    assert fills["c"] == "a"        # 'a' and 'b' tie at 2; NULL (3 rows) is never the mode
    out = model.transform(df).collect()
    assert [r.n for r in out] == [1, 2, 2, 2, 2, 5, 3]
    assert all(r.c is not None for r in out)


def test_all_null_column_gets_no_fill(spark):
    df = spark.createDataFrame([(None, None)], "n int, c string")
    model = EncounterImputer(numericCols=["n"], categoricalCols=["c"]).fit(df)
    assert model.fill_values() == {}
    assert model.transform(df).first().n is None


def test_imputer_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (None, None)], "n int, c string")
    model = EncounterImputer(numericCols=["n"], categoricalCols=["c"]).fit(df)
    model.write().overwrite().save(str(tmp_path / "imp"))
    loaded = EncounterImputerModel.load(str(tmp_path / "imp"))
    assert loaded.fill_values() == model.fill_values()


@pytest.mark.parametrize("code,expected", [
    ("250.02", "Diabetes"), ("428", "Circulatory"), ("785", "Circulatory"), ("5", "Respiratory"),
    ("54", "Digestive"), ("9", "Injury"), ("6", "Genitourinary"), ("2", "Neoplasms"), ("459.81", "Other"),
    ("V45", "Other"), ("715", "Musculoskeletal"), (None, "Other"),
])
def test_diag_category_is_lexical(spark, code, expected):
    df = spark.createDataFrame([(code,)], "diag_1 string")
    assert FE.diagnosis_category(df).first()["diag_1_category"] == expected


def test_diag_category_numeric_option(spark):
    df = spark.createDataFrame([("5",), ("459.81",), ("V45",)], "diag_1 string")
    got = [r.diag_1_category for r in FE.diagnosis_category(df, semantics="numeric").collect()]
    assert got == ["Other", "Circulatory", "Other"]


def test_diag_groups(spark):
    df = spark.createDataFrame([("V57",), ("E909",), ("250.83",), ("5",), (None,)], "diag_1 string")
    got = [r.diag_1_group for r in FE.diagnosis_groups(df, ["diag_1"]).collect()]
    assert got == ["V_Code", "E_Code", "250", "5", "UNK"]


def test_comorbidity_counts_each_group_once(spark):
    df = spark.createDataFrame([("250", "250", "428"), ("UNK", "UNK", "UNK"), ("414", "401", "585")],
                               "diag_1_group string, diag_2_group string, diag_3_group string")
    assert [r.comorbidity_count for r in FE.comorbidity_count(df).collect()] == [2, 0, 3]


def test_zero_stay_ratio_is_null(spark):
    df = spark.createDataFrame([(0, 10, 3, 1), (4, 10, 3, 2)],
                               "time_in_hospital int, num_lab_procedures int, num_medications int, num_procedures int")
    out = FE.per_day_ratios(df).collect()
    assert out[0].labs_per_day is None and out[1].labs_per_day == 2.5
    assert FE.per_day_ratios(df, default=0.0).first().meds_per_day == 0.0


def test_change_score(spark):
    df = spark.createDataFrame([("Up", "Down", "No"), ("Steady", None, "Up")], "a string, b string, c string")
    assert [r.med_change_score for r in FE.change_score(df, ["a", "b", "c"]).collect()] == [2, 1]


def test_class_weights(spark):
    df = spark.createDataFrame([(0.0,), (0.0,), (0.0,), (1.0,)], "label double")
    w = {r.label: r.classWeight for r in FE.class_weights(df).collect()}
    assert w == {0.0: 0.25, 1.0: 0.75}


def test_unseen_and_null_category_become_zero_vector(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",)], "c string")
    test = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "c string")
    idx = index_categories(["c"]).fit(train)
    enc = one_hot(["c"]).fit(idx.transform(train))
    rows = enc.transform(idx.transform(test)).select(vector_to_array("c_vec").alias("v")).collect()
    assert [list(r.v) for r in rows] == [[1.0, 0.0], [0.0, 1.0], [0.0, 0.0], [0.0, 0.0]]


def test_string_index_ties_alphabetical(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "x string")
    model = index_categories(["x"]).fit(df)
    assert model.labelsArray[0] == ["c", "a", "b"]


def test_f1_positive_vs_weighted(spark):
    # tp=1, fp=1, fn=1, tn=1 -> both F1 = 0.5; make it asymmetric
    rows = [(1.0, 1.0)] * 3 + [(1.0, 0.0)] * 1 + [(0.0, 1.0)] * 2 + [(0.0, 0.0)] * 4
    df = spark.createDataFrame(rows, "label double, prediction double")
    m = EV.class_metrics(df).first()
    assert (m.tp, m.fp, m.fn, m.tn) == (3, 2, 1, 4)
    assert m.recall == 0.75 and m.precision == 0.6
    assert math.isclose(m.f1_positive, 6 / 9)
    f1n = 8 / 11
    assert math.isclose(m.f1_weighted, (4 * 6 / 9 + 6 * f1n) / 10)


def test_confusion_matrix(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 0.0), (0.0, 0.0), (0.0, 0.0)], "label double, prediction double")
    got = {r.label: (r.pred_0, r.pred_1) for r in EV.confusion_matrix(df).collect()}
    assert got == {0.0: (2, 0), 1.0: (1, 1)}


@pytest.mark.parametrize("ranges", [1, 7, None])
def test_auc_matches_mllib_exact(spark, ranges):
    rnd = random.Random(7)
    rows = []
    for _ in range(400):
        s = rnd.randint(0, 40) / 4.0           # many ties
        y = 1.0 if rnd.random() < 0.2 + s / 20 else 0.0
        rows.append((s, y))
    df = spark.createDataFrame(rows, "score double, label double")
    got = EV.auc(df, "score", ranges=ranges).first().auc
    vec = df.select(array_to_vector(F.array(-F.col("score"), F.col("score"))).alias("rawPrediction"), "label")
    expected = BinaryClassificationEvaluator(numBins=0).evaluate(vec)
    assert math.isclose(got, expected, rel_tol=1e-12)


@pytest.mark.parametrize("ranges", [1, 3])
def test_auc_nan_null_and_one_class(spark, ranges):
    nan = float("nan")
    df = spark.createDataFrame([(0.1, 0.0), (0.2, 1.0), (nan, 1.0), (nan, 0.0), (None, 1.0), (0.3, None), (None, None)], "score double, label double")
    r = EV.auc(df, "score", ranges=ranges).first()
    # NaN is the highest score: of the pairs (0.2, 0.1), (0.2, NaN), (NaN, 0.1), (NaN, NaN) two and a half are right
    assert (r.auc, r.n_pos, r.n_neg, r.n_dropped) == (2.5 / 4, 2, 2, 3)
    one = EV.auc(df.where("label = 1.0"), "score", ranges=ranges).first()
    assert (one.auc, one.n_pos, one.n_neg, one.n_dropped) == (None, 2, 0, 1)
    none = EV.auc(df.where("false"), "score", ranges=ranges).first()
    assert (none.auc, none.n_pos, none.n_neg, none.n_dropped) == (None, 0, 0, 0)


def test_summary_counts_like_the_rows(spark):
    rows = [(0.9, 1.0, 1.0), (None, 0.0, 0.0), (0.2, 0.0, 0.0), (0.3, None, 1.0), (0.4, 1.0, None), (0.5, 0.0, 1.0), (None, 1.0, 0.0)]
    df = spark.createDataFrame(rows, "score double, label double, prediction double")
    summary = EV.score_summary(df, "score", prediction="prediction")
    assert EV.class_metrics_from_summary(summary).first() == EV.class_metrics(df).first()
    assert {tuple(r) for r in EV.confusion_from_summary(summary).collect()} == {tuple(r) for r in EV.confusion_matrix(df.where("label is not null")).collect()}


def test_hash_split_loses_no_row(spark):
    from wardflow.operators.split import hash_folds, hash_split_frames

    df = spark.createDataFrame([("a",), (None,), ("b",), (None,)], "encounter_id string")
    train, test = hash_split_frames(df)
    assert train.count() + test.count() == 4 and test.where("encounter_id is null").count() == 2
    assert hash_split(df).where("encounter_id is null and split = 'test'").count() == 2
    assert hash_folds(df).where("fold is null").count() == 0


def test_validate_typed_table(spark):
    typed = spark.createDataFrame([("1", "Caucasian", 5), ("2", "Other", None)], "encounter_id string, race string, time_in_hospital int")
    reasons = {r.encounter_id: r.reason for r in validate_records(typed, ["race", "time_in_hospital"], ["time_in_hospital"]).collect()}
    assert reasons == {"1": None, "2": "missing:time_in_hospital"}


def test_shared_dir_needs_a_shared_folder(monkeypatch):
    from types import SimpleNamespace

    from wardflow import session

    def fake(master):
        sc = SimpleNamespace(master=master, getConf=lambda: SimpleNamespace(get=lambda k, d=None: None), getCheckpointDir=lambda: None,
                             setCheckpointDir=lambda p: None)
        return SimpleNamespace(sparkContext=sc)

    for master in ("yarn", "spark://host:7077", "k8s://host", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.shared_dir(fake(master))
    assert session.shared_dir(fake("local[4]"))


def test_code_maps_from_a_zip(tmp_path):
    """The packaged map is readable where the package is a zip, as ``--py-files`` leaves it."""
    import os
    import subprocess
    import sys
    import zipfile

    import wardflow

    root = os.path.dirname(wardflow.__file__)
    with zipfile.ZipFile(tmp_path / "wardflow.zip", "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith((".py", ".csv")):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    code = "import wardflow; from wardflow.sources.files import code_map_text as t; print('.zip' in wardflow.__file__, len(t()) > 1000)"
    out = subprocess.run([sys.executable, "-c", code], env={**os.environ, "PYTHONPATH": str(tmp_path / "wardflow.zip")}, cwd=tmp_path,
                         capture_output=True, text=True, check=True)
    assert out.stdout.split() == ["True", "True"]


def test_hash_split_independent_of_partitioning(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("encounter_id"))
    ref = None
    for n in (1, 4, 16):
        got = sorted((r.encounter_id, r.split) for r in hash_split(df.repartition(n)).collect())
        ref = ref or got
        assert got == ref
    share = sum(1 for _, s in ref if s == "train") / len(ref)
    assert 0.75 < share < 0.85


def test_validate_records(spark):
    good = {c: "No" for c in RECORD_FIELDS}
    good.update({"time_in_hospital": "5", "num_lab_procedures": "40", "num_procedures": "1",
                 "num_medications": "?", "number_outpatient": "0", "number_emergency": "0",
                 "number_inpatient": "0", "number_diagnoses": "8", "race": "?"})
    bad = dict(good, time_in_hospital="five", gender=None)
    schema = ", ".join(f"`{c}` string" for c in ["encounter_id", *RECORD_FIELDS])
    df = spark.createDataFrame([{"encounter_id": "1", **good}, {"encounter_id": "2", **bad}], schema)
    out = {r.encounter_id: r for r in validate_records(df).collect()}
    assert out["1"].is_valid and out["1"].reason is None and out["1"].n_missing_tokens == 2
    assert not out["2"].is_valid
    assert set(out["2"].reason.split(";")) == {"missing:gender", "not_integer:time_in_hospital"}
    only_two = spark.createDataFrame([("1", "Caucasian", "five")], "encounter_id string, race string, time_in_hospital string")
    ok, rejects = split_valid(only_two)
    assert ok.count() == 0 and rejects.count() == 1


def test_code_map_parser(spark):
    maps = {(r.map_name, r.code): r.description for r in read_code_maps(spark).collect()}
    assert maps[("admission_type_id", "6")] == "NULL"              # text NULL kept
    assert maps[("admission_source_id", "1")] == "Physician Referral"  # leading blank trimmed
    assert maps[("discharge_disposition_id", "19")] == "Expired at home. Medicaid only, hospice."
    assert ("admission_source_id", "16") not in maps
    assert ("discharge_disposition_id", "30") in maps and ("discharge_disposition_id", "27") in maps
    assert {m for m, _ in maps} == {"admission_type_id", "discharge_disposition_id", "admission_source_id"}
    assert len(maps) == 8 + 30 + 25


def test_missing_profile_and_modes(spark):
    df = spark.createDataFrame([("a", None), ("a", "x"), (None, "y"), ("b", "y")], "p string, q string")
    prof = {r.column_name: (r.n_missing, r.missing_pct) for r in P.missing_profile(df).collect()}
    assert prof == {"p": (1, 25.0), "q": (1, 25.0)}
    modes = {r.column_name: (r.mode_value, r.mode_count) for r in P.column_modes(df, ["p", "q"]).collect()}
    assert modes == {"p": ("a", 2), "q": ("y", 2)}


def test_full_tuning_grids_build(spark):
    from wardflow.operators import models as M

    rf_grid = M.param_grid(M.forest(), {"maxDepth": [5, 10, 15], "numTrees": [50, 100], "minInstancesPerNode": [10, 20]})
    gbt_grid = M.param_grid(M.gbt(), {"maxDepth": [5, 10], "maxIter": [20, 50], "stepSize": [0.1, 0.05],
                                      "minInstancesPerNode": [10, 20]})
    assert len(rf_grid) == 12 and len(gbt_grid) == 16


def test_cardinality_guard(spark):
    from wardflow.operators.encode import check_cardinality

    df = spark.range(500).selectExpr("cast(id as string) as ident", "cast(id % 3 as string) as cat")
    assert check_cardinality(df, ["cat"], max_distinct=10)["cat"] == 3
    with pytest.raises(ValueError, match="ident"):
        check_cardinality(df, ["cat", "ident"], max_distinct=10)


def test_imputer_bounds_categories_in_its_mode_job(spark):
    df = spark.range(300).selectExpr("cast(id as string) as ident", "cast(id % 3 as string) as cat")
    EncounterImputer(numericCols=[], categoricalCols=["cat"], maxCategories=10).fit(df)
    with pytest.raises(ValueError, match="ident"):
        EncounterImputer(numericCols=[], categoricalCols=["cat", "ident"], maxCategories=10).fit(df)
