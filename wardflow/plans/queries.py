"""Registered queries: one per operator of the inventory, each over the whole
``encounters`` table derived from the given ``lineitem``.

Every builder takes ``(spark, enc)`` where ``enc`` is the raw 50-column
encounter frame, and returns a DataFrame whose columns are aliased to match
its SQL twin in ``wardflow.plans.sql_twins``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.operators import clean as C
from wardflow.operators import encode as E
from wardflow.operators import evaluate as EV
from wardflow.operators import features as FE
from wardflow.operators import profile as P
from wardflow.operators import score as S
from wardflow.operators import split as SP
from wardflow.operators.fitting import fit_together
from wardflow.operators.impute import EncounterImputer, impute
from wardflow.operators.lookup import code_usage, decode_ids
from wardflow.schema import (CATEGORICAL_COLUMNS, DIAGNOSIS_COLUMNS, DROP_COLUMNS, KEY, LABEL, MEDICATION_COLUMNS,
                             NUMERIC_COLUMNS, PER_DAY_RATIOS, RAW_COLUMNS, RECORD_FIELDS, WEIGHT, q)
from wardflow.session import scratch_path
from wardflow.sources.files import (read_code_maps, read_confusion, read_encounters, read_encounters_checked, read_metrics, write_confusion,
                                    write_csv, write_metrics)

Query = Callable[[SparkSession, DataFrame], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------------------
# shared derivations
# ---------------------------------------------------------------------------

DROP_NOT_KEY = [c for c in DROP_COLUMNS if c != KEY]


def cleaned(enc: DataFrame) -> DataFrame:
    """``clean`` with the encounter id kept as a pass-through key."""
    return C.clean(enc, drop=DROP_NOT_KEY)


def imputed(enc: DataFrame) -> DataFrame:
    return impute(cleaned(enc))


def feature_rows(enc: DataFrame) -> DataFrame:
    return FE.engineer_rows(imputed(enc))


def feature_table(enc: DataFrame) -> DataFrame:
    return FE.engineer(imputed(enc))


def rule_scored(enc: DataFrame) -> DataFrame:
    """Deterministic rule score for model-free evaluation checks:
    score = comorbidity_count + number_inpatient, prediction = score >= 2.
    Only what it reads is fitted: one mean."""
    f = FE.comorbidity_count(FE.diagnosis_groups(impute(cleaned(enc), ["number_inpatient"], [])))
    s = (F.col("comorbidity_count") + F.col("number_inpatient")).cast("int")
    return f.select(KEY, LABEL, s.alias("score"), (s >= 2).cast("double").alias("prediction"))


def feature_roles_of(df: DataFrame) -> dict[str, list[str]]:
    return C.infer_roles(df.schema, exclude=(LABEL, WEIGHT, KEY))


# ---------------------------------------------------------------------------
# sources / sinks
# ---------------------------------------------------------------------------

@query("scan_csv")
def q_scan_csv(spark, enc):
    """Land the encounter table as a header CSV, then scan it back with the all-string schema."""
    path = write_csv(enc, scratch_path(spark, "encounters-csv"))
    return read_encounters(spark, path)


def faulty_lines(enc: DataFrame) -> DataFrame:
    """Lines of a header CSV, the header first in each partition: of one age band only the first two fields, of another one too many.

    Written as they are, each task makes one file: rows are neither moved nor sorted.
    """
    line = F.to_csv(F.struct(*[F.col(q(c)) for c in enc.columns]))
    line = F.when(F.col("age") == "[50-60)", F.array_join(F.slice(F.split(line, ","), 1, 2), ",")) \
        .when(F.col("age") == "[70-80)", F.concat(line, F.lit(",surplus"))).otherwise(line)
    # the lower 33 bits number a partition's rows from 0
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    rows = enc.select(first.alias("first"), line.alias("value"))
    return rows.select(F.explode(F.when(F.col("first"), F.array(F.lit(",".join(enc.columns)), F.col("value")))
                                 .otherwise(F.array("value"))).alias("value"))


@query("scan_csv_rejects")
def q_scan_csv_rejects(spark, enc):
    """Lines with too few or too many fields come out as rejects, by encounter."""
    path = scratch_path(spark, "faulty-csv")
    faulty_lines(enc).write.text(path)
    rows, rejects = read_encounters_checked(spark, path)
    bad = rejects.select(F.split("line", ",")[0].alias(KEY), "reason")
    return rows.select(KEY, F.lit("").alias("reason")).unionByName(bad)


@query("preview")
def q_preview(spark, enc):
    return P.preview(cleaned(enc), 10, [KEY])


@query("metrics_sink")
def q_metrics_sink(spark, enc):
    r = rule_scored(enc)
    long = EV.metrics_long(EV.auc(r, "score"), EV.class_metrics(r))
    wide = EV.metrics_wide(long, ["areaUnderROC", "recall", "precision"])
    path = write_metrics(wide, scratch_path(spark, "metrics-json"))
    schema = T.StructType([T.StructField(c, T.DoubleType()) for c in ("areaUnderROC", "recall", "precision")])
    return read_metrics(spark, path, schema)


@query("code_maps")
def q_code_maps(spark, enc):
    return code_usage(enc, read_code_maps(spark))


@query("decode_ids")
def q_decode_ids(spark, enc):
    ids = enc.select(KEY, "admission_type_id", "discharge_disposition_id", "admission_source_id")
    return decode_ids(ids, read_code_maps(spark))


# ---------------------------------------------------------------------------
# projections / filters / cleaning
# ---------------------------------------------------------------------------

@query("null_tokens")
def q_null_tokens(spark, enc):
    return C.null_tokens(enc)


@query("drop_columns")
def q_drop_columns(spark, enc):
    return C.drop_columns(enc)


@query("label_binary")
def q_label_binary(spark, enc):
    return C.binary_label(C.null_tokens(enc)).select(KEY, LABEL)


@query("label_strict")
def q_label_strict(spark, enc):
    return C.strict_label(C.null_tokens(enc)).select(KEY, LABEL)


@query("cast_numeric")
def q_cast_numeric(spark, enc):
    return C.cast_numeric(enc).select(KEY, *NUMERIC_COLUMNS)


@query("filter_label")
def q_filter_label(spark, enc):
    return C.filter_label(cleaned(enc), 1.0).select(KEY, LABEL, "time_in_hospital")


@query("drop_null_rows")
def q_drop_null_rows(spark, enc):
    return C.drop_null_rows(C.null_tokens(enc), ["race", "diag_1", "num_medications"]) \
        .select(KEY, "race", "diag_1", "num_medications")


@query("project")
def q_project(spark, enc):
    return C.project(enc, {KEY: KEY, "race": "patient_race", "age": "age_band", "readmitted": "target"})


@query("column_roles")
def q_column_roles(spark, enc):
    """Role of every engineered column (from its type) and its non-NULL count (one scan)."""
    f = feature_table(enc)
    roles = feature_roles_of(f)
    role_of = {**{c: "categorical" for c in roles["categorical"]}, **{c: "numeric" for c in roles["numeric"]},
               LABEL: "label", WEIGHT: "weight", KEY: "key"}
    counts = f.agg(*[F.count(F.col(q(c))).alias(f"__n{i}") for i, c in enumerate(f.columns)])
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(f.schema[c].dataType.simpleString()).alias("data_type"),
                 F.lit(role_of.get(c, "other")).alias("role"), F.col(f"__n{i}").alias("n_non_null"))
        for i, c in enumerate(f.columns)]))
    return counts.select(rows.alias("r")).select("r.*")


@query("clean_encounters")
def q_clean_encounters(spark, enc):
    return cleaned(enc)


@query("fill_constant")
def q_fill_constant(spark, enc):
    filled = C.fill_constant(C.null_tokens(enc), {"race": "Other", "diag_1": "UNK", "num_medications": "0"})
    return filled.select(KEY, "race", "diag_1", "num_medications")


# ---------------------------------------------------------------------------
# profiling aggregates
# ---------------------------------------------------------------------------

@query("row_count")
def q_row_count(spark, enc):
    return P.row_count(enc)


@query("missing_profile")
def q_missing_profile(spark, enc):
    return P.missing_profile(C.null_tokens(enc))


@query("distinct_values")
def q_distinct_values(spark, enc):
    return P.distinct_values(enc, "readmitted")


@query("value_counts")
def q_value_counts(spark, enc):
    return P.value_counts(C.null_tokens(enc), "race")


@query("numeric_means")
def q_numeric_means(spark, enc):
    return P.numeric_means(cleaned(enc), NUMERIC_COLUMNS)


@query("column_modes")
def q_column_modes(spark, enc):
    return P.column_modes(cleaned(enc), CATEGORICAL_COLUMNS)


@query("class_counts")
def q_class_counts(spark, enc):
    return P.class_counts(cleaned(enc))


# ---------------------------------------------------------------------------
# imputation and features
# ---------------------------------------------------------------------------

@query("impute_mean")
def q_impute_mean(spark, enc):
    c = cleaned(enc)
    model = EncounterImputer(numericCols=NUMERIC_COLUMNS, categoricalCols=[]).fit(c)
    return model.transform(c).select(KEY, *NUMERIC_COLUMNS)


@query("impute_mode")
def q_impute_mode(spark, enc):
    c = cleaned(enc)
    model = EncounterImputer(numericCols=[], categoricalCols=CATEGORICAL_COLUMNS).fit(c)
    return model.transform(c).select(KEY, *CATEGORICAL_COLUMNS)


@query("impute_encounters")
def q_impute_encounters(spark, enc):
    return imputed(enc)


@query("diag_groups")
def q_diag_groups(spark, enc):
    return FE.diagnosis_groups(cleaned(enc)).select(KEY, *[f"{c}_group" for c in DIAGNOSIS_COLUMNS])


@query("diag_category")
def q_diag_category(spark, enc):
    labelled = C.strict_label(C.drop_columns(C.null_tokens(enc), DROP_NOT_KEY))
    return FE.diagnosis_category(labelled, "diag_1").select(KEY, "diag_1", "diag_1_category")


@query("diag_category_counts")
def q_diag_category_counts(spark, enc):
    labelled = C.strict_label(C.drop_columns(C.null_tokens(enc), DROP_NOT_KEY))
    return P.value_counts(FE.diagnosis_category(labelled, "diag_1"), "diag_1_category", order=True)


@query("comorbidity_count")
def q_comorbidity_count(spark, enc):
    """Depends on no imputed column, so nothing is fitted: one projection."""
    return FE.comorbidity_count(FE.diagnosis_groups(cleaned(enc))).select(KEY, "diag_1_group", "diag_2_group", "diag_3_group", "comorbidity_count")


@query("per_day_ratios")
def q_per_day_ratios(spark, enc):
    used = ["time_in_hospital", *[num for _, num in PER_DAY_RATIOS]]
    return FE.per_day_ratios(impute(cleaned(enc), used, [])).select(KEY, "time_in_hospital", "labs_per_day", "meds_per_day", "procs_per_day")


@query("med_change_score")
def q_med_change_score(spark, enc):
    return FE.change_score(impute(cleaned(enc), [], MEDICATION_COLUMNS)).select(KEY, "med_change_score")


@query("class_weights")
def q_class_weights(spark, enc):
    return FE.class_weights(cleaned(enc)).select(KEY, LABEL, WEIGHT)


@query("feature_table")
def q_feature_table(spark, enc):
    return feature_table(enc)


# ---------------------------------------------------------------------------
# split and encoding
# ---------------------------------------------------------------------------

@query("hash_split")
def q_hash_split(spark, enc):
    return SP.hash_split(enc.select(KEY)).withColumn("bucket", SP.hash_bucket(F.col(KEY)))


def _indexed(enc: DataFrame):
    """Feature rows, roles of their columns and the category indexer; imputer and indexer are fitted from one pass."""
    c = cleaned(enc)
    roles = feature_roles_of(FE.engineer_rows(c))
    fitted = fit_together(c, FE.engineer_rows, roles["categorical"])
    return FE.engineer_rows(fitted.imputer.transform(c)), roles, fitted.indexer


@query("string_index")
def q_string_index(spark, enc):
    """Category -> index table as applied to every row: (column, category, index, rows)."""
    f, roles, model = _indexed(enc)
    t = model.transform(f)
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(q(c)).alias("category"),
                 F.col(q(f"{c}_index")).cast("int").alias("category_index")) for c in roles["categorical"]]))
    return (t.select(pairs.alias("p")).select("p.*")
            .groupBy("column_name", "category", "category_index").agg(F.count(F.lit(1)).alias("n")))


@query("one_hot_long")
def q_one_hot_long(spark, enc):
    """Active slot of each one-hot vector, counted: (column, slot, vector size, rows)."""
    f, roles, model = _indexed(enc)
    cats = roles["categorical"]
    t = E.one_hot(cats).fit(model.transform(f)).transform(model.transform(f))
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), E.active_slots(f"{c}_vec").alias("v"), E.vector_size(f"{c}_vec").alias("vector_size")) for c in cats]))
    slots = t.select(pairs.alias("p")).select("p.column_name", F.get("p.v", F.lit(0))["slot"].cast("int").alias("slot"), "p.vector_size")
    return slots.groupBy("column_name", "slot", "vector_size").agg(F.count(F.lit(1)).alias("n"))


@query("assembled_long")
def q_assembled_long(spark, enc):
    """Per slot of the assembled feature vector: rows with a non-zero value and their sum."""
    f, roles, indexer = _indexed(enc)
    model = Pipeline(stages=[indexer, *E.encoding_stages(roles)[1:]]).fit(f)
    nz = model.transform(f).select(F.inline(E.active_slots(E.FEATURES)))
    return nz.groupBy(F.col("slot").cast("int").alias("slot")).agg(
        F.count(F.lit(1)).alias("n_nonzero"), F.round(F.sum("value"), 4).alias("sum_value"))


# ---------------------------------------------------------------------------
# evaluation on the rule score
# ---------------------------------------------------------------------------

@query("confusion_matrix")
def q_confusion_matrix(spark, enc):
    """Confusion matrix as an aggregate, written by the CSV sink and read back."""
    path = write_confusion(EV.confusion_matrix(rule_scored(enc)), scratch_path(spark, "confusion-csv"))
    return read_confusion(spark, path)


@query("class_metrics")
def q_class_metrics(spark, enc):
    return EV.class_metrics(rule_scored(enc))


@query("auc_exact")
def q_auc_exact(spark, enc):
    return EV.auc(rule_scored(enc), "score")


# ---------------------------------------------------------------------------
# scoring contract
# ---------------------------------------------------------------------------

def rule_probability(enc: DataFrame) -> DataFrame:
    """A model-shaped frame from the rule score: p = score / (score + 2)."""
    from pyspark.ml.functions import array_to_vector

    r = rule_scored(enc)
    p = F.col("score").cast("double") / (F.col("score").cast("double") + 2.0)
    return r.select(KEY, F.col("prediction"), array_to_vector(F.array(1.0 - p, p)).alias("probability"))


@query("shape_scores")
def q_shape_scores(spark, enc):
    return S.shape_scores(rule_probability(enc))


@query("validate_records")
def q_validate_records(spark, enc):
    records = enc.select(KEY, *[F.col(q(c)) for c in RECORD_FIELDS])
    return S.validate_records(records).select(KEY, "is_valid", "reason", "n_missing_tokens")


assert set(RAW_COLUMNS) >= set(RECORD_FIELDS)
