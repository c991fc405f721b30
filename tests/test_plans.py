"""Physical-plan checks: pruning, no needless shuffles, broadcast only where bounded,
map-side partial aggregation, and the job count of imputation."""

import pytest

from wardflow.operators import profile as P
from wardflow.operators.impute import EncounterImputer
from wardflow.operators.lookup import decode_ids
from wardflow.plans import queries as Q
from wardflow.schema import CATEGORICAL_COLUMNS
from wardflow.sources.files import land_parquet, read_code_maps, read_encounters


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def landed(spark, enc_small, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("landed") / "enc")
    land_parquet(enc_small, path)
    return read_encounters(spark, path, fmt="parquet")


def test_feature_table_is_one_pruned_projection(landed):
    plan = _plan(Q.feature_table(landed))
    assert "Exchange" not in plan and "Join" not in plan
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line or "ReadSchema" in line]
    text = " ".join(scan)
    for dropped in ("weight", "payer_code", "medical_specialty", "patient_nbr"):
        assert f"{dropped}:" not in text


def test_filter_and_projection_reach_the_scan(landed):
    # Column pruning reaches the scan through the cleaning projection.
    plan = _plan(Q.cleaned(landed).select("encounter_id", "race"))
    assert "ReadSchema: struct<encounter_id:string,race:string>" in plan
    # A predicate on a raw column is pushed into the Parquet reader; one on a
    # cleaned column is an expression of the raw value and runs in the scan stage.
    raw = _plan(Q.cleaned(landed.where("readmitted = 'NO'")).select("encounter_id", "label"))
    assert "EqualTo(readmitted,NO)" in raw
    assert "Exchange" not in raw


def test_decode_is_planned_by_size(spark, landed):
    ids = landed.select("encounter_id", "admission_type_id", "discharge_disposition_id", "admission_source_id")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # no hint forces a broadcast
    try:
        plan = _plan(decode_ids(ids, read_code_maps(spark)))
        assert "BroadcastHashJoin" not in plan and "NestedLoopJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _jobs(spark, name, run) -> int:
    """Jobs without AQE's own (it runs each shuffle as a job)."""
    sc = spark.sparkContext
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sc.setJobGroup(name, name)
        run()
        return len(sc.statusTracker().getJobIdsForGroup(name))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.adaptive.enabled", old)


@pytest.mark.parametrize(("key", "jobs"), [("comorbidity_count", 1), ("per_day_ratios", 2), ("med_change_score", 2), ("class_metrics", 2)])
def test_queries_fit_only_what_they_read(spark, landed, key, jobs):
    def run():
        Q.REGISTRY[key](spark, landed).write.format("noop").mode("overwrite").save()

    assert _jobs(spark, f"fits-{key}", run) == jobs


@pytest.mark.parametrize("key", ["one_hot_long", "assembled_long"])
def test_encoding_checks_keep_vectors_sparse(spark, landed, key):
    assert "vector_to_array" not in _plan(Q.REGISTRY[key](spark, landed)).lower()


def test_modes_aggregate_map_side(landed):
    plan = _plan(P.column_modes(Q.cleaned(landed), CATEGORICAL_COLUMNS))
    assert "Expand" in plan
    assert "partial_count" in plan   # partial aggregation before the shuffle


def test_imputer_fit_is_two_jobs(spark, landed):
    cleaned = Q.cleaned(landed)
    # one mean aggregate, one mode aggregate, for 8 + 33 columns
    assert _jobs(spark, "imputer-fit", lambda: EncounterImputer().fit(cleaned)) == 2


@pytest.mark.parametrize("ranges", [1, 7])
def test_auc_plan_has_no_cross_join(spark, ranges):
    from wardflow.operators import evaluate as EV

    df = spark.range(3000).selectExpr("cast(id % 997 as double) / 7 as score", "cast(id % 3 = 0 as double) as label")
    plan = _plan(EV.auc(df, "score", ranges=ranges))
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "BroadcastHashJoin" in plan   # one row per range, joined by range


def test_scoring_is_one_pass_without_shuffle(spark, landed):
    from wardflow.operators import models as M
    from wardflow.operators.score import score_batch
    from wardflow.operators.split import hash_split_frames
    from wardflow.plans.model_queries import records
    from wardflow.plans.pipeline import fit_scoring_model

    train, test = hash_split_frames(landed)
    model = fit_scoring_model(train, M.forest(numTrees=3, maxDepth=3))
    for side in score_batch(records(test), model):
        plan = _plan(side)
        assert "Exchange" not in plan and "Join" not in plan
