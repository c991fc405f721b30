"""Grid search: resumed from its ledger, boosted grids read off shared fits, and equal to MLlib's cross-validation."""

import json

import pytest
from pyspark.sql import functions as F

from wardflow.operators import models as M
from wardflow.operators import tuning as T
from wardflow.operators.encode import FEATURES
from wardflow.operators.split import hash_folds, hash_split_frames
from wardflow.plans.pipeline import BOOSTED_GRID, FOREST_GRID, preparation_pipeline, tune_and_evaluate
from wardflow.schema import KEY, LABEL, WEIGHT


@pytest.fixture(scope="module")
def encoded(enc_small):
    train, _ = hash_split_frames(enc_small)
    rows = hash_folds(preparation_pipeline(train).fit(train).transform(train).select(KEY, LABEL, WEIGHT, FEATURES), folds=2).drop(KEY)
    rows = rows.cache()
    yield rows
    rows.unpersist()


def test_full_grids_and_their_fits(spark):
    assert len(T.grid_points(FOREST_GRID)) == 12 and len(T.grid_points(BOOSTED_GRID)) == 16
    assert T.grid_points({}) == [{}]
    assert [p for _, of in T.shared_fits(M.forest(), T.grid_points(FOREST_GRID)) for p in of] == T.grid_points(FOREST_GRID)
    fits = T.shared_fits(M.gbt(), T.grid_points(BOOSTED_GRID))
    assert len(fits) == 8 and all(fit["maxIter"] == 50 and [p["maxIter"] for p in of] == [20, 50] for fit, of in fits)


def test_first_trees_are_the_shorter_model(encoded):
    train, held_out = encoded.where("fold <> 0"), encoded.where("fold = 0")
    long = M.gbt(maxIter=4, maxDepth=3).fit(train)
    margins = T.prefix_margins(long, held_out, [2, 4])
    assert margins.columns == [*held_out.columns, "margin_2", "margin_4"]
    for n in (2, 4):
        alone = M.gbt(maxIter=n, maxDepth=3).fit(train)
        both = alone.transform(margins).select(F.abs(F.unwrap_udt("rawPrediction")["values"][1] - F.col(f"margin_{n}")).alias("d"))
        assert both.agg(F.max("d")).first()[0] < 1e-9
        auc = M.auc_evaluator()
        assert abs(auc.evaluate(alone.transform(held_out)) - M.auc_evaluator(f"margin_{n}").evaluate(margins)) < 1e-9


def test_same_averages_as_cross_validation(spark, encoded, tmp_path):
    for estimator, grid in ((M.forest(numTrees=3), {"maxDepth": [2, 4]}), (M.gbt(maxDepth=2), {"maxIter": [2, 3]})):
        ours, rows = T.grid_search(estimator, grid, encoded, str(tmp_path / "ledger"), folds=2, parallelism=2)
        theirs, expected = M.tune(estimator, grid, encoded, folds=2, parallelism=2)
        rows, expected = rows.orderBy("grid_point").collect(), expected.orderBy("grid_point").collect()
        assert [r.is_best for r in rows] == [r.is_best for r in expected]
        assert all(abs(a.avg_auc - b.avg_auc) < 1e-9 for a, b in zip(rows, expected, strict=True))
        assert {k: ours.getOrDefault(k) for k in grid} == {k: theirs.getOrDefault(k) for k in grid}


def test_a_lost_search_goes_on(spark, encoded, tmp_path, monkeypatch):
    ledger, grid = str(tmp_path / "ledger"), {"maxDepth": [1, 2], "numTrees": [2]}
    real, begun = T.fit_unit, []

    def dies_at_third(*args):
        begun.append(args[1])
        if len(begun) == 3:
            raise RuntimeError("lost")
        return real(*args)

    monkeypatch.setattr(T, "fit_unit", dies_at_third)
    with pytest.raises(RuntimeError, match="lost"):
        T.grid_search(M.forest(), grid, encoded, ledger, folds=2, parallelism=1)
    assert T.recorded(spark, ledger, T.LEDGER).count() == 2
    (tmp_path / "ledger" / "half" / "_temporary").mkdir(parents=True)  # what a driver lost at writing leaves
    (tmp_path / "ledger" / "half" / "_temporary" / "part-0.parquet").write_bytes(b"PAR1")
    begun.clear()
    monkeypatch.setattr(T, "fit_unit", lambda *args: begun.append(args[1]) or real(*args))
    _, resumed = T.grid_search(M.forest(), grid, encoded, ledger, folds=2, parallelism=2)
    assert len(begun) == 2  # the open ones
    _, again = T.grid_search(M.forest(), grid, encoded, ledger, folds=2)
    assert len(begun) == 2
    _, fresh = T.grid_search(M.forest(), grid, encoded, str(tmp_path / "other"), folds=2)
    figures = [{r.params: r.avg_auc for r in x.collect()} for x in (resumed, again, fresh)]
    assert figures[0] == figures[1] and all(abs(figures[0][k] - v) < 1e-9 for k, v in figures[2].items())
    # other rows, other folds or other settings are another search
    n = len(begun)
    T.grid_search(M.forest(), grid, encoded.where(F.col(WEIGHT) > 0).limit(encoded.count() - 1), ledger, folds=2)
    T.grid_search(M.forest(seed=7), grid, encoded, ledger, folds=2)
    assert len(begun) == n + 8


def test_defined_cases(spark, encoded, tmp_path):
    one_class = encoded.withColumn(LABEL, F.when(F.col("fold") == 1, 1.0).otherwise(F.col(LABEL)))
    with pytest.raises(ValueError, match="one class"):
        T.grid_search(M.forest(numTrees=1), {"maxDepth": [1]}, one_class, str(tmp_path / "a"), folds=2)
    model, rows = T.grid_search(M.forest(numTrees=2, maxDepth=1), {}, encoded, str(tmp_path / "b"), folds=2)
    assert [(r.grid_point, r.params, r.is_best) for r in rows.collect()] == [(0, "{}", True)] and model.getNumTrees == 2
    _, ties = T.grid_search(M.forest(numTrees=2, maxDepth=1), {"minInstancesPerNode": [1, 2]}, encoded, str(tmp_path / "c"), folds=2)
    ties = ties.orderBy("grid_point").collect()
    assert ties[0].avg_auc != ties[1].avg_auc or ties[0].is_best


def test_best_model_scores_the_test_rows(spark, enc_small, tmp_path):
    train, test = hash_split_frames(enc_small)
    model, points, metrics, confusion = tune_and_evaluate(train, test, M.gbt(maxDepth=2), {"maxIter": [1, 3]}, str(tmp_path / "l"), folds=2)
    best = [r for r in points.collect() if r.is_best]
    assert len(best) == 1 and model.stages[-1].getNumTrees == json.loads(best[0].params)["maxIter"]
    assert sum(r.pred_0 + r.pred_1 for r in confusion.collect()) == test.count()
    assert {r.metric: r.value for r in metrics.collect()}["areaUnderROC"] > 0.5
