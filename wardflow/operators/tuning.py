"""Grid search by cross-validated AUC that goes on where a lost driver stopped.

A unit is one fit on all folds but one and the AUC of what it says about that
one. Every finished unit is written to a ledger; a search that starts again with
the same estimator, folds and rows does the open units only.

Boosted trees that differ in ``maxIter`` alone share one fit: the model of ``n``
rounds is the first ``n`` trees of a longer one (each round has its own seed and only
sees the rounds before it), so the longest is fitted and the others are read off.

Defined results: folds are the values of ``fold_col``, which comes from the key (see
``split.hash_folds``), so units are the same in every run; an empty grid has one point,
the estimator as it is; a fold with one class or without rows has a NaN AUC, and a point with
such a fold is never the best; among equal averages the first point wins; with no
other point left a ``ValueError`` says so.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import math
import time
from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.operators.models import auc_evaluator
from wardflow.schema import LABEL, q
from wardflow.sources.ledger import record, recorded

LEDGER = "search string, params string, fold int, auc double, seconds double"


def grid_points(grid: Mapping[str, Sequence]) -> list[dict]:
    """Every combination of the grid's values, the last name varying fastest."""
    return [dict(zip(grid, values, strict=True)) for values in itertools.product(*grid.values())]


def shared_fits(estimator, points: Sequence[dict]) -> list[tuple[dict, list[dict]]]:
    """(parameters to fit with, grid points read off that fit)."""
    if not isinstance(estimator, GBTClassifier) or estimator.isSet("validationIndicatorCol"):
        return [(p, [p]) for p in points]
    groups: dict[str, list[dict]] = {}
    for p in points:
        groups.setdefault(_json({k: v for k, v in p.items() if k != "maxIter"}), []).append(p)
    return [(max(g, key=lambda p: p.get("maxIter", 0)), g) for g in groups.values()]


def prefix_margins(model: GBTClassificationModel, df: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """``df`` with ``margin_<n>`` for each length: the weighted sum of the first ``n`` trees' predictions."""
    weights = list(model.treeWeights)
    trees = model.trees[:max(lengths)]
    out = df
    for i, tree in enumerate(trees):
        out = tree.setFeaturesCol(model.getFeaturesCol()).setPredictionCol(f"__tree_{i}").transform(out)
    margins = {n: sum((F.col(f"__tree_{i}") * F.lit(weights[i]) for i in range(min(n, len(trees)))), F.lit(0.0)) for n in lengths}
    return out.select(*[F.col(q(c)) for c in df.columns], *[m.alias(f"margin_{n}") for n, m in margins.items()])


def fit_unit(estimator, fit: dict, points: Sequence[dict], train: DataFrame, held_out: DataFrame) -> list[float]:
    """AUC of each point on the held-out rows, from one fit."""
    classes = held_out.agg(F.count_if(F.col(LABEL) == 1.0), F.count_if(F.col(LABEL) == 0.0)).first()
    if not all(classes):
        return [math.nan] * len(points)
    model = _with(estimator, fit).fit(train)
    if len(points) == 1:
        return [auc_evaluator().evaluate(model.transform(held_out))]
    rounds = [p["maxIter"] for p in points]
    scored = prefix_margins(model, held_out, sorted(set(rounds))).drop(model.getFeaturesCol()).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return [auc_evaluator(f"margin_{n}").evaluate(scored) for n in rounds]
    finally:
        scored.unpersist()


def grid_search(estimator, grid: Mapping[str, Sequence], df: DataFrame, ledger: str, folds: int = 3, fold_col: str = "fold",
                parallelism: int = 4):
    """(best model fitted on all rows, grid_point / params / avg_auc / seconds / is_best of each point).

    ``df`` holds label, features, the weight that the estimator names, and ``fold_col``.
    ``ledger`` is a folder that outlives the driver. ``parallelism`` units run at a time.
    A unit that fails fails the search, after the units that had begun are recorded.
    """
    spark = df.sparkSession
    points = grid_points(grid)
    own = not df.is_cached
    if own:
        df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        search = _digest(type(estimator).__name__, _settings(estimator, grid), folds, fold_col, _fingerprint(df))
        mine = F.col("search") == search
        done = {(r["params"], r["fold"]): r for r in recorded(spark, ledger, LEDGER).where(mine).collect()}  # points x folds rows
        todo = [(fit, of, k) for fit, of in shared_fits(estimator, points) for k in range(folds)
                if any((_json(p), k) not in done for p in of)]

        def run(unit):
            fit, of, k = unit
            began = time.monotonic()
            fold = F.col(q(fold_col))
            found = fit_unit(estimator, fit, of, df.where(fold != k), df.where(fold == k))
            each = (time.monotonic() - began) / len(of)
            rows = [(search, _json(p), k, float(auc), each) for p, auc in zip(of, found, strict=True)]
            record(spark, ledger, f"{search}-{_digest(of)}-{k}", rows, LEDGER)

        failed = []

        def attempt(unit):
            if failed:
                return
            try:
                run(unit)
            except Exception as e:  # noqa: BLE001 - raised below, when the units beside it have ended
                failed.append(e)

        if todo:
            with ThreadPool(max(1, min(parallelism, len(todo)))) as pool:
                pool.map(inheritable_thread_target(spark)(attempt), todo, chunksize=1)
        if failed:
            raise failed[0]
        done = {(r["params"], r["fold"]): r for r in recorded(spark, ledger, LEDGER).where(mine).collect()}
        rows = []
        for i, p in enumerate(points):
            units = [done[_json(p), k] for k in range(folds)]
            rows.append((i, _json(p), sum(u["auc"] for u in units) / folds, sum(u["seconds"] for u in units)))
        ranked = [r for r in rows if not math.isnan(r[2])]
        if not ranked:
            raise ValueError("every grid point has a fold that holds one class only")
        best = max(ranked, key=lambda r: (r[2], -r[0]))[0]
        model = _with(estimator, points[best]).fit(df)
    finally:
        if own:
            df.unpersist()
    metrics = spark.createDataFrame(rows, "grid_point int, params string, avg_auc double, seconds double")
    return model, metrics.withColumn("is_best", F.col("grid_point") == F.lit(best))


def _with(estimator, params: dict):
    return estimator.copy({estimator.getParam(k): v for k, v in params.items()})


def _json(params: dict) -> str:
    return json.dumps(params, sort_keys=True)


def _digest(*parts) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()[:20]


def _settings(estimator, grid: Mapping[str, Sequence]) -> dict:
    return {p.name: v for p, v in estimator.extractParamMap().items() if p.name not in grid}


def _fingerprint(df: DataFrame) -> list[str]:
    """Rows and the sum of their hashes, in any order: a ledger of other rows doesn't count."""
    row = F.xxhash64(*[F.unwrap_udt(F.col(q(f.name))) if f.dataType.typeName() == "vectorudt" else F.col(q(f.name)) for f in df.schema])
    return [str(x) for x in df.agg(F.count("*"), F.sum(row.cast("decimal(38,0)"))).first()]
