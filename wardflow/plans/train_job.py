"""Training job: load → split → fit the whole pipeline → evaluate → persist.

    python -m wardflow.plans.train_job --input data/encounters.csv --output out/

Writes ``out/model`` (PipelineModel), ``out/metrics`` (JSON: areaUnderROC,
recall, precision, f1_positive, f1_weighted) and ``out/confusion_matrix``
(CSV). With ``--tune`` the model's grid is searched first; its table goes to ``out/grid``
(JSON) and finished fits to ``out/ledger``, from which a job that was lost goes on when it
is started again. The master and cluster settings come from the launcher.

On a cluster: ``spark-submit --py-files wardflow.zip wardflow/plans/train_job.py ...``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from wardflow.operators import models as M
from wardflow.operators.evaluate import METRIC_NAMES, metrics_wide
from wardflow.operators.split import hash_split_frames, random_split
from wardflow.plans.pipeline import BOOSTED_GRID, FOREST_GRID, train_and_evaluate, tune_and_evaluate
from wardflow.schema import WEIGHT
from wardflow.session import shared_dir
from wardflow.sources.files import read_encounters, read_encounters_checked, write_confusion, write_metrics
from wardflow.sources.model_store import save_model

GRIDS = {"forest": FOREST_GRID, "gbt": BOOSTED_GRID}


def parse(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description="Train and evaluate the readmission model.")
    p.add_argument("--input", required=True)
    p.add_argument("--format", default="csv", choices=["csv", "parquet"])
    p.add_argument("--output", required=True)
    p.add_argument("--model", default="forest", choices=["forest", "gbt", "logistic"])
    p.add_argument("--trees", type=int, default=20)
    p.add_argument("--iterations", type=int, help="of gbt (default 20) or logistic (default 100)")
    p.add_argument("--unweighted", action="store_true", help="ignore class weights")
    p.add_argument("--strict-labels", action="store_true", help="keep rows with a listed target only")
    p.add_argument("--categories", nargs="*", default=[], help="diagnosis columns whose ICD-9 chapter is a feature")
    p.add_argument("--depth", type=int, default=5)
    p.add_argument("--split", default="hash", choices=["hash", "random"])
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--tune", action="store_true", help="search the grid of forest or gbt by 3-fold cross-validation")
    args = p.parse_args(argv)
    if args.tune and args.model not in GRIDS:
        p.error(f"--tune needs one of the models {sorted(GRIDS)}")
    return args


def classifier(args: argparse.Namespace):
    weight = None if args.unweighted else WEIGHT
    if args.model == "forest":
        return M.forest(weight, numTrees=args.trees, maxDepth=args.depth, seed=args.seed)
    if args.model == "gbt":
        return M.gbt(weight, maxIter=args.iterations or 20, maxDepth=args.depth, seed=args.seed)
    return M.logistic(weight, maxIter=args.iterations or 100)


def run(spark: SparkSession, args: argparse.Namespace) -> dict[str, str]:
    shared_dir(spark)
    if args.format == "csv":
        raw, rejects = read_encounters_checked(spark, args.input)
        rejects.write.mode("overwrite").json(f"{args.output.rstrip('/')}/rejected_lines")
    else:
        raw = read_encounters(spark, args.input, fmt=args.format)
    if args.split == "hash":
        train, test = hash_split_frames(raw)
    else:
        train, test = random_split(raw, seed=args.seed)
    out = args.output.rstrip("/")
    flow = dict(name=args.model, strict=args.strict_labels, categories=args.categories)
    paths = {}
    if args.tune:
        model, points, metrics, confusion = tune_and_evaluate(train, test, classifier(args), GRIDS[args.model], f"{out}/ledger", **flow)
        points.coalesce(1).write.mode("overwrite").json(f"{out}/grid")  # a row for each point
        paths["grid"] = f"{out}/grid"
    else:
        model, metrics, confusion = train_and_evaluate(train, test, classifier(args), **flow)
    paths |= {"model": save_model(model, f"{out}/model"),
             "metrics": write_metrics(metrics_wide(metrics.drop("model"), METRIC_NAMES), f"{out}/metrics"),
             "confusion_matrix": write_confusion(confusion, f"{out}/confusion_matrix")}
    return paths


def main(argv=None) -> None:
    spark = SparkSession.builder.appName("wardflow-train").getOrCreate()
    try:
        for name, path in run(spark, parse(argv)).items():
            print(f"{name}: {path}")
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
