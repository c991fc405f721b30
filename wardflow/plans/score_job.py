"""Scoring job: persisted model + record table (or folder stream) → shaped scores.

    python -m wardflow.plans.score_job --model out/model --input new/ --output scored/ [--stream]

Records failing the contract go to ``<output>_rejects`` with their reason; the
input is read once for both. With ``--stream`` the input folder is watched with
Structured Streaming (``availableNow`` unless ``--continuous``, which runs until it
is stopped), checkpointing under ``<output>_checkpoint``. Both formats can be streamed.

On a cluster: ``spark-submit --py-files wardflow.zip wardflow/plans/score_job.py ...``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from wardflow.operators.score import score_all
from wardflow.schema import KEY
from wardflow.session import scratch_path, shared_dir
from wardflow.sources.model_store import load_model
from wardflow.streaming.scoring import score_stream


def parse(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description="Score encounter records with a persisted model.")
    p.add_argument("--model", required=True)
    p.add_argument("--input", required=True)
    p.add_argument("--format", default="parquet", choices=["csv", "parquet"])
    p.add_argument("--output", required=True)
    p.add_argument("--stream", action="store_true")
    p.add_argument("--continuous", action="store_true")
    return p.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace):
    shared_dir(spark)
    model = load_model(args.model)
    out = args.output.rstrip("/")
    if args.stream:
        return score_stream(spark, args.input, model, out, f"{out}_checkpoint", available_now=not args.continuous, fmt=args.format)
    reader = spark.read.option("header", True) if args.format == "csv" else spark.read
    every = scratch_path(spark, "scored")  # narrow: key, reason, three score columns
    score_all(reader.format(args.format).load(args.input), model).write.parquet(every)
    rows = spark.read.parquet(every)
    rows.where(F.col("reason").isNotNull()).select(KEY, "reason").write.mode("overwrite").parquet(f"{out}_rejects")
    rows.where(F.col("reason").isNull()).drop("reason").write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


def main(argv=None) -> None:
    spark = SparkSession.builder.appName("wardflow-score").getOrCreate()
    try:
        args = parse(argv)
        result = run(spark, args)
        if args.stream and args.continuous:
            result.awaitTermination()
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
