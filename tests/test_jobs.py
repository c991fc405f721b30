"""End-to-end jobs: train from a CSV file, then score a record folder and a stream."""

import json
import os
from types import SimpleNamespace

from pyspark.sql import functions as F

from wardflow.plans import score_job, train_job
from wardflow.plans.model_queries import records
from wardflow.sources.files import read_confusion, write_csv
from wardflow.streaming.scoring import read_rejects


def test_train_then_score(spark, enc_small, tmp_path):
    csv = write_csv(enc_small, str(tmp_path / "encounters_csv"))
    out = str(tmp_path / "out")
    paths = train_job.run(spark, train_job.parse(["--input", csv, "--output", out, "--trees", "5"]))
    assert set(paths) == {"model", "metrics", "confusion_matrix"}
    files = [f for f in os.listdir(paths["metrics"]) if f.endswith(".json")]
    metrics = json.loads(open(os.path.join(paths["metrics"], files[0])).readline())
    assert set(metrics) == {"areaUnderROC", "recall", "precision", "f1_positive", "f1_weighted"}
    cm = read_confusion(spark, paths["confusion_matrix"]).collect()
    assert sum(r.pred_0 + r.pred_1 for r in cm) > 0

    recs = str(tmp_path / "records")
    records(enc_small).write.parquet(recs)
    scored = score_job.run(spark, score_job.parse(["--model", paths["model"], "--input", recs,
                                                   "--output", str(tmp_path / "scored")]))
    assert scored.count() == enc_small.count()
    streamed = score_job.run(spark, score_job.parse(["--model", paths["model"], "--input", recs,
                                                     "--output", str(tmp_path / "scored_stream"), "--stream"]))
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, scored.collect()))

    # CSV by stream, with rejects; an empty folder is allowed
    bad = records(enc_small).limit(30).withColumn("gender", F.lit(None).cast("string"))
    csv_in = str(tmp_path / "records_csv")
    records(enc_small).limit(50).unionByName(bad).write.option("header", True).csv(csv_in)
    out_csv = str(tmp_path / "scored_csv")
    got = score_job.run(spark, score_job.parse(["--model", paths["model"], "--input", csv_in, "--output", out_csv, "--stream", "--format", "csv"]))
    assert got.count() == 50 and read_rejects(spark, out_csv).count() == 30
    empty = tmp_path / "empty"
    empty.mkdir()
    none = score_job.run(spark, score_job.parse(["--model", paths["model"], "--input", str(empty), "--output", str(tmp_path / "none"), "--stream"]))
    assert none.count() == 0 and read_rejects(spark, str(tmp_path / "none")).count() == 0
    batch = score_job.run(spark, score_job.parse(["--model", paths["model"], "--input", csv_in, "--format", "csv", "--output", str(tmp_path / "b")]))
    assert batch.count() == 50 and spark.read.parquet(str(tmp_path / "b_rejects")).count() == 30


def test_continuous_job_waits(spark, monkeypatch):
    waited = []

    class Handle:
        def awaitTermination(self):
            waited.append(True)

    monkeypatch.setattr(score_job, "run", lambda s, a: Handle())
    monkeypatch.setattr(score_job.SparkSession, "builder", SimpleNamespace(appName=lambda n: SimpleNamespace(getOrCreate=lambda: SimpleNamespace(stop=lambda: None))))
    score_job.main(["--model", "m", "--input", "i", "--output", "o", "--stream", "--continuous"])
    assert waited
