"""Steps whose tasks must not grow with the table, and their results against the plain way."""

from __future__ import annotations

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from wardflow.operators import encode as E
from wardflow.plans import queries as Q
from wardflow.schema import KEY, RAW_COLUMNS
from wardflow.session import scratch_path
from wardflow.sources import fixtures
from wardflow.sources.files import read_encounters_checked


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([("a", "x", 1, 0.5), ("a", "y", 0, 0.0), ("b", None, 2, 1.5), ("b", "x", 0, 0.0), ("b", "1:x", 3, 0.0)],
                                 "c string, d string, n int, r double")


@pytest.fixture
def unseen(spark):
    return spark.createDataFrame([("z", "y", 1, 0.5), (None, "0:a", 0, 0.0), ("a", None, 7, 2.5), (None, None, 0, 0.0), ("b", "1:x", 0, 1.0)],
                                 "c string, d string, n int, r double")


def test_hot_slot(spark, rows, unseen):
    model = Pipeline(stages=[E.index_categories(["c"]), E.one_hot(["c"])]).fit(rows)
    out = model.transform(unseen).select(E.hot_slot("c_vec").alias("s"), E.active_slots("c_vec").alias("v")).collect()
    assert [r.s for r in out] == [r.v[0].slot if r.v else None for r in out] == [None, None, 1, None, 0]


def test_tasks_grow_with_the_table(spark, tmp_path, monkeypatch):
    parts = spark.range(1000).select(F.col("id").alias("l_orderkey"), F.lit(1).alias("l_partkey"), F.lit(2).alias("l_suppkey"), F.lit(3).alias("l_linenumber"))
    parts.write.parquet(f"{tmp_path}/lineitem.parquet")
    few = fixtures.load_encounters(spark, str(tmp_path))
    monkeypatch.setattr(fixtures, "ROWS_A_TASK", 50)
    many = fixtures.load_encounters(spark, str(tmp_path))
    assert many.rdd.getNumPartitions() == 20 and few.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sorted(few.collect()) == sorted(many.collect())


def _encounters(spark, n: int, partitions: int):
    base = spark.range(n).repartition(partitions)
    return base.select(*[{KEY: F.col("id").cast("string"), "age": F.element_at(F.array(F.lit("[50-60)"), F.lit("[70-80)"), F.lit("[0-10)")), (F.col("id") % 3 + 1).cast("int"))}
                         .get(c, F.lit("v")).alias(c) for c in RAW_COLUMNS])


@pytest.mark.parametrize(("n", "partitions"), [(90, 12), (3, 1), (0, 3)])
def test_faulty_lines_stay_in_their_partitions(spark, n, partitions):
    enc = _encounters(spark, n, partitions)
    lines = Q.faulty_lines(enc)
    path = scratch_path(spark, "lines")
    lines.write.text(path)
    files = [f for f in spark.read.text(path, wholetext=True).collect() if f.value]
    assert len(files) == (partitions if n else 0)  # not eight, whatever the table's size
    assert all(f.value.startswith(",".join(RAW_COLUMNS) + "\n") and f.value.count(",".join(RAW_COLUMNS)) == 1 for f in files)
    good, bad = read_encounters_checked(spark, path)
    assert (good.count(), bad.count()) == (n // 3, n // 3 * 2)
    assert {r.reason for r in bad.collect()} == ({"fields:2", "fields:51"} if n else set())


def test_active_slots_are_read_by_value(spark):
    from pyspark.ml.linalg import Vectors

    made = [Vectors.sparse(3, [1], [0.0]), Vectors.dense(0.0, 1.0, 0.0), Vectors.sparse(3, [2], [1.0]), Vectors.sparse(3, [], [])]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(made)], ["i", "v"])
    assert [r.s for r in frame.select("i", E.hot_slot("v").alias("s")).orderBy("i").collect()] == [None, 1, 2, None]


def test_one_hot_long_reads_every_vector_whole(spark, enc_small, monkeypatch):
    read, whole = [], E.active_slots
    monkeypatch.setattr(E, "active_slots", lambda vector: read.append(vector) or whole(vector))
    counted = Q.REGISTRY["one_hot_long"](spark, enc_small).groupBy("column_name").agg(F.sum("n").alias("n")).collect()
    assert set(read) == {f"{r.column_name}_vec" for r in counted}
    assert {r.n for r in counted} == {enc_small.count()}


def test_training_rows_are_kept_off_the_executors_memory(spark, enc_small):
    from wardflow.operators import models as M
    from wardflow.plans.pipeline import fit_scoring_models

    kept = []

    class Seen:
        def fit(self, rows):
            kept.append(rows.storageLevel)
            return M.forest(numTrees=1, maxDepth=1).fit(rows)

    model = fit_scoring_models(enc_small, {"seen": Seen()})["seen"]
    assert kept[0].useDisk and not kept[0].useMemory
    assert model.transform(enc_small).count() == enc_small.count()


def test_a_task_of_training_rows_fits_an_executor():
    slots, trees = 259, 20  # of the encoded vector, of the registered forests
    assert fixtures.ROWS_A_TASK * (4 * slots + 4 * trees + 100) < 200_000_000  # MLlib's form of a task's rows in bytes
