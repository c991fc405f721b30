"""Session and shared-folder helpers.

The master and cluster settings come from the launcher. ``get_session`` only
fills in defaults that are unset, which is what tests and the local bench need.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "wardflow",
                shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**_LOCAL_DEFAULTS, **conf}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    compiled(spark).sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


HUGE_METHOD = "spark.sql.codegen.hugeMethodLimit"
COMPILED_BYTES = 8000  # the JVM interprets longer methods, for good


def compiled(spark: SparkSession) -> SparkSession:
    """Have Spark leave a generated method that the JVM would only interpret, for generated code in pieces.

    Wide projections reach that length (Spark's own limit is 65,535 bytes). A setting of this session's
    queries; one that is lower already stays.
    """
    if int(spark.conf.get(HUGE_METHOD)) > COMPILED_BYTES:
        spark.conf.set(HUGE_METHOD, str(COMPILED_BYTES))
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """Folder on the cluster's shared filesystem, under ``spark.checkpoint.dir``.

    The cluster names it. Only a local master (tests, a laptop), where all
    tasks see the same disk, gets a scratch folder if it is unset; elsewhere
    that is an error, since executors could not read each other's files.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        current = sc.getCheckpointDir()
        if current:
            base = current
        else:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise RuntimeError(f"spark.checkpoint.dir is unset on master {sc.master}: name a folder that all executors share")
            base = tempfile.mkdtemp(prefix="wardflow-ckpt-")
            sc.setCheckpointDir(base)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    path = base.rstrip("/")
    if parts:
        path = path + "/" + "/".join(parts)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder for one written table."""
    return shared_dir(spark, "wardflow", f"{name}-{uuid.uuid4().hex[:12]}")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, written once: what reads it neither recomputes it nor pushes predicates into it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
