"""A ledger of finished units of a long job, in a folder that a later driver can read.

Each unit's rows are written to a folder of their own, so units that end at the same
time don't meet, a unit that is done again replaces its rows, and what a lost
driver left half-written is in no committed file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardflow.sources.model_store import _file


def record(spark: SparkSession, ledger: str, unit: str, rows: list[tuple], schema: str) -> None:
    """Commit the few rows of one finished unit."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{ledger.rstrip('/')}/{unit}")


def recorded(spark: SparkSession, ledger: str, schema: str) -> DataFrame:
    """Rows of all finished units; none if there is no ledger yet."""
    fs, at = _file(ledger.rstrip("/"))
    if not fs.exists(at):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(str(at))
