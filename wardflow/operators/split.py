"""Train/test splits.

``hash_split`` assigns a row by a hash of its key, so membership does not
depend on partitioning, retries or executor loss, and the same rows land in
the same split in every run and every engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.schema import KEY, q


def hash_bucket(key: Column, buckets: int = 100) -> Column:
    """0..buckets-1 from the first 32 bits of md5(key)."""
    return (F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") % buckets).cast("int")


def hash_split(df: DataFrame, key: str = KEY, train_pct: int = 80, out: str = "split") -> DataFrame:
    """Add ``split`` = 'train' for buckets below ``train_pct``, else 'test' (also for a NULL key)."""
    b = hash_bucket(F.col(q(key)))
    return df.withColumn(out, F.when(b < train_pct, F.lit("train")).otherwise(F.lit("test")))


def hash_split_frames(df: DataFrame, key: str = KEY, train_pct: int = 80) -> tuple[DataFrame, DataFrame]:
    """(train, test): the rows that :func:`hash_split` labels so; a row without a key is a test row."""
    train = F.coalesce(hash_bucket(F.col(q(key))) < train_pct, F.lit(False))
    return df.where(train), df.where(~train)


def hash_folds(df: DataFrame, key: str = KEY, folds: int = 3, out: str = "fold") -> DataFrame:
    """Reproducible fold id 0..folds-1 for cross-validation; a row without a key is in fold 0."""
    fold = F.conv(F.substring(F.md5(F.concat(F.col(q(key)).cast("string"), F.lit("#fold"))), 1, 8), 16, 10).cast("bigint") % folds
    return df.withColumn(out, F.coalesce(fold, F.lit(0)).cast("int"))


def random_split(df: DataFrame, weights=(0.8, 0.2), seed: int = 42) -> list[DataFrame]:
    """Spark's sampling split (membership depends on partitioning)."""
    return df.randomSplit(list(weights), seed=seed)
