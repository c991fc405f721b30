"""Profiling aggregates: counts, missing rates, frequencies, means, modes, previews.

Every profile is a single aggregate job with map-side partial aggregation; the
shuffle carries (group, partial) pairs only, never raw rows. Wide profiles over
many columns use one Expand (``unpivot``) instead of one job per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.schema import LABEL, q


def row_count(df: DataFrame) -> DataFrame:
    """One row: number of rows and number of columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).cast("bigint").alias("n_columns"))


def missing_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column: NULL count and NULL percentage, all columns in one scan.

    Returns long form ``(column_name, n_missing, missing_pct)``.
    """
    cols = list(df.columns if cols is None else cols)
    wide = df.agg(F.count(F.lit(1)).alias("__n"),
                  *[F.count_if(F.col(q(c)).isNull()).alias(f"__m{i}") for i, c in enumerate(cols)])
    stacked = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"__m{i}").alias("n_missing")) for i, c in enumerate(cols)]))
    return (wide.select("__n", stacked.alias("kv"))
            .select(F.col("kv.column_name").alias("column_name"),
                    F.col("kv.n_missing").alias("n_missing"),
                    (F.col("kv.n_missing") / F.col("__n") * 100).alias("missing_pct")))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(F.col(q(col))).distinct()


def value_counts(df: DataFrame, col: str, order: bool = False) -> DataFrame:
    """Frequency table ``(col, count)``; with ``order`` most frequent first, ties by value."""
    out = df.groupBy(F.col(q(col))).agg(F.count(F.lit(1)).alias("count"))
    if order:
        out = out.orderBy(F.desc("count"), F.asc_nulls_first(q(col)))
    return out


def numeric_means(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row of means (NULLs ignored), one column per input column."""
    return df.agg(*[F.avg(F.col(q(c))).alias(c) for c in cols])


def value_frequencies(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Long form ``(column_name, value, n)`` of non-NULL values over many columns, one shuffle.

    ``unpivot`` becomes an Expand feeding a partial hash aggregate, so each task
    ships one row per distinct (column, value) it saw; a value held by a third
    of all rows is pre-aggregated on the map side like any other.
    """
    cols = list(cols)
    as_text = df.select(*[F.col(q(c)).cast("string").alias(c) for c in cols])
    stacked = as_text.unpivot([], cols, "column_name", "value")
    return (stacked.where(F.col("value").isNotNull())
            .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n")))


def column_modes(df: DataFrame, cols: Sequence[str], with_cardinality: bool = False) -> DataFrame:
    """Most frequent non-NULL value per column, ties to the smallest value.

    ``(column_name, mode_value, mode_count[, n_distinct])``. The second
    aggregate runs over distinct (column, value) pairs only, so the number of
    distinct values per column comes for free.
    """
    out = modes_of(value_frequencies(df, cols))
    return out if with_cardinality else out.drop("n_distinct")


def modes_of(freq: DataFrame, **more) -> DataFrame:
    """``(column_name, mode_value, mode_count, n_distinct)`` of a :func:`value_frequencies` table, and further aggregates of it by name."""
    best = F.min_by(F.struct(F.col("value"), F.col("n")), F.struct((-F.col("n")).alias("k"), F.col("value")))
    out = freq.groupBy("column_name").agg(best.alias("m"), F.count(F.lit(1)).alias("n_distinct"), *[c.alias(name) for name, c in more.items()])
    return out.select("column_name", F.col("m.value").alias("mode_value"), F.col("m.n").alias("mode_count"), "n_distinct", *more)


def class_counts(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Positive and negative counts of a 0/1 label in one pass."""
    lab = F.col(q(label))
    return df.agg(F.count_if(lab == 1.0).alias("n_positive"), F.count_if(lab == 0.0).alias("n_negative"))


def preview(df: DataFrame, n: int, keys: Sequence[str]) -> DataFrame:
    """First ``n`` rows by ``keys`` (a per-partition top-k, then one small merge)."""
    return df.orderBy(*[F.col(q(k)) for k in keys]).limit(n)
