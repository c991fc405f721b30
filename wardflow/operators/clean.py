"""Projections, filters and cleaning (missing tokens, drops, labels, casts, constant fills).

Each operator is one ``select``/``where`` so Catalyst sees a single Project or
Filter per step and the scan is pruned to what is used.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.schema import (DROP_COLUMNS, LABEL, MISSING_TOKEN, NEGATIVE_CLASS, NUMERIC_COLUMNS,
                             STRICT_LABEL_MAP, TARGET, WEIGHT, q)


def _string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def null_tokens(df: DataFrame, tokens: Sequence[str] = (MISSING_TOKEN,),
                cols: Sequence[str] | None = None) -> DataFrame:
    """Replace missing-value tokens with NULL in string columns (one projection).

    Only string columns are compared: comparing an int column with ``'?'``
    would raise under ANSI casting.
    """
    targets = set(_string_columns(df) if cols is None else cols) & set(_string_columns(df))
    tokens = list(tokens)

    def fix(name: str) -> Column:
        c = F.col(q(name))
        if len(tokens) == 1:
            return F.nullif(c, F.lit(tokens[0])).alias(name)
        return F.when(c.isin(*tokens), F.lit(None).cast("string")).otherwise(c).alias(name)

    return df.select(*[fix(c) if c in targets else F.col(q(c)) for c in df.columns])


def drop_columns(df: DataFrame, cols: Sequence[str] = tuple(DROP_COLUMNS)) -> DataFrame:
    """Drop the listed columns that exist (absent names are ignored)."""
    return df.drop(*[c for c in cols if c in df.columns])


def binary_label(df: DataFrame, src: str = TARGET, negative: str = NEGATIVE_CLASS,
                 on_null: str = "positive", out: str = LABEL) -> DataFrame:
    """``negative`` -> 0.0, every other value -> 1.0; the source column is dropped.

    ``on_null='positive'`` counts a NULL target as 1.0 (the training flow's
    rule); ``'null'`` keeps it NULL. A frame without ``src`` is returned as is.
    """
    if src not in df.columns:
        return df
    c = F.col(q(src))
    if on_null == "positive":
        label = F.when(c == F.lit(negative), F.lit(0.0)).otherwise(F.lit(1.0))
    elif on_null == "null":
        label = F.when(c.isNull(), F.lit(None)).when(c == F.lit(negative), F.lit(0.0)).otherwise(F.lit(1.0))
    else:
        raise ValueError(on_null)
    return df.select(*[F.col(q(x)) for x in df.columns if x != src], label.cast("double").alias(out))


def strict_label(df: DataFrame, src: str = TARGET, mapping: Mapping[str, float] = STRICT_LABEL_MAP,
                 out: str = LABEL) -> DataFrame:
    """Map listed target values to a double label; others become NULL and their rows are dropped."""
    c = F.col(q(src))
    expr = None
    for value, lab in mapping.items():
        expr = F.when(c == F.lit(value), F.lit(float(lab))) if expr is None else expr.when(c == F.lit(value), F.lit(float(lab)))
    labelled = df.select(*[F.col(q(x)) for x in df.columns if x != src], expr.cast("double").alias(out))
    return labelled.where(F.col(out).isNotNull())


def cast_numeric(df: DataFrame, cols: Sequence[str] = tuple(NUMERIC_COLUMNS), to: str = "int",
                 strict: bool = False) -> DataFrame:
    """Cast listed columns to ``to``; malformed text becomes NULL unless ``strict``."""
    wanted = set(cols)

    def conv(name: str) -> Column:
        c = F.col(q(name))
        return (c.cast(to) if strict else c.try_cast(to)).alias(name)

    return df.select(*[conv(c) if c in wanted else F.col(q(c)) for c in df.columns])


def filter_label(df: DataFrame, value: float, label: str = LABEL) -> DataFrame:
    return df.where(F.col(q(label)) == F.lit(float(value)))


def drop_null_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(cols))


def project(df: DataFrame, columns: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Pick columns, optionally renamed: ``{"source": "alias"}`` or a list of names."""
    if isinstance(columns, Mapping):
        return df.select(*[F.col(q(src)).alias(dst) for src, dst in columns.items()])
    return df.select(*[F.col(q(c)) for c in columns])


def fill_constant(df: DataFrame, mapping: Mapping[str, object]) -> DataFrame:
    """Fill NULLs of the listed columns with constants (one projection)."""
    return df.select(*[
        F.coalesce(F.col(q(c)), F.lit(mapping[c]).cast(df.schema[c].dataType)).alias(c) if c in mapping else F.col(q(c))
        for c in df.columns])


def infer_roles(schema: T.StructType, exclude: Iterable[str] = (LABEL, WEIGHT)) -> dict[str, list[str]]:
    """Categorical = string columns, numeric = any numeric type; excluded names skipped."""
    skip = set(exclude)
    categorical = [f.name for f in schema.fields if f.name not in skip and isinstance(f.dataType, T.StringType)]
    numeric = [f.name for f in schema.fields if f.name not in skip and isinstance(f.dataType, T.NumericType)]
    return {"categorical": categorical, "numeric": numeric}


def clean(df: DataFrame, drop: Sequence[str] = tuple(DROP_COLUMNS), numeric: Sequence[str] = tuple(NUMERIC_COLUMNS),
          target: str = TARGET, strict_cast: bool = False) -> DataFrame:
    """Missing tokens -> NULL, drop ids and sparse columns, binary label, numeric casts."""
    out = null_tokens(df)
    out = drop_columns(out, drop)
    out = binary_label(out, target)
    return cast_numeric(out, [c for c in numeric if c in out.columns], strict=strict_cast)
