"""Indicator counts and safe ratios, each a single JVM expression.

Counts over many columns are written as one array expression rather than a
long chain of ``+``: inside a wide projection a 20-term chain makes the
generated method too large for the JIT, and the whole stage runs interpreted.
Functions with a lambda are avoided: Spark evaluates them without generated code.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_groups_present(group_cols: Sequence[Column], groups: Sequence[str]) -> Column:
    """How many of ``groups`` occur in any of ``group_cols`` (each group counted once, NULL ignored)."""
    # one bit for each group's place in the list; bit 0 stands for none of them
    wanted, bits = F.array(*[F.lit(g) for g in groups]), F.lit(0).cast("bigint")
    if len(groups) > 62:
        return F.size(F.array_intersect(F.array(*group_cols), wanted)).cast("int")
    for c in group_cols:
        at = F.coalesce(F.array_position(wanted, c), F.lit(0)).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), at))
    return F.bit_count(bits.bitwiseAND(F.lit(-2).cast("bigint"))).cast("int")


def count_values_in(cols: Sequence[Column], values: Sequence[str]) -> Column:
    """Number of ``cols`` whose value is one of ``values`` (NULL counts 0)."""
    every = F.array(*cols)
    others = every
    for v in values:
        others = F.array_remove(others, v)
    return (F.size(every) - F.size(others)).cast("int")


def ratio(numerator: Column, denominator: Column, default: float | None = None) -> Column:
    """``numerator / denominator`` as double; NULL (or ``default``) when the denominator is 0."""
    r = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return F.coalesce(r, F.lit(default).cast("double")) if default is not None else r
