"""ICD-9 diagnosis expressions: coarse groups and named categories."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardflow.schema import (DIAG_CATEGORIES, DIAG_CATEGORY_OTHER, DIAG_GROUP_WIDTH,
                             DIAG_PREFIX_GROUPS, DIAG_UNKNOWN)


def _matches(code: Column, pattern: str) -> Column:
    """``code.rlike(pattern)``; an anchored plain prefix needs no regular expression."""
    return code.startswith(pattern[1:]) if re.fullmatch(r"\^[A-Za-z0-9]+", pattern) else code.rlike(pattern)


def diag_group(code: Column, prefix_groups=DIAG_PREFIX_GROUPS, width: int = DIAG_GROUP_WIDTH,
               unknown: str | None = DIAG_UNKNOWN) -> Column:
    """``^V`` -> V_Code, ``^E`` -> E_Code, else the first ``width`` characters; NULL -> ``unknown``."""
    expr = None
    for pattern, name in prefix_groups:
        cond = _matches(code, pattern)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    head = F.substring(code, 1, width)
    expr = head if expr is None else expr.when(code.isNotNull(), head)
    return F.coalesce(expr, F.lit(unknown)) if unknown is not None else expr


def _numeric_code(code: Column) -> Column:
    return F.when(code.rlike(r"^[0-9]+(\.[0-9]+)?$"), code.try_cast("double"))


def diag_category(code: Column, categories=DIAG_CATEGORIES, other: str = DIAG_CATEGORY_OTHER,
                  semantics: str = "lexical") -> Column:
    """Named ICD-9 chapter of a code; first matching rule wins.

    ``lexical`` compares the code text with the range bounds as strings, which
    is what the exploration flow did (so ``'5'`` falls in 460-519).
    ``numeric`` compares numbers instead and sends V/E codes to ``other``.
    """
    if semantics not in ("lexical", "numeric"):
        raise ValueError(semantics)
    num = _numeric_code(code)
    expr = None
    for name, like, ranges, exact in categories:
        conds = []
        if like is not None:
            conds.append(code.like(like))
        for lo, hi in ranges:
            if semantics == "lexical":
                conds.append((code >= F.lit(lo)) & (code <= F.lit(hi)))
            else:
                conds.append((num >= float(lo)) & (num < float(hi) + 1))
        for e in exact:
            conds.append(code == F.lit(e) if semantics == "lexical" else F.floor(num) == float(e))
        cond = conds[0]
        for c in conds[1:]:
            cond = cond | c
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    # A NULL code never matches; the chain's NULL is filled with ``other``.
    return F.coalesce(expr.otherwise(F.lit(other)), F.lit(other))
