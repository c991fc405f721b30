"""Every exact query against its DuckDB twin at sf0.001 (the driver's check, smaller)."""

import math

import pytest

import __spark_entry__ as E
from wardflow.plans.model_queries import MODEL_QUERIES
from wardflow.plans.queries import REGISTRY

from conftest import SF_SMALL

BASE = set(REGISTRY) | set(MODEL_QUERIES)
EXACT = sorted(set(E.oracle_sql()) & BASE)  # those of the corpus operators are tested with them


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return (0, "")
    return (1, v)


def _rows(records, names):
    return sorted(tuple(_norm(r[n]) for n in names) for r in records)


def test_every_registered_query_is_classified():
    assert set(E.queries()) >= BASE and set(E.oracle_sql()) <= set(E.queries())
    assert set(EXACT) == BASE and len(BASE) == 58


@pytest.mark.parametrize("key", EXACT)
def test_query_matches_sql_twin(spark, duck, key):
    sdf = E.queries()[key](spark, SF_SMALL)
    srows = [r.asDict() for r in sdf.collect()]
    cur = duck.execute(E.oracle_sql()[key])
    names = [d[0] for d in cur.description]
    drows = [dict(zip(names, r)) for r in cur.fetchall()]
    assert sorted(sdf.columns) == sorted(names)
    assert len(srows) == len(drows)
    cols = sorted(names)
    assert _rows(srows, cols) == _rows(drows, cols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "classWeight" in df.columns and "comorbidity_count" in df.columns
