"""Wide projections run as compiled code and give what the plain forms give."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from wardflow.functions.diagnosis import diag_group
from wardflow.functions.indicators import count_groups_present, count_values_in
from wardflow.operators import encode as E
from wardflow.operators.score import validate_records
from wardflow.session import COMPILED_BYTES, HUGE_METHOD, compiled
from wardflow.sources.fixtures import RULES, _spark_rule, encounters_from_lineitem


def test_methods_the_jvm_would_interpret_are_left(spark):
    other = spark.newSession()
    other.conf.set(HUGE_METHOD, "65535")
    assert compiled(other).conf.get(HUGE_METHOD) == str(COMPILED_BYTES)
    other.conf.set(HUGE_METHOD, "100")
    assert compiled(other).conf.get(HUGE_METHOD) == "100"


def test_derivation_evaluates_no_lambda(spark):
    line = spark.range(3).selectExpr("id AS l_orderkey", "id AS l_partkey", "id AS l_suppkey", "id AS l_linenumber")
    assert "lambda" not in encounters_from_lineitem(line)._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["time_in_hospital", "num_medications", "age", "diag_1", "metformin", "weight"])
def test_each_byte_has_its_value(spark, name):
    rule = RULES[name]
    got = [r[0] for r in spark.range(256).select(F.col("id").cast("int").alias(f"_b{rule[1]}")).select(_spark_rule(name, rule)).collect()]
    plain = {"time_in_hospital": lambda b: str(1 + b % 14), "num_medications": lambda b: str(1 + b % 60) if b < 250 else "?",
             "age": lambda b: f"[{b % 10 * 10}-{b % 10 * 10 + 10})", "diag_1": lambda b: rule[2][b % 24],
             "metformin": lambda b: "No" if b < 200 else "Steady" if b < 230 else "Up" if b < 243 else "Down",
             "weight": lambda b: "?" if b < 248 else "[75-100)"}[name]
    assert got == [plain(b) for b in range(256)]


@pytest.mark.parametrize("searched", [0, 2, 64])
def test_indexer_equals_mllib(spark, monkeypatch, searched):
    monkeypatch.setattr(E, "SEARCHED_LABELS", searched)
    rows = spark.createDataFrame([("a", "x", None), ("b", None, None), ("a", "y", None), ("c", "x", None), (None, "ａ", None)], "p string, `q-r` string, s string")
    theirs = E.index_categories(["p", "q-r", "s"]).fit(rows)
    ours = E.CategoryIndexer(["p", "q-r", "s"], theirs.labelsArray)
    unseen = spark.createDataFrame([("z", "", "n"), (None, None, None)], rows.schema)
    for frame in (rows, unseen):
        a, b = theirs.transform(frame), ours.transform(frame)
        assert [a.schema[c].metadata for c in a.columns] == [b.schema[c].metadata for c in a.columns]
        assert a.collect() == b.select(a.columns).collect()


def test_counts_and_groups_equal_plain_python(spark):
    rows = [("250", "250", None), ("V45", "428", "E9"), (None, None, None), ("5", "xV", "428"), ("250", "428", "414")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    cols, groups = [F.col("a"), F.col("b"), F.col("c")], ["250", "428", "414"]
    many = groups + [f"g{i}" for i in range(70)]
    out = df.select(count_groups_present(cols, groups), count_groups_present(cols, many), count_values_in(cols, ["250", "xV"]), diag_group(F.col("a"))).collect()
    for row, r in zip(rows, out):
        n = len({x for x in row if x in groups})
        head = "UNK" if row[0] is None else "V_Code" if row[0].startswith("V") else "E_Code" if row[0].startswith("E") else row[0][:3]
        assert tuple(r) == (n, n, sum(x in ("250", "xV") for x in row), head)


def test_reasons_of_faulty_records_only(spark):
    df = spark.createDataFrame([("1", "x"), (None, "2"), ("?", "?"), ("1", "2"), (None, "z")], "a string, b string")
    got = [r["reason"] for r in validate_records(df, ["a", "b", "c"], ["b"]).collect()]
    assert got == ["missing:c;not_integer:b", "missing:a;missing:c", "missing:c", "missing:c", "missing:a;missing:c;not_integer:b"]
    got = [r["reason"] for r in validate_records(df, ["a", "b"], ["b"]).collect()]
    assert got == ["not_integer:b", "missing:a", None, None, "missing:a;not_integer:b"]
