"""Each stage over a small planted corpus, and the whole run."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import corpus_pipeline as P  # noqa: E402

from .conftest import prose  # noqa: E402
from .test_packing import check  # noqa: E402


def plant(spark, make_docs, folder):
    rows, labels = [], []
    for i in range(240):
        rows.append((i, prose(i, 60 + i % 30, ("en", "fr", "de")[i % 3]), ("en", "fr", "de")[i % 3]))
        labels.append((i, 1, 0))
    for i in range(240, 300):
        rows.append((i, " ".join(w.upper() + "!!" for w in prose(i, 60).split()), "en"))
        labels.append((i, 0, 0))
    rows += [(1000 + i, prose(i, 60 + i % 30, ("en", "fr", "de")[i % 3]), "en") for i in range(10)]  # exact copies
    rows += [(2000 + i, prose(i, 60 + i % 30, ("en", "fr", "de")[i % 3]) + " end", "en") for i in range(10)]  # near copies
    rows += [(3000, None, None), (3001, "", None), (3002, "12 34 56 " * 20, None), (0, rows[0][1], "en")]
    make_docs(rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return rows


def test_run(spark, make_docs, tmp_path):
    rows = plant(spark, make_docs, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    for name, step in P.STAGES[:-1]:
        docs = step(spark, docs, str(tmp_path))
        assert docs.columns == columns, name
        docs.write.parquet(f"{tmp_path}/{name}.parquet")
        docs = spark.read.parquet(f"{tmp_path}/{name}.parquet")
    kept = {name: {r["doc_id"] for r in spark.read.parquet(f"{tmp_path}/{name}.parquet").select("doc_id").collect()} for name, _ in P.STAGES[:-1]}
    assert {3000, 3001, 3002}.isdisjoint(kept["language"]) and set(range(300)) <= kept["language"]
    assert set(range(240)) <= kept["quality"] and set(range(240, 300)).isdisjoint(kept["quality"])
    assert kept["near_duplicates"] == set(range(240)) and docs.count() == 240
    out = P.run(spark, str(tmp_path)).collect()
    assert check(out, [(i, t) for i, t, _ in rows[:240]]) < 0.05


def test_empty_documents(spark, make_docs, tmp_path):
    make_docs([(1, "a", "en")]).filter("false").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0


def test_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names and sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))
