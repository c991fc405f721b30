import random
import re
from collections import defaultdict

import numpy as np

from wardflow.llm import quality as Q

from .conftest import prose


def by_hand(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    at = defaultdict(list)
    for i in range(len(w) - 7):
        at[tuple(w[i:i + 8])].append(i)
    covered = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_counts_by_hand(odd_texts):
    rng = random.Random(1)
    texts = odd_texts + ["a b c d e f g h " * 3, "same\nsame\n \n\nsame \nsame", "\x0b\x0c|x|\r<b>#", "a b c d e f g h i a b c d e f g h",
                         "w " * 7, "w " * 8, "w " * 9, "\xa0 is no blank"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) for _ in range(60)]
    got = Q.QualityModel().predict(texts)
    for text, row in zip(texts, got.itertuples(index=False), strict=True):
        assert tuple(row[:5]) == by_hand(text), repr(text)[:50]
        assert row.base_failed == (row.n_words < 20 or 100 * row.n_repeat_words > 30 * row.n_words)
        assert row.kept == (not row.base_failed)  # no classifier: the base rules alone


def corpus(make_docs, spark, n=240):
    rows, labels = [], []
    for i in range(n):
        good = i % 2
        text = prose(i, 60 + i % 40)
        rows.append((i, text if good else " ".join(w.upper() + "!!" for w in text.split()), None))
        labels.append((i, good, 0))
    return make_docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_learns_and_holds_out(make_docs, spark):
    docs, labels = corpus(make_docs, spark)
    model = Q.train(docs, labels.filter("doc_id < 160"), rounds=100)
    out = Q.add_quality(docs.filter("doc_id >= 160"), model).collect()
    assert all(r["kept"] == bool(r["doc_id"] % 2) for r in out) and all(0 <= r["quality"] <= 1 for r in out)
    kept = Q.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.first()["kept"] is True  # a column of that name stays as it was


def test_labels_odd(make_docs, spark):
    docs, labels = corpus(make_docs, spark, 40)
    odd = spark.createDataFrame([(None, 1, 0), (1, None, 0), (999, 0, 0), (3, 1, 0), (3, 0, 0)], labels.schema)
    assert Q.train(docs, odd.filter("doc_id is null or quality is null or doc_id = 999")).weights is None
    assert Q.train(docs, labels.filter("quality = 1")).weights is None
    assert Q.train(docs, labels.filter("false")).weights is None
    assert Q.train(docs, labels.unionByName(odd), rounds=20).weights is not None


def test_odd_rows(make_docs, spark, odd_texts):
    docs, labels = corpus(make_docs, spark, 40)
    model = Q.train(docs, labels, rounds=20)
    rows = make_docs([(i, t, None) for i, t in enumerate(odd_texts)] + [(50, prose(1, 40), None)] * 2 + [(None, prose(2, 40), None)])
    out = Q.add_quality(rows, model).collect()
    assert len(out) == len(odd_texts) + 3 and not any(r["kept"] for r in out if not (r["text"] or "").strip())
    assert Q.add_quality(rows.filter("false"), model).count() == 0


def test_batches_do_not_matter(monkeypatch):
    texts = [prose(i, 30) for i in range(20)]
    w = np.random.default_rng(0).normal(size=(3, 1 << Q.BITS))
    whole = Q.QualityModel(w).predict(texts)
    monkeypatch.setattr(Q, "STEP_CHARS", 200)
    parts = Q.QualityModel(w).predict(texts)
    assert np.allclose(whole["quality"], parts["quality"]) and whole.drop(columns="quality").equals(parts.drop(columns="quality"))


def test_calibrated_on_held_out_rows(spark):
    """Trained without a quarter of the labelled rows: on those, probabilities are what they say, and few good rows go."""
    from pyspark.sql import functions as F

    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    out = F.pmod(F.xxhash64("doc_id", F.lit("test")), F.lit(4)) == 0
    model = Q.train(docs, labels.filter(~out))
    rows = Q.add_quality(docs.join(labels.filter(out), "doc_id").select("doc_id", "text", F.col("quality").alias("good")).withColumnRenamed("good", "y"), model) \
        .select("y", "quality", "kept", "base_failed").toPandas()
    p, y = rows["quality"].to_numpy(), rows["y"].to_numpy() > 0
    order = p.argsort()
    ranks = np.empty(len(p))
    ranks[order] = np.arange(1, len(p) + 1)
    auc = (ranks[y].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (~y).sum())
    bins = np.minimum((p * 10).astype(int), 9)
    error = sum(abs(p[bins == b].mean() - y[bins == b].mean()) * (bins == b).mean() for b in np.unique(bins))
    figures = dict(rows=len(p), good=y.mean(), mean_p=p.mean(), auc=auc, error=error, good_kept=rows["kept"][y].mean(), bad_kept=rows["kept"][~y].mean(),
                   good_failed_base=rows["base_failed"][y].mean())
    print(figures)
    assert abs(p.mean() - y.mean()) < 0.04 and error < 0.06 and auc > 0.97, figures
    assert figures["good_kept"] > 0.95 and figures["bad_kept"] < 0.1, figures
