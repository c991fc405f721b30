import math
import random
import re
from collections import Counter

import duckdb

from tests.llm.conftest import prose
from wardflow.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k=10):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    out = []
    for item, own in wanted.items():
        scored = []
        for i, c in counted:
            n = sum(c.values())
            m = 10 + (90 * n * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in own if t in c)
            if s > 0:
                scored.append((-s, i is None, i))
        scored.sort(key=lambda r: (r[0], r[1], r[2] or 0))
        out += [(item, rank, r[2], -r[0]) for rank, r in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r["item_id"], r["rank"], r["id"], r["score"]) for r in df.collect()), key=str)


ITEMS = "item_id long, text string, id long, score double"


def make_items(spark, items):
    return spark.createDataFrame([(i, t, 1, 0.5) for i, t in items], ITEMS)


def sample():
    docs = [(i, prose(i % 40, 5 + 7 * (i % 30), ("en", "fr", "de")[i % 3])) for i in range(200)]
    items = [(i, prose(i, 12, ("en", "fr", "de")[i % 3]) + " the the ing") for i in range(30)]
    return docs, items


def test_equals_brute_force(spark, make_docs, odd_texts):
    docs, items = sample()
    docs += [(300 + i, t) for i, t in enumerate(odd_texts)] + [(None, "THE ing nobody"), (5, "the the ing"), (5, "the the ing")]
    items += [(100, None), (101, ""), (102, "?!"), (103, "no-such terms_here"), (104, "the"), (104, "sh"), (105, "the"), (105, "the"), (106, "中文 É É é 1x")]
    for k in (10, 3):
        got = rows_of(lexical.search(make_docs([(i, t, None) for i, t in docs]).repartition(6), make_items(spark, items), k))
        assert got == plain(docs, items, k)


def test_blocks_of_items_give_the_same(spark, make_docs, monkeypatch):
    docs, items = sample()
    monkeypatch.setattr(lexical, "BLOCK_CHARS", 700)
    assert rows_of(lexical.search(make_docs([(i, t, None) for i, t in docs]), make_items(spark, items))) == plain(docs, items)


def test_equals_its_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    want = sorted(con.execute(f"SELECT item_id, rank, doc_id, score FROM ({lexical.OP11_SQL})").fetchall())
    got = sorted((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in lexical.op11_search(spark, sf).collect())
    assert got == want


def test_empty_tables(spark, make_docs):
    assert rows_of(lexical.search(make_docs([]), make_items(spark, [(1, "the")]))) == []
    assert rows_of(lexical.search(make_docs([(1, "the", None)]), make_items(spark, []))) == []
    assert rows_of(lexical.search(make_docs([(1, None, None), (2, "  ", None)]), make_items(spark, [(1, "the")]))) == []


def test_graph_adds_up_and_shares():
    rng = random.Random(3)
    for _ in range(30):
        vocabulary = rng.randint(1, 25)
        items = [frozenset(rng.sample(range(vocabulary), rng.randint(0, vocabulary))) for _ in range(rng.randint(1, 12))]
        g = lexical.share(items, vocabulary)
        own = [set() for _ in range(g.leaves)]
        for t in range(vocabulary):
            own[g.leaf_of[t]].add(t)
        for a, b in g.inner:
            assert not own[a] & own[b]
            own.append(own[a] | own[b])
        for item, parts in zip(items, g.parts, strict=True):
            assert sum(len(own[p]) for p in parts) == len(item)
            assert set().union(*(own[p] for p in parts)) == set(item)
        for i, a in enumerate(g.parts):
            for b in g.parts[i + 1:]:
                assert len(set(a) & set(b)) < 2
    shared = lexical.share([frozenset(range(20)), frozenset(range(18)), frozenset(range(5, 20))], 20)
    assert shared.leaves == 3 + 0 or shared.leaves <= 4
    assert sum(map(len, shared.parts)) + len(shared.inner) < 10
