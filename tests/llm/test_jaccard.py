import random
import re

import numpy as np
import pytest

from wardflow.llm import jaccard as J

from .conftest import prose


def by_hand(rows, n, percent):
    low = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    sets = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        sets.append((i, frozenset(tuple(w[j:j + n]) for j in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])))
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(x)] = find(y)
    low_id = {}
    for x, (i, s) in enumerate(sets):
        low_id[find(x)] = min(i, low_id.get(find(x), i))
    return sorted((i, len(s), low_id[find(x)]) for x, (i, s) in enumerate(sets))


def edited(text, rng, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice(["new", "other", "word", "text"])
    return " ".join(words)


def family(seed, size=120, copies=12, most=4):
    rng = random.Random(seed)
    text = prose(seed, size)
    return [edited(text, rng, rng.randint(0, most)) for _ in range(copies)]


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80), (1, 50), (3, 100)])
def test_by_hand(make_docs, odd_texts, n, percent, monkeypatch):
    texts = odd_texts + ["A b C", "a B c", "a b", "a b c d", "a b d", "İ b c", "one two three four five six seven eight nine ten", "ONE two three four five six seven eight nine ten"]
    for seed in range(8):
        texts += family(seed, size=[6, 12, 30, 60, 120, 200, 300, 500][seed], most=[1, 1, 2, 3, 4, 6, 8, 12][seed])
    rows = list(enumerate(texts))
    random.Random(5).shuffle(rows)
    got = J.jaccard_components(make_docs([(i, t, None) for i, t in rows]).repartition(3), n, percent).collect()
    assert sorted((r["id"], r["n_shingles"], r["component_id"]) for r in got) == by_hand(rows, n, percent)


def test_crowds(make_docs, monkeypatch):
    """Groups larger than a crowd's bound, compared blockwise."""
    monkeypatch.setattr(J, "BLOCK", 8)
    texts = [t for seed in range(2) for t in family(seed, size=80, copies=150, most=5)]
    rows = list(enumerate(texts))
    got = J.jaccard_components(make_docs([(i, t, None) for i, t in rows]), 3, 90).collect()
    assert sorted((r["id"], r["n_shingles"], r["component_id"]) for r in got) == by_hand(rows, 3, 90)


def test_ids_nulls_repeats_and_empty_table(make_docs):
    rows = [(5, "a b c d e", None), (5, "a b c d e", None), (None, "a b c d e", None), (2, None, None), (3, "", None), (None, "x y z", None)]
    got = [(r["id"], r["n_shingles"], r["component_id"]) for r in J.jaccard_components(make_docs(rows), 3, 90).collect()]
    assert sorted(got, key=str) == sorted([(5, 3, 5), (5, 3, 5), (None, 3, 5), (2, 0, 2), (3, 0, 3), (None, 1, None)], key=str)
    assert J.jaccard_components(make_docs(rows).filter("false"), 3, 90).count() == 0
    kept = J.keep_one_of_each(make_docs(rows), 3, 90)
    assert kept.columns == make_docs(rows).columns
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in kept.collect()) == [("2", "None"), ("3", ""), ("None", "a b c d e"), ("None", "x y z")] or \
        sorted((str(r["doc_id"]), str(r["text"])) for r in kept.collect()) == [("2", "None"), ("3", ""), ("5", "a b c d e"), ("None", "x y z")]


def test_signatures_meet_for_all_linked_sets():
    """Pairs at the very edge of the similarity share as many signatures as ``shared_signatures`` asks for, for all sizes and both allocations."""
    rng = np.random.default_rng(1)
    for percent in (80, 90):
        for classes in (10, 10**7):
            plans = {b: J.plan(high, low, percent, classes) for b, low, high in J.bands(400)}
            for _ in range(300):
                size = int(rng.integers(1, 300))
                s = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
                drop = int(rng.integers(0, size // 4 + 1))
                add = int(rng.integers(0, size // 4 + 1))
                t = np.unique(np.concatenate([s[drop:], rng.integers(0, 2**63, add, dtype=np.uint64)]))
                both = len(np.intersect1d(s, t))
                if len(t) and 100 * both >= percent * (len(s) + len(t) - both):
                    assert weight(J.signatures(s, percent, plans), J.signatures(t, percent, plans)) >= J.AGREE


def weight(x, y):
    """What a pair's common signatures count for, as they travel: shortened."""
    both = np.intersect1d(J._long(J._short(x)), J._long(J._short(y)))
    return int(np.where(both & (J.SINGLE >> np.uint64(64 - 8 * J.SIG_BYTES)), J.AGREE, 1).sum())


def test_two_segments_agree_at_the_edge():
    """Sets with the fewest common n-grams that link them, whatever segments the others fall in."""
    rng = np.random.default_rng(7)
    for percent, size in ((80, 130), (80, 650), (90, 60), (90, 300)):
        plans = {b: J.plan(high, low, percent, 10) for b, low, high in J.bands(2 * size)}
        for _ in range(60):
            s = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
            smaller = -(-percent * size // 100)
            for t in (s[:smaller], np.unique(np.concatenate([s[:(both := -(-percent * 2 * size // (100 + percent)))],
                                                             rng.integers(0, 1 << 63, size - both).astype(np.uint64)]))):
                one, other = J.signatures(s, percent, plans), J.signatures(t, percent, plans)
                assert not np.any(one & J.SINGLE) and weight(one, other) >= J.AGREE


def test_plan_uses_both_allocations():
    assert any(J.plan(high, low, 90, 10**9)[2] for _, low, high in J.bands(100))  # one-deletion where segments are small
    assert J.plan(600, 401, 90, 10**5)[2] == 0


def test_sketch_bounds_the_difference():
    rng = np.random.default_rng(2)
    for _ in range(50):
        s = np.unique(rng.integers(0, 2**63, 500, dtype=np.uint64))
        t = np.unique(np.concatenate([s[int(rng.integers(0, 200)):], rng.integers(0, 2**63, 50, dtype=np.uint64)]))
        bits = J._bits([J.sketch(s), J.sketch(t)])
        assert np.bitwise_count(bits[0] ^ bits[1]).sum() <= len(np.setxor1d(s, t))


def test_sketches_of_large_sets_fold():
    rng = np.random.default_rng(6)
    for size, other in ((900, 1100), (3000, 5000), (6000, 6000), (40_000, 50_000)):
        s = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
        t = np.unique(np.concatenate([s[100:], rng.integers(0, 2**63, other - size + 50, dtype=np.uint64)]))
        u = np.unique(rng.integers(0, 2**63, other, dtype=np.uint64))
        x, y, z = J.sketch(s), J.sketch(t), J.sketch(u)
        near, far = J._apart([x, x], [y, z])
        assert near <= len(np.setxor1d(s, t)) and np.array_equal(J._bits([y], 8 * min(len(x), len(y))), J._bits([y[:len(y)]], 8 * min(len(x), len(y))))
        if other <= J.MOST_SKETCH_BITS:
            assert far > J.difference(len(s), len(u), 80)  # unrelated sets don't pass


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (103, 101), (104, 103), (200, 200)]
    got = {r["node"]: r["label"] for r in J.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, 100: 100, 101: 100, 103: 100, 104: 100}


def test_sets_that_are_deficient_in_all_families_meet():
    rng = np.random.default_rng(3)
    for percent in (10, 20, 30, 50, 60):
        plans = {b: J.plan(high, low, percent, 1_000_000) for b, low, high in J.bands(60)}
        for size in (2, 5, 9, 20):
            for _ in range(40):
                s = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
                both = -(-percent * 2 * size // (100 + percent))  # the fewest that link two sets of this size
                t = np.unique(np.concatenate([s[:both], rng.integers(0, 1 << 63, size - both).astype(np.uint64)]))
                if 100 * both >= percent * (len(s) + len(t) - both):
                    assert weight(J.signatures(s, percent, plans), J.signatures(t, percent, plans)) >= J.AGREE, (percent, size)


def test_parameters_in_use_need_no_single_grams():
    rng = np.random.default_rng(4)
    for percent in (80, 90):
        plans = {b: J.plan(high, low, percent, 1000) for b, low, high in J.bands(400)}
        for size in (1, 7, 40, 200, 400):
            s = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
            single = {int(x) for b, _, _ in J.band_list(len(s)) for x in J.mix64(s ^ np.uint64((2 * b + 2) * 0xD6E8FEB86659FD93 % (1 << 64))) | J.SINGLE}
            assert single.isdisjoint(map(int, J.signatures(s, percent, plans)))


def test_no_pair_is_lost_if_no_family_can_do():
    s = np.arange(1, 11).astype(np.uint64)
    plans = {b: (5, 1, 0) for b, _, _ in J.bands(40)}  # one segment, where six would be needed
    assert weight(J.signatures(s, 50, plans), J.signatures(s[:-3], 50, plans)) >= J.AGREE


def test_blocks_are_dealt_by_block(make_docs):
    """Not by signature: that would leave all blocks of a crowd to one task."""
    spark = make_docs([]).sparkSession
    crowds = spark.createDataFrame([], "a long, places array<struct<sig:long,own:int,blocks:int>>, size long, sketch binary")
    sets = spark.createDataFrame([], "cid long, body binary")
    labels = spark.createDataFrame([], "node long, label long")
    join = J.Join(make_docs([(1, "a b c", None)]), 3, 90, "doc_id", "text")
    plan = join.crowded_links(crowds, labels, sets)._jdf.queryExecution().toString()
    assert "REPARTITION_BY_COL" in plan and "hashpartitioning(sig" in plan and "i#" in plan.split("hashpartitioning(sig", 1)[1][:40]


def test_thousands_of_near_copies(make_docs, monkeypatch):
    """Copies of one text, each linked to it and to few others: one component, and few rows to find it."""
    made = []
    stage = J.stage
    monkeypatch.setattr(J, "stage", lambda df, name: made.append((name, stage(df, name))) or made[-1][1])
    rng = random.Random(9)
    text = prose(77, 160)
    texts = [text] + [edited(text, rng, 2) for _ in range(3000)] + [prose(1000 + i, 100) for i in range(50)]
    got = J.jaccard_components(make_docs([(i, t, None) for i, t in enumerate(texts)]).repartition(4), 3, 90).collect()
    assert {r["component_id"] for r in got if r["id"] <= 3000} == {0}
    assert sum(r["component_id"] == r["id"] for r in got) == 51
    rows = {name: df.count() for name, df in made}
    assert rows["undecided"] < 20 * len(texts) and rows["links-1"] < 20 * len(texts)


def crowd_rows(spark, crowds, labels):
    """Classes of the given crowds (lists of class ids), as ``around_centres`` and ``crowded_links`` take them."""
    places = {}
    for sig, members in enumerate(crowds, 1):
        for at, a in enumerate(members):
            places.setdefault(a, []).append((sig, at // J.BLOCK, -(-len(members) // J.BLOCK)))
    return (spark.createDataFrame([(a, p, 100, bytes(128)) for a, p in places.items()],
                                  "a long, places array<struct<sig:long,own:int,blocks:int>>, size long, sketch binary"),
            spark.createDataFrame(list(labels.items()), "node long, label long"))


def test_crowds_of_the_same_classes_are_compared_once(make_docs, monkeypatch):
    """Copies of one text share many signatures: a class is dealt once, not once for each of them."""
    made = {}
    stage = J.stage
    monkeypatch.setattr(J, "stage", lambda df, name: made.setdefault(name, stage(df, name)))
    docs = make_docs([(1, "a b c", None)])
    crowds, labels = crowd_rows(docs.sparkSession, [range(60)] * 15, {a: 0 for a in range(40)})
    join = J.Join(docs, 3, 90, "doc_id", "text")
    sets = docs.sparkSession.createDataFrame([(a, np.arange(100, dtype=np.uint64).tobytes()) for a in range(60)], "cid long, body binary")
    links = join.crowded_links(crowds, labels, sets).collect()
    assert made["undecided"].count() == 20 + 59  # 20 classes as rows, all but the first of them as columns; 15 times that many before
    assert len({x for r in links for x in (r["a"], r["b"])} - set(range(40))) == 20


def test_crowds_with_little_in_common_stay_apart(make_docs):
    """Each with a few classes of one component and others of its own: together they would be compared for nothing."""
    docs = make_docs([(1, "a b c", None)])
    own = [range(100 * k, 100 * k + 50) for k in range(1, 9)]
    crowds, labels = crowd_rows(docs.sparkSession, [[*range(5), *x] for x in own], {a: 10_000 for a in range(5)})
    got = J.Join(docs, 3, 90, "doc_id", "text").split_crowds(crowds, labels).collect()
    assert sorted((r["sig"], r["a"]) for r in got) == sorted((sig, a) for sig, x in enumerate(own, 1) for a in [*range(5), *x])
    assert {(r["major"], r["n"], r["minors"]) for r in got} == {(10_000, 55, 50)}
