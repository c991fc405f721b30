import numpy as np
import pytest

from wardflow.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int, ids string, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], SCHEMA)


def by_hand(rows, k=20):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, q in good:
        if i % 20 == 0:
            out[i] = sorted(((-float((x * q).sum()), j) for j, x in good if j != i))[:k]
    return out


def random_rows(n, d=16, seed=0, centres=12):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centres, d))
    x = c[rng.integers(0, centres, n)] + 0.4 * rng.normal(size=(n, d))
    return [(i, [float(np.float32(y)) for y in v]) for i, v in enumerate(x)]


def test_recall_and_scores(spark):
    rows = random_rows(3000)
    want = by_hand(rows)
    got = {}
    for r in ann.search(frame(spark, rows)).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    x = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    assert set(got) == set(want)
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert all(abs(s - float((x[v] * x[q]).sum())) < 1e-12 for _, v, s in found)
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)
        hits += len({v for _, v, _ in found} & {v for _, v in want[q]})
    assert hits / (20 * len(want)) >= 0.9


def test_hot_vector_ties_to_smaller_ids(spark):
    hot = [1.0] * 8
    rows = [(i, hot) for i in range(0, 400)] + [(400 + i, v[:8]) for i, v in random_rows(100, 8)]
    got = {}
    for r in ann.search(frame(spark, rows), recall=1.0).filter("query_id < 400").collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    want = by_hand(rows)
    assert {q: [m[r] for r in sorted(m)] for q, m in got.items()} == {q: [v for _, v in f] for q, f in want.items() if q < 400}


def test_odd_vectors(spark):
    rows = [(0, [1.0, 2.0, 3.0]), (1, [1.0, 0.0, 0.0]), (2, None), (3, []), (4, [0.0, 0.0, 0.0]), (5, [1.0, None, 2.0]), (6, [float("nan"), 1.0, 1.0]),
            (7, [float("inf"), 1.0, 1.0]), (8, [1.0, 2.0]), (20, [1.0, 0.0, 0.0]), (20, [1.0, 0.0, 0.0]), (None, [1.0, 1.0, 1.0]), (40, None), (9, [-0.0, 1.0, 0.0])]
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in ann.search(frame(spark, rows), recall=1.0).collect())
    assert got == [(0, 1, 9, 2.0), (0, 2, 1, 1.0), (0, 3, 20, 1.0), (20, 1, 0, 1.0), (20, 2, 1, 1.0), (20, 3, 9, 0.0)]


def test_empty_and_no_query(spark):
    assert ann.search(frame(spark, [])).count() == 0
    assert ann.search(frame(spark, [(1, [1.0, 2.0]), (2, [2.0, 1.0])])).count() == 0
    assert ann.search(frame(spark, [(0, [1.0, 2.0])])).count() == 0


def test_split_groups(spark, monkeypatch):
    monkeypatch.setattr(ann, "GROUP", 64)
    monkeypatch.setattr(ann, "VISITORS", 10)
    rows = random_rows(800)
    got = {}
    for r in ann.search(frame(spark, rows), recall=1.0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    want = by_hand(rows)
    assert sum(len(got[q] & {v for _, v in f}) for q, f in want.items()) / (20 * len(want)) >= 0.95


@pytest.mark.parametrize("shape", [(1, 1), (5, 3), (7, 9)])
def test_walk_is_in_order(shape):
    rng = np.random.default_rng(1)
    books = ann.Codebooks(rng.normal(size=(shape[0], 2)), rng.normal(size=(shape[1], 2)))
    q = rng.normal(size=4)
    cells = list(books.walk(q))
    both = ((books.first @ q[:2])[:, None] + (books.second @ q[2:])[None]).ravel()
    assert sorted(cells) == list(range(len(both))) and np.all(np.diff(both[cells]) <= 1e-12)


def test_products_of_visited_cells_only():
    rng = np.random.default_rng(3)
    x, q = rng.normal(size=(50, 6)).astype(np.float32), rng.normal(size=(9, 6)).astype(np.float32)
    cell = np.sort(rng.integers(0, 12, 50))
    visits = [sorted(rng.choice(14, rng.integers(0, 8), replace=False).tolist()) for _ in q]  # some of cells without entries
    got = ann.visited_products(q, ann.pa.array(visits, ann.pa.list_(ann.pa.int32())), x, cell)
    want = np.where(np.array([np.isin(cell, v) for v in visits]), q @ x.T, -np.inf)
    assert np.allclose(got, want, atol=1e-5) and np.array_equal(np.isinf(got), np.isinf(want))


def test_clustered_vectors_need_few_products_and_groups(spark, monkeypatch):
    monkeypatch.setattr(ann, "GROUP", 128)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(60, 16)) * 3
    rows = [(i, [float(np.float32(y)) for y in centres[i % 60] + 0.2 * rng.normal(size=16)]) for i in range(4000)]
    seen, measure = [], ann.measured_depth

    def spy(asked, index, books, *rest):
        books.depth = measure(asked, index, books, *rest)
        seen.append(books)
        return books.depth

    monkeypatch.setattr(ann, "measured_depth", spy)
    got = {}
    for r in ann.search(frame(spark, rows)).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    want = by_hand(rows)
    assert sum(len(got[q] & {v for _, v in f}) for q, f in want.items()) / (20 * len(want)) >= 0.9
    books = seen[0]
    cells = [books.visited(np.array(v)) for i, v in rows if i % 20 == 0]
    assert books.counts.sum() == 4000
    assert sum(books.counts[c].sum() for c in cells) < 0.25 * len(cells) * 4000
    assert sum(len(set(books.group[c].tolist())) for c in cells) < 0.5 * len(cells) * len(set(books.group[books.counts > 0].tolist()))
