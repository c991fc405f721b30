"""Approximate nearest neighbours by largest inner product: an inverted multi-index.

Both halves of a vector are quantised with a codebook of their own, so ``K``
centroids a half make ``K * K`` cells. Codebooks are fitted on a bounded sample;
every distinct vector is indexed. A query walks the centroid pairs in order of
the summed inner products of its halves with a heap until it has met ``depth``
entries, and these are reranked by the exact inner product in double precision.
``depth`` is measured, not guessed: a bounded sample of queries is searched
exhaustively, and the depth taken reaches the share ``recall`` of their true
neighbours.

Equal vectors are one entry that keeps its smallest ``k + 1`` ids (more can't be
in a result), and equal query vectors are searched once. Neighbouring cells (of one
centroid of the first half, then the next) are dealt out in groups of about ``GROUP``
entries, so a query meets few groups; there, entries lie in order of their cells and a
query is multiplied with the cells it visits only. Groups with many entries or many
visiting queries are split both ways, so no task holds an unbounded group.

Defined results: vectors that are null, zero, of another length than most, or
hold a null or non-finite component take no part; neither do null ids. Rows that
repeat an id and vector count once. Equal scores go to the smaller id. With fewer
candidates than ``k`` all are returned, an empty table gives an empty result.
Only id and vector are read, so other columns can't clash.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm.common import stage, table

SAMPLE = 20_000  # vectors that fit the codebooks, at most about
TRIAL = 200  # queries that measure the depth, at most
MOST_CENTROIDS = 1024  # of a half; below, they grow with the root of the number of vectors
GROUP = 4096  # entries a task holds, about
VISITORS = 20_000  # queries a task holds, about
BATCH = 1024  # queries multiplied at once
VISITS = 500  # queries that a task walks the cells for, about


def kmeans(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Centroids by Lloyd's rounds from evenly picked rows; ``x`` is the bounded sample."""
    k = min(k, len(x))
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].astype(np.float64)
    for _ in range(rounds):
        near = nearest(x, c)
        n = np.bincount(near, minlength=k)
        for d in range(x.shape[1]):
            c[:, d] = np.where(n > 0, np.bincount(near, weights=x[:, d], minlength=k) / np.maximum(n, 1), c[:, d])
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.argmax(x @ c.T - 0.5 * (c * c).sum(axis=1), axis=1)


@dataclass
class Codebooks:
    first: np.ndarray
    second: np.ndarray
    counts: np.ndarray | None = None  # entries by cell
    group: np.ndarray | None = None  # by cell
    depth: int = 0

    @property
    def half(self) -> int:
        return self.first.shape[1]

    def cells(self, x: np.ndarray) -> np.ndarray:
        return nearest(x[:, :self.half], self.first) * len(self.second) + nearest(x[:, self.half:], self.second)

    def walk(self, q: np.ndarray) -> Iterator[int]:
        """Cells in order of the summed inner products of both halves."""
        a, b = self.first @ q[:self.half], self.second @ q[self.half:]
        i, j = np.argsort(-a, kind="stable").tolist(), np.argsort(-b, kind="stable").tolist()
        a, b, width = a[i].tolist(), b[j].tolist(), len(j)
        heap, ahead = [(-a[0] - b[0], 0, 0)], [-1] * len(i)
        while heap:
            _, x, y = heapq.heappop(heap)
            yield i[x] * width + j[y]
            ahead[x] = y
            # a pair enters once the pairs before it in its row and column are out
            if y + 1 < width and (x == 0 or ahead[x - 1] >= y + 1):
                heapq.heappush(heap, (-a[x] - b[y + 1], x, y + 1))
            if x + 1 < len(i) and ahead[x + 1] == y - 1:
                heapq.heappush(heap, (-a[x + 1] - b[y], x + 1, y))

    def visited(self, q: np.ndarray) -> list[int]:
        out, left = [], self.depth
        for cell in self.walk(q):
            if self.counts[cell]:
                out.append(cell)
                left -= self.counts[cell]
                if left <= 0:
                    break
        return out


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), flat.dtype)


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.col("vec")
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<float>").alias("vec")).filter(
        F.col("id").isNotNull() & v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists(v, lambda x: x != 0))
    # -0.0 and 0.0 are one value
    return rows.withColumn("vec", F.transform("vec", lambda x: x + F.lit(0.0).cast("float")))


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest and of whatever rounding might set beside them."""
    if len(scores) <= k:
        return np.flatnonzero(scores > -np.inf)
    least = np.partition(scores, len(scores) - k)[len(scores) - k]
    return np.flatnonzero((scores >= least - 1e-5 * max(1.0, abs(least))) & (scores > -np.inf)) if least > -np.inf \
        else np.flatnonzero(scores > -np.inf)


def visited_products(q: np.ndarray, cells: pa.ListArray, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
    """Inner products of queries with the entries of the cells each visits, -inf elsewhere; ``x`` is in order of ``cell``."""
    out = np.full((len(q), len(x)), -np.inf, np.float32)
    wanted = cells.flatten().to_numpy()
    who = np.repeat(np.arange(len(q)), cells.value_lengths().to_numpy())
    order = np.argsort(wanted, kind="stable")
    wanted, who = wanted[order], who[order]
    known, start = np.unique(cell, return_index=True)
    end = np.append(start[1:], len(cell))
    left, right = np.searchsorted(wanted, known, "left"), np.searchsorted(wanted, known, "right")
    for a, b, i, j in zip(start.tolist(), end.tolist(), left.tolist(), right.tolist(), strict=True):
        if i < j:  # the cell's entries by the queries that visit it
            out[who[i:j], a:b] = q[who[i:j]] @ x[a:b].T
    return out


def search(rows: DataFrame, k: int = 20, every: int = 20, recall: float = 0.95, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the queries, rows whose id is divisible by ``every``, against all rows."""
    spark = rows.sparkSession
    keep = k + 1
    good = usable(rows, id_col, vector_col)
    sizes = good.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()  # a row for each length
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if sizes is None:
        return empty
    good = good.filter(F.size("vec") == sizes["d"])
    # the row limit of a group is applied before the shuffle too: each task sends on at most `keep` rows of a vector
    first = Window.partitionBy("vec").orderBy("id")
    entries = good.dropDuplicates(["id", "vec"]).withColumn("r", F.row_number().over(first)).filter(F.col("r") <= keep) \
        .groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    entries = stage(entries, "vectors")
    total = entries.count()
    width = int(min(MOST_CENTROIDS, max(2, 2 ** round(np.log2(max(1.0, (total / 12) ** 0.5))))))
    share = min(1.0, SAMPLE / max(total, 1))
    part = F.pmod(F.xxhash64("vec"), F.lit(1 << 20))
    sample = matrix(entries.filter(part < int(share * (1 << 20)) + 1).select("vec").toArrow().column("vec").combine_chunks())
    if not len(sample):
        return empty
    half = max(1, sample.shape[1] // 2)
    books = Codebooks(kmeans(sample[:, :half], width), kmeans(sample[:, half:], width))
    fitted = spark.sparkContext.broadcast(books)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.append_column("cell", pa.array(fitted.value.cells(matrix(batch.column("vec"))).astype(np.int32)))

    index = stage(entries.mapInArrow(assign, "vec array<float>, ids array<long>, cell int"), "index")
    books.counts = np.zeros(len(books.first) * len(books.second), np.int64)
    filled = index.groupBy("cell").count().toArrow()  # at most MOST_CENTROIDS ** 2 rows of 12 bytes
    books.counts[filled.column("cell").to_numpy()] = filled.column("count").to_numpy()
    books.group = ((np.cumsum(books.counts) - books.counts) // GROUP).astype(np.int32)
    queries = good.filter(F.col("id") % every == 0).dropDuplicates(["id", "vec"])
    asked = stage(queries.groupBy("vec").agg(F.min("id").alias("rep")), "queries")
    books.depth = measured_depth(asked, index, books, keep, recall)
    ready = spark.sparkContext.broadcast(books)

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("g", pa.array(ready.value.group[batch.column("cell").to_numpy()], pa.int32()))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                some = batch.slice(at, 200)
                rows = []
                for rep, vec in zip(some.column("rep").to_pylist(), matrix(some.column("vec")), strict=True):
                    cells = np.sort(np.array(ready.value.visited(vec.astype(np.float64)), np.int32))
                    of = ready.value.group[cells]  # ascending, as the cells are
                    for mine in np.split(cells, np.flatnonzero(np.diff(of)) + 1):
                        if len(mine):
                            rows.append((ready.value.group[mine[0]], rep, vec, mine))
                if rows:
                    g, rep, vec, cells = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(g, pa.int32()), pa.array(rep, pa.int64()), pa.array(vec, pa.list_(pa.float32())), pa.array(cells, pa.list_(pa.int32()))],
                        ["g", "rep", "vec", "cells"])

    # few and small rows with much to do each: dealt to tasks by their number, not their bytes
    dealt = asked.repartition(max(1, -(-asked.count() // VISITS)), "rep")
    probes = stage(dealt.mapInArrow(visit, "g int, rep long, vec array<float>, cells array<int>"), "probes")
    entries_of = index.mapInArrow(grouped, "vec array<float>, ids array<long>, cell int, g int")
    split = entries_of.groupBy("g").agg(F.ceil(F.count("*") / (2 * GROUP)).cast("int").alias("es")) \
        .join(probes.groupBy("g").agg(F.ceil(F.count("*") / VISITORS).cast("int").alias("qs")), "g")
    left = entries_of.join(split, "g").withColumn("e", F.pmod(F.xxhash64("vec"), F.col("es")).cast("int")) \
        .withColumn("q", F.explode(F.sequence(F.lit(0), F.col("qs") - 1))).select("g", "e", "q", "cell", "vec", "ids")
    right = probes.join(split, "g").withColumn("q", F.pmod(F.xxhash64("rep"), F.col("qs")).cast("int")) \
        .withColumn("e", F.explode(F.sequence(F.lit(0), F.col("es") - 1))).select("g", "e", "q", "rep", "vec", "cells")

    def rerank(key: tuple[pa.Scalar, ...], entries: pa.Table, probes: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if entries.num_rows and probes.num_rows:
            entries = entries.sort_by("cell")
            x = matrix(entries.column("vec").combine_chunks())
            ids = entries.column("ids").to_pylist()
            exact = x.astype(np.float64)
            for at in range(0, probes.num_rows, BATCH):
                some = probes.slice(at, BATCH)
                q = matrix(some.column("vec").combine_chunks())
                scores = visited_products(q, some.column("cells").combine_chunks(), x, entries.column("cell").to_numpy())
                for row, rep in enumerate(some.column("rep").to_pylist()):
                    best = _best(scores[row], keep)
                    value = (exact[best] * q[row].astype(np.float64)).sum(axis=1)
                    found = np.array([i for b in best for i in ids[b]], np.int64)
                    value = np.repeat(value, [len(ids[b]) for b in best])
                    order = np.lexsort((found, -value))[:keep]
                    out.append((np.full(len(order), rep), found[order], value[order]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table(dict(zip(("rep", "vec_id", "score"), columns, strict=True)))

    found = left.groupBy("g", "e", "q").cogroup(right.groupBy("g", "e", "q")).applyInArrow(rerank, "rep long, vec_id long, score double")
    order = [F.desc("score"), "vec_id"]
    top = found.withColumn("r", F.row_number().over(Window.partitionBy("rep").orderBy(*order))).filter(F.col("r") <= keep).drop("r")
    named = queries.join(asked, "vec").select(F.col("id").alias("query_id"), "rep")
    return named.join(top, "rep").filter("query_id <> vec_id") \
        .withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)).cast("int")) \
        .filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def measured_depth(asked: DataFrame, index: DataFrame, books: Codebooks, keep: int, recall: float) -> int:
    """Entries a query has to meet so that ``recall`` of the true neighbours of a sample of queries are among them."""
    spark = asked.sparkSession
    trial = asked.orderBy(F.xxhash64("rep"), "rep").limit(TRIAL).select("vec").toArrow()
    if not trial.num_rows:
        return 0
    q = matrix(trial.column("vec").combine_chunks())
    shared = spark.sparkContext.broadcast(q)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            scores = shared.value @ matrix(batch.column("vec")).T
            cells = batch.column("cell").to_numpy()
            n = min(keep, scores.shape[1])
            best = np.argpartition(-scores, n - 1, axis=1)[:, :n]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(len(scores)), n)), pa.array(cells[best].ravel()),
                 pa.array(np.take_along_axis(scores, best, axis=1).ravel().astype(np.float64))], ["q", "cell", "score"])

    true = index.select("vec", "cell").mapInArrow(scan, "q long, cell int, score double") \
        .withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "cell"))).filter(F.col("r") <= keep)
    needed = []
    of = {}
    for r in true.collect():  # at most TRIAL * keep rows
        of.setdefault(r["q"], []).append(r["cell"])
    for i, cells in of.items():
        both = (books.first @ q[i, :books.half])[:, None] + (books.second @ q[i, books.half:])[None]
        order = np.argsort(-both.ravel(), kind="stable")
        met = np.empty(len(order), np.int64)
        met[order] = np.cumsum(books.counts[order])
        needed.extend(met[cells])
    return int(np.quantile(needed, recall, method="higher"))


def op9_ann(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))
