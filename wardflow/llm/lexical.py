"""Ranked lexical search of many items at once, with what their queries share evaluated once.

An item's score of a document is a sum over its terms, so sums over sets of terms that
several items share are the common subexpressions of the queries. ``share`` mines them:
terms that the same items have are one leaf; then the two parts that most items have in
common become one part of all of these, again and again, until no two parts stand
together in two items. The result is a graph without cycles in which a part is the sum of two
smaller ones and an item the sum of its parts. For a batch of documents the leaves'
accumulators are filled from the documents' terms, each inner part is materialised once as
the sum of two rows, and items only add up the parts they are left with.

1. One pass over the texts keeps, for each document, its number of terms and its counts of the
   items' terms (a few bytes per document). It is written.
2. Statistics (documents, terms, document frequencies) are aggregates of that table.
3. Each task evaluates its documents and hands on the best ``k`` of each item; a
   window over (tasks x items x k) rows picks the final ones.

Items come in blocks of at most about ``BLOCK_CHARS`` characters of text, each with its own
terms and graph; only a block's terms and graph are sent to tasks.

Weights and scores follow a whole-number form of the usual ranking: with ``w`` =
floor(1000 ln((2N+2)/(2df+1))) and ``m`` = 100 - b + b n N div L (b in per cent), a term that occurs tf
times adds w ((10^9 tf) div (1000 tf + 8 m)).

Defined results: null and empty texts have no terms, and neither rank nor count as
documents; an item without terms, or whose terms no document has, returns nothing; rows that
repeat an item's id are one item with the terms of all of them; rows that repeat a document rank one by one;
equal scores go by ascending id, a null id last; an empty table of either kind gives an
empty result. Other columns aren't read, so names can't clash.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm.common import stage, table

BLOCK_CHARS = 200_000  # of items' texts whose terms and graph go to all tasks at once
DOCS_AT_ONCE = 512
LENGTH_PERCENT = 90
SATURATION = 8

# one byte of UTF-8 -> itself if it belongs to a term, A-Z as a-z, anything else a space
_TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TERM_BYTES).split(b" ")


def only_terms(found: list[bytes]) -> list[bytes]:
    return [t for t in found if t]


@dataclass
class Graph:
    leaf_of: np.ndarray  # of each term
    leaves: int
    inner: list[tuple[int, int]]  # part leaves + i is the sum of two earlier ones
    parts: list[list[int]]  # of each item


def share(items: list[frozenset[int]], terms: int) -> Graph:
    """The query-sharing graph of items given as sets of term numbers."""
    owners = defaultdict(list)
    for i, own in enumerate(items):
        for t in own:
            owners[t].append(i)
    leaf_of = np.zeros(terms, np.int64)
    classes: dict[tuple[int, ...], int] = {}
    for t in range(terms):
        leaf_of[t] = classes.setdefault(tuple(owners[t]), len(classes))
    parts = [{int(leaf_of[t]) for t in own} for own in items]
    together: dict[tuple[int, int], set[int]] = defaultdict(set)
    for i, own in enumerate(parts):
        row = sorted(own)
        for x, a in enumerate(row):
            for b in row[x + 1:]:
                together[a, b].add(i)
    together = defaultdict(set, {ab: who for ab, who in together.items() if len(who) > 1})
    heap = [(-len(who), ab) for ab, who in together.items()]
    heapify(heap)
    inner: list[tuple[int, int]] = []
    while heap:
        n, ab = heappop(heap)
        who = together.get(ab, ())
        if len(who) < 2:
            continue
        if len(who) != -n:
            heappush(heap, (-len(who), ab))
            continue
        a, b = ab
        new = len(classes) + len(inner)
        inner.append(ab)
        met = Counter()
        for i in sorted(who):
            parts[i] -= {a, b}
            for other in parts[i]:
                met[other] += 1
                for gone in (a, b):
                    together.get((min(gone, other), max(gone, other)), set()).discard(i)
            parts[i].add(new)
        for other, shared in met.items():
            if shared > 1:
                together[other, new] = {i for i in who if other in parts[i]}
                heappush(heap, (-shared, (other, new)))
        del together[ab]
    return Graph(leaf_of, len(classes), inner, [sorted(own) for own in parts])


def document_terms(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(id, n, term array<int>, tf array<int>) of every document that has a term; n counts all its terms."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.get
        for batch in batches:
            keep, n, sizes, which, times = [], [], [0], [], []
            for at, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                found = only_terms(terms_of(text))
                if not found:
                    continue
                got = Counter(map(known, found))
                got.pop(None, None)
                keep.append(at)
                n.append(len(found))
                sizes.append(sizes[-1] + len(got))
                which.extend(got)
                times.extend(got.values())
            offsets = pa.array(sizes, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(keep, pa.int64())), pa.array(n, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(which, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32()))], ["id", "n", "term", "tf"])

    return docs.mapInArrow(run, f"id {kind}, n long, term array<int>, tf array<int>")


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)


def accumulators(graph: Graph, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, docs: int) -> np.ndarray:
    """(parts, documents): leaves from the documents' terms, each inner part once from two others."""
    out = np.zeros((graph.leaves + len(graph.inner), docs), np.int64)
    np.add.at(out, (graph.leaf_of[term], doc), impact)
    for i, (a, b) in enumerate(graph.inner):
        np.add(out[a], out[b], out=out[graph.leaves + i])
    return out


def best_of_tasks(vectors: DataFrame, graph: Graph, weight: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item, id, score): for each task, the best k of each item (its number)."""
    kind = vectors.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in graph.parts]  # (-score, id is null, id)
        floor = np.zeros(len(graph.parts), np.int64)
        arrow = None
        for whole in batches:
            for start in range(0, whole.num_rows, DOCS_AT_ONCE):
                batch = whole.slice(start, DOCS_AT_ONCE)
                ids = batch.column("id")
                arrow = ids.type
                place = np.empty(len(ids), np.int64)
                place[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
                lists = batch.column("term")
                doc = np.repeat(np.arange(len(ids)), pc.list_value_length(lists).to_numpy())
                term = lists.flatten().to_numpy().astype(np.int64)
                tf = batch.column("tf").flatten().to_numpy().astype(np.int64)
                m = (100 - LENGTH_PERCENT) + (LENGTH_PERCENT * batch.column("n").to_numpy() * n_docs) // n_terms
                impact = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + SATURATION * m[doc]))
                parts = accumulators(graph, doc, term, impact, len(ids))
                for i, own in enumerate(graph.parts):
                    if not own:
                        continue
                    score = parts[own].sum(axis=0) if len(own) > 1 else parts[own[0]]
                    at = np.flatnonzero(score >= max(1, floor[i]))
                    if not len(at):
                        continue
                    at = at[np.lexsort((place[at], -score[at]))[:k]]
                    new = [(-int(s), x is None, x) for s, x in zip(score[at], ids.take(pa.array(at)).to_pylist(), strict=True)]
                    best[i] = sorted(best[i] + new, key=lambda row: row[:2] if row[1] else row)[:k]
                    if len(best[i]) == k:
                        floor[i] = -best[i][-1][0]
        rows = [(i, row[2], -row[0]) for i, own in enumerate(best) for row in own]
        if rows:
            item, x, score = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(x, arrow), pa.array(score, pa.int64())], ["item", "id", "score"])

    return vectors.mapInArrow(run, f"item int, id {kind}, score long")


def _blocks(items: DataFrame) -> Iterator[list[tuple]]:
    """Items with their texts, in groups bounded by characters; an item's rows are in one group."""
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = 1 + size // BLOCK_CHARS
    grouped = items.filter("text is not null").groupBy("item_id").agg(F.collect_set("text").alias("texts"))
    for b in range(blocks):
        rows = grouped.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b) if blocks > 1 else grouped
        yield [(r["item_id"], r["texts"]) for r in rows.collect()]


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, id, score): the ``k`` best documents of each item with a score above 0."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    items = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    item_type = items.schema["item_id"].dataType.simpleString()
    found = None
    for block in _blocks(items):
        owned = [(i, {t for text in texts for t in only_terms(terms_of(text.encode()))}) for i, texts in block]
        owned = [(i, own) for i, own in owned if own]
        if not owned:
            continue
        vocabulary = {t: n for n, t in enumerate(sorted(set().union(*(own for _, own in owned))))}
        graph = share([frozenset(vocabulary[t] for t in own) for _, own in owned], len(vocabulary))
        vectors = stage(document_terms(docs, vocabulary), "document-terms")
        n_docs, n_terms = vectors.agg(F.count("*"), F.sum("n")).first()
        if not n_docs:
            continue
        df = np.zeros(len(vocabulary), np.int64)
        for r in vectors.select(F.explode("term").alias("term")).groupBy("term").count().collect():  # no more rows than the block has terms
            df[r["term"]] = r["count"]
        rows = best_of_tasks(vectors, graph, weights(n_docs, df), n_docs, n_terms, k)
        names = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(owned)], f"item int, item_id {item_type}")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
        ranked = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).join(names, "item").select("item_id", "rank", "id", "score")
        found = ranked if found is None else found.unionByName(ranked)
    if found is None:
        return spark.createDataFrame([], f"item_id {item_type}, rank int, id {docs.schema['id'].dataType.simpleString()}, score long")
    return found


def op11_search(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).withColumnRenamed("id", "doc_id")


def _sql_terms(source: str, key: str) -> str:
    letters = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    return (f"SELECT {key}, unnest(regexp_extract_all(translate(text, {letters}), "
            rf"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM {source}")


OP11_SQL = f"""
WITH words AS ({_sql_terms('documents', 'doc_id')}),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
len AS (SELECT doc_id, sum(tf) AS n FROM tf GROUP BY ALL),
total AS (SELECT count(*) AS N_docs, sum(n) AS L FROM len),
wanted AS (SELECT DISTINCT item_id, term FROM ({_sql_terms('benchmark', 'item_id')})),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * N_docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
           FROM tf, total WHERE term IN (SELECT term FROM wanted) GROUP BY term, N_docs),
scored AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * N_docs) // L)))) AS BIGINT) AS score
           FROM wanted JOIN weight USING (term) JOIN tf USING (term) JOIN len USING (doc_id), total GROUP BY ALL),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
           FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10
"""
