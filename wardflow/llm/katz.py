"""Katz backoff language model over words, learned from one part of the documents and applied to all.

Counts ``r`` of an n-gram up to ``TOP`` are discounted by Good-Turing's estimate from the
level's counts of counts (Katz's form, which takes ``n_1`` of the mass away); where those
counts don't give a factor between 0 and 1, it is ``(r - 0.5) / r``. What a context's
n-grams lose goes to the words unseen after it, in proportion to their probability one
level down; the weight is exact, so that the known words and the one class of unknown
words add up to 1 after every context. A context whose n-grams are all too frequent to
be discounted gives one occurrence more than it has to the unseen words.

How it runs, level by level: a chunk of documents has each distinct n-gram once, as the
context's number and the word's number, with its count in training texts. These travel
as packed arrays to buckets by the context (the n-grams of a context that holds more than a
bucket's share of all tokens by the whole n-gram), where the level's table of counts is
put together; it is written, and the chunks get back the counts of their own n-grams
and, for those training texts don't have, what the context's weight is made of. A chunk then
evaluates each token from the highest level down. The tables are never in one place:
a bucket holds its share, a chunk what its texts ask for. The driver has counts of
counts and at most one row for each frequent context (no more than buckets).

Defined results: a null text is empty and consists of its end token; words are split
at ASCII white space and only A-Z are lower-cased; a null id counts as the empty text
where the split by id is the default; repeated rows come back as often as they came, and count
as often; without training rows every token is unknown and has probability 1. Columns
other than id and text aren't read, so their names can't clash.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import id_bucket, mix64, stage, table, then_give_back
from wardflow.llm.packed import floats, numbers, pack, planes, text_chunks, unpack

ORDER = 2
TOP = 5  # the largest count that is discounted
CHUNK_CHARS = 5_000_000
BUCKET_BYTES = 32_000_000  # of text for each bucket of the tables at most, whatever the size of the input's partitions
# a row may be some MB: without a look at each, Parquet's writer would hold a hundred of them, and a reader a whole group of 128 MB
ROW_GROUPS = {"parquet.block.size": 16 << 20, "parquet.block.size.row.check.min": 1, "parquet.block.size.row.check.max": 10,
              "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 10}
END = b""  # no word is empty
BEGIN = 1 << 62  # number of the context before a text's first token
UNKNOWN = BEGIN + 1
LAST = (1 << 32) - 1
MESSAGE = "chunk long, bucket int, body binary"
ANSWER = MESSAGE + ", ctx long, m array<long>, low double"
LEVEL = -1  # in place of a context: the counts of counts of a whole bucket


def held_out(id_col: str = "doc_id") -> Column:
    return id_bucket(id_col) % 10 == 0


def discounts(n: list[int]) -> np.ndarray:
    """Factors of the counts 0 ... TOP from the numbers ``n[0]``, ``n[1]`` ... of n-grams seen once, twice ..."""
    out = np.ones(TOP + 1)
    rest = (TOP + 1) * n[TOP] / n[0] if n[0] else 1.0
    for r in range(1, TOP + 1):
        d = 0.0
        if n[r - 1] and rest < 1:
            d = ((r + 1) * n[r] / (r * n[r - 1]) - rest) / (1 - rest)
        out[r] = d if 0 < d < 1 else (r - 0.5) / r
    return out


def given_up(d: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Occurrences that discounting takes from n-grams of which ``m[..., r - 1]`` have count r."""
    r = np.arange(1, TOP + 1)
    return m @ ((1 - d[1:]) * r)


@dataclass
class Totals:
    """A level: counts of counts, n-grams, their occurrences; and the shares of frequent contexts."""
    n: list[int]
    types: int
    tokens: int
    hot: dict[int, tuple[list[int], float]]

    @property
    def discount(self) -> np.ndarray:
        return discounts(self.n)


def totals(answers: DataFrame) -> Totals:
    rows = answers.filter("body is null").groupBy("ctx").agg(
        *[F.sum(F.col("m")[j]).alias(f"m{j}") for j in range(TOP + 3)], F.sum("low").alias("low")).collect()
    whole = next((r for r in rows if r["ctx"] == LEVEL), None)
    level = [int(whole[f"m{j}"]) for j in range(TOP + 3)] if whole else [0] * (TOP + 3)
    hot = {r["ctx"]: ([int(r[f"m{j}"]) for j in range(TOP)], r["low"]) for r in rows if r["ctx"] != LEVEL}
    return Totals(level[:TOP + 1], level[TOP + 1], level[TOP + 2], hot)


def _answer(rows: list[tuple]) -> pa.RecordBatch:
    chunk, bucket, body, ctx, m, low = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(chunk, pa.int64()), pa.array(bucket, pa.int32()), pa.array(body, pa.binary()), pa.array(ctx, pa.int64()),
         pa.array(m, pa.list_(pa.int64())), pa.array(low, pa.float64())], ["chunk", "bucket", "body", "ctx", "m", "low"])


def _messages(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    chunk, bucket, body = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(chunk, pa.int64()), pa.array(bucket, pa.int32()), pa.array(body, pa.binary())], ["chunk", "bucket", "body"])


def _level_row(bucket: int, r: np.ndarray) -> tuple:
    m = [int(x) for x in np.bincount(np.minimum(r, TOP + 2), minlength=TOP + 3)[1:TOP + 2]]
    return None, bucket, None, LEVEL, [*m, int((r > 0).sum()), int(r.sum())], 0.0


# level 1: words


def _words(texts: list[bytes], held: np.ndarray, buckets: int):
    """(distinct words, most frequent first; their counts in training texts; buckets; tokens as places; tokens of each text)."""
    place: dict[bytes, int] = defaultdict(count().__next__)
    flat, lens = [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        found = text.lower().split()
        found.append(END)
        lens[i] = len(found)
        flat.append(np.fromiter(map(place.__getitem__, found), np.int32, len(found)))
    flat = np.concatenate(flat)
    order = np.argsort(-np.bincount(flat, minlength=len(place)), kind="stable")  # frequent words get small places
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    flat = rank[flat]
    words = list(place)
    words = [words[i] for i in order]
    counts = np.bincount(flat[np.repeat(~held, lens)], minlength=len(words))
    share = np.fromiter(map(crc32, words), np.int64, len(words)) % buckets
    return words, counts, share, flat, lens


def split_words(docs: DataFrame, buckets: int, words: bool) -> DataFrame:
    """Of each chunk, either its distinct words by bucket or (bucket -1) its texts as places among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, rows, texts in text_chunks(batches, CHUNK_CHARS):
            held = rows.column("held").combine_chunks().fill_null(False)
            known, counts, share, flat, lens = _words(texts, np.array(held, bool), buckets)
            if not words:
                ids = rows.column("id").combine_chunks()
                yield _messages([(chunk, -1, pack(ids=ids, held=held, lens=planes(lens), flat=planes(flat), share=planes(share)))])
                continue
            order = np.argsort(share, kind="stable")
            cuts = np.searchsorted(share[order], np.arange(buckets + 1))
            known = pa.array(known, pa.binary())
            out = []
            for b in range(buckets):
                mine = order[cuts[b]:cuts[b + 1]]
                if len(mine):
                    out.append((chunk, b, pack(words=known.take(pa.array(mine)), counts=planes(counts[mine]))))
            yield _messages(out)

    return docs.mapInArrow(then_give_back(run), MESSAGE)


def count_words(messages: DataFrame, buckets: int) -> DataFrame:
    """The table of words, in buckets: their numbers and counts go back to the chunks in the order asked."""

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = key[0].as_py()
        place: dict[bytes, int] = defaultdict(count().__next__)
        asked = []
        for batch in batches:
            for chunk, body in zip(batch.column("chunk").to_pylist(), batch.column("body"), strict=True):
                x = unpack(body)
                words = x["words"].as_py()
                asked.append((chunk, np.fromiter(map(place.__getitem__, words), np.int64, len(words)), numbers(x["counts"])))
        total = np.zeros(len(place), np.int64)
        for _, at, n in asked:  # a chunk names a word once
            total[at] += n
        number = np.empty(len(total), np.int64)
        number[np.argsort(-total, kind="stable")] = np.arange(len(total)) * buckets + bucket
        for chunk, at, _ in asked:
            yield _answer([(chunk, bucket, pack(number=planes(number[at]), count=planes(total[at])), None, None, None)])
        yield _answer([_level_row(bucket, total)])

    return messages.groupBy("bucket").applyInArrow(run, ANSWER)


# a chunk between two levels


@dataclass
class State:
    ids: pa.Array
    held: np.ndarray
    lens: np.ndarray
    word: np.ndarray  # of each token: place among the chunk's words, those unknown to training texts as the last
    word_number: np.ndarray
    gram: np.ndarray  # of each token: place of the n-gram that ends there among the chunk's, -1 if training texts lack it
    gram_number: np.ndarray
    gram_count: np.ndarray
    p: np.ndarray  # of each token, at the level reached
    known: np.ndarray  # of each text
    base: np.ndarray
    p_word: np.ndarray | None = None  # at the first level, where a token's n-gram and probability are its word's

    def packed(self) -> bytes:
        own = dict(p_word=self.p_word.tobytes()) if self.p_word is not None else dict(gram=planes(self.gram + 1), p=self.p.tobytes())
        return pack(ids=self.ids, held=pa.array(self.held), lens=planes(self.lens), word=planes(self.word), word_number=planes(self.word_number),
                    gram_number=planes(self.gram_number), gram_count=planes(self.gram_count), known=planes(self.known), base=self.base.tobytes(), **own)

    @staticmethod
    def read(body: pa.Scalar) -> State:
        x = unpack(body)
        n = {k: numbers(x[k]) for k in ("lens", "word", "word_number", "gram_number", "gram_count", "known")}
        if "p_word" in x:
            gram = np.where(n["word"] < len(n["word_number"]) - 1, n["word"], -1)
            p = floats(x["p_word"])[n["word"]]
        else:
            gram, p = numbers(x["gram"]) - 1, floats(x["p"])
        return State(x["ids"].values, np.array(x["held"].values, bool), n["lens"], n["word"], n["word_number"], gram, n["gram_number"],
                     n["gram_count"], p, n["known"], floats(x["base"]))


def _gather(batches: Iterator[pa.RecordBatch]) -> tuple[pa.Scalar | None, dict[int, dict[str, pa.Scalar]]]:
    """(the chunk's own row, answers by bucket)."""
    own, parts = None, {}
    for batch in batches:
        for bucket, body in zip(batch.column("bucket").to_pylist(), batch.column("body"), strict=True):
            if bucket < 0:
                own = body
            else:
                parts[bucket] = unpack(body)
    if own is None:
        raise ValueError("the documents changed between two readings")
    return own, parts


def _spread(share: np.ndarray, parts: dict[int, dict[str, pa.Scalar]], *names: str) -> list[np.ndarray]:
    """The answers of all buckets in the order of what was asked."""
    out = [np.zeros(len(share), np.int64) for _ in names]
    order = np.argsort(share, kind="stable")
    for b, part in parts.items():
        mine = order[slice(*np.searchsorted(share[order], [b, b + 1]))]
        for to, name in zip(out, names, strict=True):
            got = numbers(part[name])
            if len(got) != len(mine):
                raise ValueError("the documents changed between two readings")
            to[mine] = got
    return out


def _per_text(values: np.ndarray, lens: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, np.r_[0, np.cumsum(lens)[:-1]]) if len(lens) else values[:0]  # every text has its end token


def first_state(own: pa.Scalar, parts: dict, level: Totals, training_texts: int) -> State:
    x = unpack(own)
    share, flat, lens = numbers(x["share"]), numbers(x["flat"]), numbers(x["lens"])
    number, c = _spread(share, parts, "number", "count")
    d, n = level.discount, level.tokens
    left = given_up(d, np.array(level.n[:TOP]))
    den, left = (n, left) if left > 0 else (n + 1, 1.0)
    p = np.where(c > 0, d[np.minimum(c, TOP)] * c / den, left / den)
    p[c > TOP] = c[c > TOP] / den
    base = np.log10((c + 0.1) / (n + 0.1 * (level.types + 1)))
    seen = c[flat] > 0
    return State(x["ids"].values, np.array(x["held"].values, bool), lens, np.where(seen, flat, len(c)), np.r_[number, UNKNOWN], np.where(seen, flat, -1),
                 np.r_[number, BEGIN], np.r_[c, training_texts], p[flat], _per_text(seen.astype(np.int64), lens), _per_text(base[flat], lens),
                 np.r_[p, left / den])


def _pairs(s: State, level: int, buckets: int, tokens: int):
    """The distinct (context, word) of a chunk by bucket, and where its tokens have them."""
    start = np.r_[0, np.cumsum(s.lens)[:-1]]
    ctx = np.r_[-1, s.gram[:-1]]
    ctx[start] = len(s.gram_number) - 1 if level == 2 else -1  # BEGIN stands last among the first level's n-grams
    at = np.flatnonzero(ctx >= 0)
    key, first, back = np.unique((ctx[at].astype(np.uint64) << np.uint64(32)) | s.word[at].astype(np.uint64), return_index=True, return_inverse=True)
    c, w = (key >> np.uint64(32)).astype(np.int64), (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
    hot = s.gram_count[c] * buckets > tokens
    where = mix64(s.gram_number[c].astype(np.uint64))
    where = np.where(hot, mix64(where + s.word_number[w].astype(np.uint64)), where)
    share = (where % np.uint64(buckets)).astype(np.int64)
    return at, first, back, c, w, hot, share


def ask(states: DataFrame, level: int, buckets: int, tokens: int) -> DataFrame:
    """The chunks' n-grams of a level, dealt out: contexts, words, counts in training texts, probabilities one level down."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, body in zip(batch.column("chunk").to_pylist(), batch.column("body"), strict=True):
                s = State.read(body)
                at, first, back, c, w, hot, share = _pairs(s, level, buckets, tokens)
                n = np.bincount(back[np.repeat(~s.held, s.lens)[at]], minlength=len(c))
                low = s.p[at[first]]
                order = np.argsort(share, kind="stable")
                cuts = np.searchsorted(share[order], np.arange(buckets + 1))
                out = []
                for b in range(buckets):
                    mine = order[cuts[b]:cuts[b + 1]]
                    if not len(mine):
                        continue
                    mc = c[mine]
                    heads = np.flatnonzero(np.r_[True, mc[1:] != mc[:-1]])
                    out.append((chunk, b, pack(ctx=planes(s.gram_number[mc[heads]]), run=planes(np.diff(np.r_[heads, len(mc)])), hot=planes(hot[mine[heads]]),
                                               word=planes(s.word_number[w[mine]]), n=planes(n[mine]), low=low[mine].tobytes())))
                if out:
                    yield _messages(out)

    return states.mapInArrow(then_give_back(run), MESSAGE)


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    """The arrays as one; the list is emptied, so that they aren't held twice for long."""
    out = np.concatenate(parts)
    parts.clear()
    return out


def _in_32_bits(word: np.ndarray) -> np.ndarray:
    """Numbers in the order of ``word`` that fit in 32 bits: its own, UNKNOWN as the largest, or else their ranks."""
    if word.max(where=word != UNKNOWN, initial=0) < LAST:
        return np.minimum(word, LAST).astype(np.uint64)
    return np.unique(word, return_inverse=True)[1].astype(np.uint64)


def count_grams(messages: DataFrame, buckets: int, numbered: bool) -> DataFrame:
    """The level's table, in buckets: counts go back to the chunks in the order asked, with the contexts' figures where a count is 0."""

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = key[0].as_py()
        asked, heads, cols = [], ([], [], []), ([], [], [])
        for batch in batches:
            for chunk, body in zip(batch.column("chunk").to_pylist(), batch.column("body"), strict=True):
                x = unpack(body)
                for to, values in zip(heads, (numbers(x["ctx"]), numbers(x["hot"]) > 0, numbers(x["run"])), strict=True):
                    to.append(values)
                for to, values in zip(cols, (numbers(x["word"]), numbers(x["n"]).astype(np.int32), floats(x["low"])), strict=True):
                    to.append(values)
                asked.append((chunk, len(cols[0][-1])))
        t_ctx, place = np.unique(_joined(heads[0]), return_inverse=True)
        t_hot = np.zeros(len(t_ctx), bool)
        t_hot[place] = _joined(heads[1])
        # a row is 8 bytes while it is sorted: its context's place, its word
        key = np.repeat(place.astype(np.uint64) << np.uint64(32), _joined(heads[2]))
        key |= _in_32_bits(_joined(cols[0]))
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        of = (key[first] >> np.uint64(32)).astype(np.int64)
        del key
        size = np.diff(np.r_[first, len(order)])
        r = np.add.reduceat(_joined(cols[1])[order], first, dtype=np.int64)
        low = np.where(r > 0, _joined(cols[2])[order[first]], 0.0)
        c_heads = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        m = np.stack([np.add.reduceat((r == j).astype(np.int64), c_heads) for j in range(1, TOP + 1)], axis=1)
        s = np.add.reduceat(low, c_heads)
        del first, low
        # back in the order asked
        gram = np.empty(len(order), np.int32)
        gram[order] = np.repeat(np.arange(len(r), dtype=np.int32), size)
        del order, size
        full = (m.sum(axis=1) == 0) & ~t_hot
        code = 2 * r + full[of]
        number = np.arange(len(r)) * buckets + bucket
        at = 0
        for chunk, k in asked:
            mine = gram[at:at + k]
            at += k
            lost = of[mine[(r[mine] == 0) & ~t_hot[of[mine]]]]
            more = {"number": planes(number[mine])} if numbered else {}
            yield _answer([(chunk, bucket, pack(code=planes(code[mine]), **{f"m{j}": planes(m[lost, j]) for j in range(TOP)}, low=s[lost].tobytes(), **more),
                            None, None, None)])
        yield _answer([_level_row(bucket, r)] + [
            (None, bucket, None, int(t_ctx[i]), [*map(int, m[i]), 0, 0, 0], float(s[i])) for i in np.flatnonzero(t_hot)])

    return messages.groupBy("bucket").applyInArrow(run, ANSWER)


def evaluate(s: State, parts: dict, level: int, buckets: int, tokens: int, found: Totals, numbered: bool) -> State:
    """The chunk at the next level: tokens seen after their context by their discounted count, others by backing off."""
    at, _, back, c, w, hot, share = _pairs(s, level, buckets, tokens)
    code, = _spread(share, parts, "code")
    r, full = code >> 1, (code & 1).astype(np.int64)
    m, low = np.zeros((len(r), TOP), np.int64), np.zeros(len(r))
    order = np.argsort(share, kind="stable")
    lost = (r == 0) & ~hot
    for b, part in parts.items():
        mine = order[slice(*np.searchsorted(share[order], [b, b + 1]))]
        mine = mine[lost[mine]]
        m[mine] = np.stack([numbers(part[f"m{j}"]) for j in range(TOP)], axis=1)
        low[mine] = floats(part["low"])
    for place in np.unique(c[hot]):
        mine = np.flatnonzero((c == place) & hot)
        m[mine], low[mine] = found.hot[int(s.gram_number[place])]
        full[mine] = int(m[mine[0]].sum() == 0)
    d = found.discount
    den = s.gram_count[c] + full
    seen = np.where(r > TOP, 1.0, d[np.minimum(r, TOP)]) * r / den
    left = np.where(full > 0, 1.0, given_up(d, m)) / den
    p = s.p.copy()
    below = s.p[at]
    p[at] = np.where(r[back] > 0, seen[back], left[back] / np.maximum((1 - low)[back], below) * below)
    gram = np.full(len(s.gram), -1, np.int64)
    number = np.zeros(0, np.int64)
    if numbered:
        number, = _spread(share, parts, "number")
        gram[at] = np.where(r[back] > 0, back, -1)
    return State(s.ids, s.held, s.lens, s.word, s.word_number, gram, number, r if numbered else number, p, s.known, s.base)


def katz_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held: Column | None = None, order: int = ORDER) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row, which is read twice and must stay the same.

    ``held`` says which rows aren't learned from, by default those whose crc32 of the id leaves no remainder by 10.
    ``order`` is the number of words of the longest n-grams.
    """
    if order < 1:
        raise ValueError("order must be 1 at least")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(held if held is not None else held_out(id_col), F.lit(False)).alias("held"),
                       F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    training_texts, size = rows.agg(F.count_if(~F.col("held")), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    buckets = max(1, rows.rdd.getNumPartitions(), -(-size // BUCKET_BYTES))
    answers = stage(count_words(split_words(rows, buckets, words=True), buckets), "words", ROW_GROUPS)
    words = totals(answers)

    def finished(s: State) -> pa.Table:
        tokens = pa.array(np.full(len(s.lens), words.tokens))
        return pa.table([s.ids, pa.array(s.held), pa.array(s.lens), pa.array(s.known), tokens, pa.array(s.base), pa.array(_per_text(np.log10(s.p), s.lens))],
                        ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    result = f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def step(own: DataFrame, answers: DataFrame, after, last: bool) -> DataFrame:
        """Chunks and the answers to them, met by chunk in one shuffle; ``after`` makes the next state."""
        def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            s = after(*_gather(batches))
            if last:
                yield from finished(s).to_batches()
            else:
                yield _messages([(key[0].as_py(), -1, s.packed())])

        both = own.unionByName(answers.filter("body is not null").select("chunk", "bucket", "body"))
        return both.groupBy("chunk").applyInArrow(run, result if last else MESSAGE)

    states = step(split_words(rows, buckets, words=False), answers, lambda own, parts: first_state(own, parts, words, training_texts), order == 1)
    for level in range(2, order + 1):
        states = stage(states, "states", ROW_GROUPS)
        more = level < order
        answers = stage(count_grams(ask(states, level, buckets, words.tokens), buckets, more), "grams", ROW_GROUPS)
        found = totals(answers)
        states = step(states, answers, lambda own, parts, level=level, found=found, more=more:
                      evaluate(State.read(own), parts, level, buckets, words.tokens, found, more), not more)
    return states


def op12_katz(spark, sf_dir: str) -> DataFrame:
    return katz_scores(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
