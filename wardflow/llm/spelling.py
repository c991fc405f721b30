"""Spelling variants: words one code point apart, found through PartEnum signatures of their letter multisets.

A word's letters with their numbers of occurrence, (e, 1), (e, 2), (t, 1) ..., are the set
bits of a binary vector. An inserted or deleted code point changes one bit and a replaced
one two, so near words lie within Hamming distance two. The dimensions are partitioned by
a hash into ``PARTS`` groups; two vectors within distance two differ in at most two groups, so
they agree on at least one choice of all groups but two. A word has one signature per
choice (ten for five groups): the contents of the groups left in.

Signatures are dealt to buckets as packed arrays and equi-joined there. A group of
words with an equal signature isn't paired up: its words meet by what is left of them
without one position, so that the work grows with the group's letters and only words that are
near come out. Each such pair is compared code point by code point. A pair that agrees on several choices
counts for the first of them, so no pair counts twice, and a bucket hands on one row for
each word: number of near words, the most frequent of them. Links to the more frequent spelling are followed
by doubling, in written rounds.

Defined results: null and empty texts have no words; a null id counts as the empty
text; repeated rows count as often as they come; equal counts go to the smaller word in code-point order;
an empty table gives an empty result. Only id and text are read, so other columns can't clash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import code_points, mix64, stage, table
from wardflow.llm.packed import numbers, pack, planes, unpack

PARTS = 5
CHOICES = list(combinations(range(PARTS), 2))  # groups left out
FLUSH = 400_000  # distinct words a task gathers before it hands them on
KEYS_AT_ONCE = 4_000_000
WIDE = 48  # longer words are compared one by one
TYPO = 97

# one byte of Latin-1 -> itself if it is a letter, A-Z as a-z, anything else a space
_LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0xC0 else 0x20 for b in range(256))


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 5, least: int = 3, typo: int | None = None) -> DataFrame:
    """(word, n) of the runs of A-Z, a-z and U+00C0 to U+00FF with at least ``shortest`` code points and ``least`` occurrences.

    With ``typo``, the runs of a text whose crc32 of ``id:run`` is a multiple of it lose one code point first.
    """
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).cast("string").alias("text")).filter("text is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in total], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(total.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for i, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                seed = crc32(f"{i}:".encode())
                for w, n in Counter(text.encode("latin-1", "replace").translate(_LETTERS).split()).items():
                    if len(w) < shortest:
                        continue
                    if typo:
                        h = crc32(w if w.isascii() else w.decode("latin-1").encode(), seed)
                        if h % typo == 0:
                            at = h % len(w)
                            w = w[:at] + w[at + 1:]
                            if len(w) < shortest:
                                continue
                    total[w] += n
                if len(total) >= FLUSH:
                    yield flush()
                    total.clear()
        if total:
            yield flush()

    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


class Letters:
    """The code points of many words in a row."""

    def __init__(self, words: list[str]):
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        self.start = np.r_[0, np.cumsum(self.size)[:-1]].astype(np.int64) if words else np.zeros(0, np.int64)
        self.code = code_points("".join(words)).astype(np.int64)
        self.word = np.repeat(np.arange(len(words)), self.size)
        self.at = np.arange(len(self.code)) - self.start[self.word]

    def groups(self) -> np.ndarray:
        """(words, PARTS): a hash of the set bits in each group of dimensions."""
        order = np.lexsort((self.code, self.word))
        same = np.r_[False, (self.word[order][1:] == self.word[order][:-1]) & (self.code[order][1:] == self.code[order][:-1])]
        index = np.arange(len(order))
        nth = index - np.maximum.accumulate(np.where(same, 0, index))  # occurrence of the letter in its word
        bit = mix64((self.code[order] * (1 << 24) + nth).astype(np.uint64) + np.uint64(11))
        out = np.zeros((len(self.size), PARTS), np.uint64)
        np.add.at(out, (self.word[order], ((bit >> np.uint64(32)) % np.uint64(PARTS)).astype(np.int64)), mix64(bit))
        return out

    def without(self) -> tuple[np.ndarray, np.ndarray]:
        """A hash of each word, and for each letter one of its word without it."""
        with np.errstate(over="ignore"):
            here = mix64((self.code * (1 << 32) + self.at).astype(np.uint64) + np.uint64(5))
            moved = mix64((self.code * (1 << 32) + self.at - 1).astype(np.uint64) + np.uint64(5))
            before = np.r_[np.uint64(0), np.cumsum(here, dtype=np.uint64)]
            after = np.r_[np.uint64(0), np.cumsum(moved, dtype=np.uint64)]
            end = self.start + self.size
            i = np.arange(len(self.code))
            less = before[i] - before[self.start[self.word]] + after[end[self.word]] - after[i + 1]
            return before[end] - before[self.start], less


def signatures(groups: np.ndarray) -> np.ndarray:
    """(words, choices): what is left of the groups with two of them left out."""
    with np.errstate(over="ignore"):
        each = mix64(groups + np.arange(1, PARTS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        total = each.sum(axis=1, dtype=np.uint64)
        return np.stack([mix64((total - each[:, i] - each[:, j]) ^ np.uint64(n + 1)) for n, (i, j) in enumerate(CHOICES)], axis=1)


def _deal(words: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = signatures(Letters(batch.column("word").to_pylist()).groups())
            n = batch.column("n").to_numpy()
            share = (sig % np.uint64(buckets)).astype(np.int64).ravel()
            order = np.argsort(share, kind="stable")
            cuts = np.searchsorted(share[order], np.arange(buckets + 1))
            rows = []
            for b in range(buckets):
                mine = order[cuts[b]:cuts[b + 1]]
                if not len(mine):
                    continue
                own, at = np.unique(mine // len(CHOICES), return_inverse=True)
                rows.append((b, pack(word=batch.column("word").take(pa.array(own)), n=planes(n[own]), at=planes(at), choice=planes(mine % len(CHOICES)),
                                     sig=sig.ravel()[mine].tobytes())))
            b, body = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(body, pa.binary())], ["bucket", "body"])

    return words.select("word", "n").mapInArrow(run, "bucket int, body binary")


def _runs(keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of equal keys, as pairs; a key's places are few, since words differ there in one letter."""
    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    heads = np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    size = np.diff(np.r_[heads, len(keys)])
    for m in np.unique(size[size > 1]):
        x, y = np.triu_indices(int(m), 1)
        own = heads[size == m]
        step = max(1, KEYS_AT_ONCE // len(x))
        for i in range(0, len(own), step):
            yield order[(own[i:i + step, None] + x).ravel()], order[(own[i:i + step, None] + y).ravel()]


def near_pairs(words: list[str], at: np.ndarray, choice: np.ndarray, sig: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of near words among those with an equal signature, each pair for the first choice on which it agrees."""
    letters = Letters(words)
    groups = letters.groups()
    whole, less = letters.without()
    padded = np.zeros((len(words), WIDE + 1), np.int64)
    fits = letters.at < WIDE
    padded[letters.word[fits], letters.at[fits]] = letters.code[fits]
    column = np.arange(WIDE)
    left_out = np.array(CHOICES)
    new = np.r_[True, letters.code[1:] != letters.code[:-1]] if len(letters.code) else np.zeros(0, bool)
    new |= letters.at == 0  # of a run of equal letters one is enough to delete

    def first_choice(a, b, c):
        differ = groups[a] != groups[b]
        one = differ.sum(axis=1) == 1
        d = differ.argmax(axis=1)
        i, j = left_out[c].T
        return ~one | ((i == 0) & (j == np.where(d == 0, 1, d)))

    def replaced(a, b):
        ok = (letters.size[a] == letters.size[b]) & (a != b)
        short = letters.size[a] <= WIDE
        ok &= ~short | ((padded[a] != padded[b]).sum(axis=1) == 1)
        for i in np.flatnonzero(ok & ~short):
            ok[i] = sum(x != y for x, y in zip(words[a[i]], words[b[i]], strict=True)) == 1
        return ok

    def inserted(a, b, p):
        """a is b without position p."""
        ok = letters.size[a] + 1 == letters.size[b]
        short = letters.size[b] <= WIDE
        ok &= ~short | (padded[a][:, :WIDE] == np.take_along_axis(padded[b], column + (column >= p[:, None]), axis=1)).all(axis=1)
        for i in np.flatnonzero(ok & ~short):
            w = words[b[i]]
            ok[i] = words[a[i]] == w[:p[i]] + w[p[i] + 1:]
        return ok

    order = np.argsort(sig, kind="stable")
    total = np.cumsum(letters.size[at[order]])
    cut = 0
    while cut < len(order):  # as many whole signatures as give about KEYS_AT_ONCE letters
        upto = int(np.searchsorted(total, (total[cut - 1] if cut else 0) + KEYS_AT_ONCE)) + 1
        upto = int(np.searchsorted(sig[order], sig[order[min(upto, len(order)) - 1]], "right"))
        entry = order[cut:upto]
        cut = upto
        count = letters.size[at[entry]]
        of = np.repeat(entry, count)  # the entry of each letter
        place = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
        flat = letters.start[at[of]] + place
        with np.errstate(over="ignore"):
            salt = mix64(sig[of])
            for x, y in _runs(mix64(less[flat] + salt + (place * 2 + 1).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) ^ mix64(letters.size[at[of]].astype(np.uint64))):
                a, b, c = at[of[x]], at[of[y]], choice[of[x]]
                ok = (sig[of[x]] == sig[of[y]]) & (c == choice[of[y]])
                ok &= replaced(a, b) & first_choice(a, b, c)
                yield a[ok], b[ok]
            once = np.flatnonzero(new[flat])
            keys = np.r_[mix64(less[flat[once]] + salt[once]), mix64(whole[at[entry]] + mix64(sig[entry]))]
            who = np.r_[of[once], entry]
            p = np.r_[place[once], np.full(len(entry), -1)]
            # a word without a letter meets that word; equal remainders of two longer words don't count
            short = np.flatnonzero(p < 0)
            by_key = short[np.argsort(keys[short], kind="stable")]
            lo = np.searchsorted(keys[by_key], keys[:len(once)], "left")
            hi = np.searchsorted(keys[by_key], keys[:len(once)], "right")
            longer = np.repeat(np.arange(len(once)), hi - lo)
            shorter = by_key[np.repeat(lo, hi - lo) + np.arange(len(longer)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo)]
            a, b, c = at[who[shorter]], at[who[longer]], choice[who[longer]]
            ok = (sig[who[shorter]] == sig[who[longer]]) & (c == choice[who[shorter]])
            ok &= inserted(a, b, p[longer]) & first_choice(a, b, c)
            yield a[ok], b[ok]


def near_words(words: DataFrame, buckets: int) -> DataFrame:
    """(word, n_near, best {negative count, word}) of the words that have a near one."""

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, n, at, choice, sig = [], [], [], [], []
        for batch in batches:
            for body in batch.column("body"):
                x = unpack(body)
                at.append(numbers(x["at"]) + len(names))
                names.extend(x["word"].as_py())
                n.append(numbers(x["n"]))
                choice.append(numbers(x["choice"]))
                sig.append(np.frombuffer(x["sig"].as_buffer(), np.uint64))
        n, at, choice, sig = (np.concatenate(x) for x in (n, at, choice, sig))
        rank = np.empty(len(names), np.int64)
        rank[sorted(range(len(names)), key=names.__getitem__)] = np.arange(len(names))
        near = np.zeros(len(names), np.int64)
        best = np.full(len(names), -1, np.int64)
        for a, b in near_pairs(names, at, choice, sig):
            one, other = np.r_[a, b], np.r_[b, a]
            if not len(one):
                continue
            near += np.bincount(one, minlength=len(names))
            had = np.flatnonzero(best >= 0)
            one, other = np.r_[one, had], np.r_[other, best[had]]
            order = np.lexsort((rank[other], -n[other], one))
            one, other = one[order], other[order]
            first = np.r_[True, one[1:] != one[:-1]]
            best[one[first]] = other[first]
        for mine in np.array_split(np.flatnonzero(near), 1 + np.count_nonzero(near) // 20_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[i] for i in mine], pa.string()), pa.array(near[mine]), pa.array(-n[best[mine]]), pa.array([names[i] for i in best[mine]], pa.string())],
                ["word", "n_near", "less", "form"])

    found = _deal(words, buckets).groupBy("bucket").applyInArrow(run, "word string, n_near long, less long, form string")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("less", "form")).alias("best"))


def last_forms(links: DataFrame) -> DataFrame:
    """(word, root) of (word, form) links without cycles: each round doubles the steps that a link spans."""
    links = stage(links.select("word", F.col("form").alias("root")), "forms")
    while True:
        nxt = links.select(F.col("word").alias("via"), F.col("root").alias("further"))
        jumped = stage(links.join(nxt, F.col("root") == F.col("via"), "left")
                       .select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "forms")
        links = jumped.select("word", "root")
        if not jumped.filter("moved").limit(1).count():
            return links


def group_variants(words: DataFrame, factor: int = 2, buckets: int | None = None) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a table (word, n) of distinct words; a form has at least ``factor`` times the word's n."""
    words = stage(words.select("word", "n"), "words")
    buckets = buckets or max(1, words.rdd.getNumPartitions())
    near = near_words(words, buckets)
    enough = -F.col("best.less") >= factor * F.col("n")
    out = stage(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, F.col("best.form")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n")), "near")
    roots = last_forms(out.filter("form is not null"))
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return group_variants(count_words(docs, typo=TYPO), buckets=max(1, docs.rdd.getNumPartitions()))
