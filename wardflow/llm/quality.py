"""Quality rules: counts with fixed limits and a calibrated n-gram classifier.

The classifier is a logistic regression on hashed word (one and two words) and
character (three) n-grams, learnt from labelled rows and calibrated on labelled
rows that it has not learnt from. A row's score is the mean weight of its word
n-grams plus that of its character n-grams, so one pass over an Arrow batch
scores its texts with array operations; whole texts are read.

Words are runs of anything but blank, tab, and the line and page breaks
``\\x0A-\\x0D``. Defined results: a null or empty text has no words and fails the
base rules; null or unmatched labels aren't learnt from, and a document labelled
twice counts with its worse label; with labels of one kind only (or none), every
row that passes the base rules is kept. Repeated rows get equal results. Input
columns with the names of output columns are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardflow.llm.common import free_name, give_back, keep_where, mix64, release_cache, stage, table, then_give_back

BITS = 14  # hashed features of each of the three families
WINDOW = 8  # words of a repeated passage
BLANKS = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
STEP_CHARS = 2_000_000
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RESULT = ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, quality double, kept boolean"

MIN_WORDS = 20
REPEAT_PERCENT = 30
KEEP_FROM = 0.5  # calibrated probability of good quality, among documents as the labelled ones: what is more likely good stays


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.r_[0, np.cumsum(sizes)[:-1]].astype(np.int64) if len(sizes) else np.zeros(0, np.int64)


def _sum_by(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = np.r_[0, np.cumsum(values)]
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def repeated_words(hashes: np.ndarray, sizes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """By text: its words that lie in a ``window``-word passage found at least twice in it. ``hashes``: all words in a row."""
    n = len(hashes)
    if n < window:
        return np.zeros(len(sizes), np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    h = hashes.astype(np.uint64)
    key = np.zeros(n - window + 1, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(window):
            key = key * np.uint64(0x9E3779B97F4A7C15) + h[j:n - window + 1 + j]
        key = mix64(key ^ mix64(owner[:n - window + 1].astype(np.uint64) + np.uint64(1)))
    at = np.flatnonzero(owner[:n - window + 1] == owner[window - 1:])
    if not len(at):  # no text is as long as a window
        return np.zeros(len(sizes), np.int64)
    order = np.argsort(key[at], kind="stable")
    k = key[at][order]
    same = k[1:] == k[:-1]
    twice = at[order[np.r_[same, False] | np.r_[False, same]]]
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + window, -1)
    return _sum_by((np.cumsum(edge[:-1]) > 0).astype(np.int64), sizes)


def counts_of(texts: list[bytes]) -> tuple[pd.DataFrame, list[list[bytes]]]:
    """The base counts of UTF-8 texts, and their words."""
    words = [t.split() for t in texts]  # bytes split at exactly the six blanks
    sizes = np.array([len(w) for w in words], np.int64)
    flat = [w for ws in words for w in ws]
    repeats = repeated_words(np.fromiter(map(hash, flat), np.int64, len(flat)).view(np.uint64), sizes)
    chars, symbols, dup = [], [], []
    for text in texts:
        points = len(text) if text.isascii() else len(text.decode("utf-8", "replace"))
        chars.append(points - sum(text.count(c) for c in BLANKS))
        symbols.append(sum(text.count(c) for c in SYMBOLS))
        lines = [x for x in text.split(b"\n") if x.strip(BLANKS)] if b"\n" in text else []
        dup.append(len(lines) - len(set(lines)))
    return pd.DataFrame(dict(zip(COUNTS, (sizes, chars, symbols, dup, repeats), strict=True)), dtype="int64"), words


def _slots(texts: list[bytes], words: list[list[bytes]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each family: the slots of all texts' n-grams in a row, and how many each text has."""
    mask = np.uint64((1 << BITS) - 1)
    sizes = np.array([len(w) for w in words], np.int64)
    flat = np.fromiter((crc32(w) for ws in words for w in ws), np.uint64, int(sizes.sum()))
    last = np.cumsum(sizes)[sizes > 0] - 1
    two = np.ones(len(flat), bool)
    two[last] = False
    one_word = (flat * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)
    pairs = np.flatnonzero(two)
    with np.errstate(over="ignore"):
        two_words = ((flat[pairs] * np.uint64(31) + flat[np.minimum(pairs + 1, max(len(flat) - 1, 0))]) * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - BITS)
        raw = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint32)
        long = np.array([len(t) for t in texts], np.int64)
        tri = (raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]) if len(raw) >= 3 else np.zeros(0, np.uint32)
        tri = (tri * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
    owner = np.repeat(np.arange(len(texts)), long)
    inside = owner[:-2] == owner[2:] if len(raw) >= 3 else np.zeros(0, bool)
    return [((one_word & mask).astype(np.int32), sizes),
            ((two_words & mask).astype(np.int32), np.maximum(sizes - 1, 0)),
            (tri[inside].astype(np.int32), np.maximum(long - 2, 0))]


@dataclass
class QualityModel:
    weights: np.ndarray | None = None  # families x slots
    slope: float = 1.0
    offset: float = 0.0

    def raw(self, texts: list[bytes], words: list[list[bytes]]) -> np.ndarray:
        out = np.zeros(len(texts))
        for w, (slots, sizes) in zip(self.weights, _slots(texts, words), strict=True):
            out += _sum_by(w[slots], sizes) / np.maximum(sizes, 1)
        return out

    def predict(self, texts: list[str | bytes | None]) -> pd.DataFrame:
        parts = []
        data = [(t.encode("utf-8", "surrogatepass") if isinstance(t, str) else t) or b"" for t in texts]
        at = 0
        while at < len(data) or not parts:
            upto, size = at, 0
            while upto < len(data) and (upto == at or size + len(data[upto]) <= STEP_CHARS):
                size += len(data[upto])
                upto += 1
            some = data[at:upto]
            out, words = counts_of(some)
            out["base_failed"] = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > REPEAT_PERCENT * out["n_words"])
            out["quality"] = 1.0 if self.weights is None else 1 / (1 + np.exp(-(self.slope * self.raw(some, words) + self.offset)))
            out["kept"] = ~out["base_failed"] & (out["quality"] >= KEEP_FROM)
            parts.append(out)
            at = max(upto, at + 1)
        return pd.concat(parts, ignore_index=True)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          most_rows: int = 6000, seed: str = "quality", rounds: int = 300, most_bytes: int = 300_000_000) -> QualityModel:
    """Fit on about ``most_rows`` labelled documents, the bound of the training sample, chosen by a hash of the id.

    Half the sample is taken from each label, as far as it goes, in the order of the hash until the rows' features
    reach ``most_bytes``. One in four of its rows calibrates (Platt scaling), where each label weighs what it has among all
    labelled rows, so that a probability holds for documents as those.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).dropna() \
        .groupBy("id").agg(F.min("y").alias("y")).withColumn("h", F.xxhash64("id", F.lit(seed)))
    sample = known.filter("y <= 0").orderBy("h", "id").limit(most_rows // 2) \
        .unionByName(known.filter("y > 0").orderBy("h", "id").limit(most_rows // 2))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            slots, values = [], []
            for text in texts:
                mine, share = [], []
                for f, (s, sizes) in enumerate(_slots([text], [text.split()])):
                    got, n = np.unique(s, return_counts=True)
                    mine.append(got + (f << BITS))
                    share.append(n / max(int(sizes[0]), 1))
                slots.append(np.concatenate(mine).astype("<u2").tobytes())
                values.append(np.concatenate(share).astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("y"), batch.column("h"), pa.array(slots, pa.binary()), pa.array(values, pa.binary())], ["y", "h", "slots", "values"])

    share = {bool(r["good"]): r["count"] for r in known.groupBy((F.col("y") > 0).alias("good")).count().collect()}
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).filter("text is not null")
    # at most most_rows ids and labels: their number is bounded by the limits above
    rows = texts.join(F.broadcast(sample), "id").select("text", "y", "h") \
        .mapInArrow(then_give_back(features), "y int, h long, slots binary, values binary")
    rows = stage(rows, "quality-sample")
    so_far = F.sum(F.length("slots") + F.length("values")).over(Window.orderBy("h", "y"))  # most_rows rows at most
    fit = rows.select("h", "y", "slots", "values", so_far.alias("bytes")).filter(F.col("bytes") <= most_bytes) \
        .select("y", "h", "slots", "values").toArrow()
    try:
        return _fit(fit, rounds, share.get(True, 0) / max(1, sum(share.values())))
    finally:
        del fit
        give_back()  # later stages share the driver with what the fit held


def _fit(rows: pa.Table, rounds: int, prior: float, scale: float = 30.0, decay: float = 1e-4) -> QualityModel:
    """``prior``: the share of good rows among all labelled ones."""
    y = (rows.column("y").to_numpy() > 0).astype(float)
    if len(set(y)) < 2:
        return QualityModel()
    held = rows.column("h").to_numpy() % 4 == 3
    # what the driver holds through all rounds: a slot and a share for each row and feature
    idx = np.concatenate([np.frombuffer(x.as_buffer(), "<u2") for x in rows.column("slots")])
    val = np.concatenate([np.frombuffer(x.as_buffer(), "<f4") for x in rows.column("values")])
    sizes = np.array([len(x.as_buffer()) // 2 for x in rows.column("slots")], np.int64)
    del rows
    val *= np.float32(scale)
    ends = np.cumsum(sizes)
    blocks = [(i, min(i + 500, len(y))) for i in range(0, len(y), 500)]
    learn = ~held  # held rows have no weight in the fit
    w, b = np.zeros(3 << BITS), 0.0

    def scores() -> np.ndarray:
        narrow, out = w.astype(np.float32), np.zeros(len(y))
        for i, j in blocks:
            at = slice(ends[i] - sizes[i], ends[j - 1])
            row = np.repeat(np.arange(j - i), sizes[i:j])
            out[i:j] = np.bincount(row, weights=narrow[idx[at]] * val[at], minlength=j - i)
        return out + b

    m, v, step = np.zeros_like(w), np.zeros_like(w), 0.05
    weight = np.where(y > 0, 0.5 / max(y[learn].sum(), 1), 0.5 / max((1 - y[learn]).sum(), 1)) * learn
    for n in range(1, rounds + 1):  # Adam on the whole sample
        err = (1 / (1 + np.exp(-scores())) - y) * weight
        g = decay * w
        for i, j in blocks:
            at = slice(ends[i] - sizes[i], ends[j - 1])
            g += np.bincount(idx[at], weights=val[at] * np.repeat(err[i:j], sizes[i:j]), minlength=len(w))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= step * (m / (1 - 0.9 ** n)) / (np.sqrt(v / (1 - 0.999 ** n)) + 1e-8)
        b -= step * float(err.sum())
    z = scores()
    use = held if len(set(y[held])) == 2 else np.ones(len(y), bool)
    a, c = 1.0, 0.0
    target = np.where(y[use] > 0, (y[use].sum() + 1) / (y[use].sum() + 2), 1 / ((1 - y[use]).sum() + 2))
    cw = np.where(y[use] > 0, prior / y[use].sum(), (1 - prior) / (1 - y[use]).sum())
    for _ in range(50):  # Newton steps of Platt scaling
        p = 1 / (1 + np.exp(-(a * z[use] + c)))
        d, q = (p - target) * cw, p * (1 - p) * cw
        hess = np.array([[np.sum(q * z[use] ** 2), np.sum(q * z[use])], [np.sum(q * z[use]), np.sum(q)]]) + 1e-6 * np.eye(2)
        change = np.linalg.solve(hess, [np.sum(d * z[use]), np.sum(d)])
        a, c = a - float(np.clip(change[0], -1, 1)), c - float(np.clip(change[1], -1, 1))
    return QualityModel((w * scale).reshape(3, 1 << BITS), a, a * b + c)


def quality_of(spark: SparkSession, model: QualityModel, text):
    """The struct of base counts, ``base_failed``, ``quality`` (probability) and ``kept`` of a text column."""
    shared = spark.sparkContext.broadcast(model)  # three families of 2^BITS weights

    @F.pandas_udf(RESULT)
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        release_cache()
        for batch in texts:
            yield shared.value.predict([t if isinstance(t, str) else None for t in batch])
        give_back()

    # not moved or repeated by the optimizer, whatever is done with its fields
    return predict.asNondeterministic()(text)


def add_quality(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """``docs`` with the fields of :func:`quality_of`."""
    own = free_name(docs, "rules")
    out = docs.withColumn(own, quality_of(docs.sparkSession, model, F.col(text_col)))
    return out.withColumns({c: F.col(f"{own}.{c}") for c in (*COUNTS, "base_failed", "quality", "kept")}).drop(own)


def keep_good(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, unchanged."""
    return keep_where(docs, quality_of(docs.sparkSession, model, F.col(text_col)), "kept")


def op8_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return add_quality(docs, model).select("doc_id", *COUNTS, "base_failed", "kept", "quality")
