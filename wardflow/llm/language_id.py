"""Language identification with interpolated Kneser-Ney character models.

One order-4 character model per language is counted over every training text
(per-task n-gram counts, then one shuffle of distinct n-grams), and all n-grams
count, however rare. Up to ``LOCAL_GRAMS`` of them (and ``DENSE_CELLS`` probabilities)
the models are broadcast as sorted 64-bit hash arrays. Beyond that counts, contexts and
continuation counts stay tables (``TableModel``): only the most frequent 4-grams'
probabilities are broadcast, and the others that texts have are joined to the tables
by n-gram. Both give the same entropies. A text goes to the language with the
lowest cross-entropy per character. Rejection is calibrated on training rows
that were not counted, and on a beginning of each of them, as far as their best
language is their label: a text is rejected if its cross-entropy lies above what all
but ``FALSE_REJECT`` of such texts of its length have, or if it holds no letter.

Defined results: a null text or one without letters gets ``und``, score 0 and
``accepted`` false; equal cross-entropies go to the alphabetically first
language; repeated rows get equal results; without any labelled text every row
gets ``und``. Texts over ``SLICE`` characters are read in slices whose sums are
added, so the whole text counts. Input columns with the names of output columns
are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm.common import code_points, free_name, give_back, id_bucket, keep_where, mix64, release_cache, stage, table, text_slices, then_give_back

ORDER = 4
SLICE = 300_000
LOCAL_GRAMS = 600_000  # (language, 4-gram) pairs whose models fit on the driver: at most 300 bytes each
FALSE_REJECT = 0.001  # share of right texts of any length that the limit may reject
SHORTEST = 16  # characters; bands of length double from here
DENSE_CELLS = 8_000_000  # log probabilities (8 bytes each) that are broadcast at most
MARK = 1  # before a text
SPACE = 32
RESULT = "lang_pred string, score double, entropy double, accepted boolean"

_LETTERS: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    """Code point -> lower-case letter in 16 bits (letters beyond them folded), anything else -> space."""
    global _LETTERS
    if _LETTERS is None:
        out = np.full(0x110000, SPACE, dtype=np.uint16)
        for cp in range(0x110000):
            ch = chr(cp)
            if ch.isalpha():
                low = ch.lower()
                low = ord(low) if len(low) == 1 else cp
                out[cp] = low if low < 0xFFFF else 0xE000 + low % 0x1800
        out[MARK] = MARK
        _LETTERS = out
    return _LETTERS


def grams(parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed 4-grams of the texts and, for each, its text's place in ``parts``; third: letters of each text.

    Runs of other characters count as one space; three marks stand before each text.
    """
    pad = chr(MARK) * (ORDER - 1)
    codes = _letter_table()[code_points("".join(pad + p.replace(chr(MARK), " ") + " " for p in parts))]
    owner = np.repeat(np.arange(len(parts)), [len(p) + ORDER for p in parts])
    letters = np.bincount(owner[(codes != SPACE) & (codes != MARK)], minlength=len(parts))
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] != SPACE) | ((codes[:-1] != SPACE) & (codes[:-1] != MARK))
    codes, owner = codes[keep].astype(np.uint64), owner[keep]
    key = codes.copy()
    for back in range(1, ORDER):
        key[back:] |= codes[:-back] << np.uint64(16 * back)
    real = codes != MARK
    return key[real], owner[real], letters


def _low(keys: np.ndarray, chars: int) -> np.ndarray:
    return keys & np.uint64((1 << (16 * chars)) - 1)


class HashArray:
    """Sorted 64-bit hashes of n-grams with a value each."""

    def __init__(self, keys: np.ndarray, *values: np.ndarray):
        hashes = mix64(keys)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.values = [np.asarray(v)[order] for v in values]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, found) of each key."""
        h = mix64(keys)
        if not len(self.hashes):
            return np.zeros(len(h), dtype=np.int64), np.zeros(len(h), dtype=bool)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return at, self.hashes[at] == h


def discount_of(n1: int, n2: int) -> float:
    return min(0.95, max(0.1, n1 / (n1 + 2 * n2))) if n1 else 0.5


class KneserNey:
    """Interpolated Kneser-Ney model of one language from the counts of its 4-grams."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, alphabet: int):
        self.keys = keys
        self.uniform = 1.0 / max(alphabet, 1)
        self.levels: list[tuple[HashArray, HashArray, float]] = []  # from order 1 up: n-grams, contexts, discount
        levels = []
        for order in range(ORDER, 0, -1):
            discount = discount_of(int((counts == 1).sum()), int((counts == 2).sum()))
            ctx, inv = np.unique(keys >> np.uint64(16), return_inverse=True)
            total = np.bincount(inv, weights=counts, minlength=len(ctx))
            types = np.bincount(inv, minlength=len(ctx)).astype(float)
            levels.append((HashArray(keys, counts.astype(float)), HashArray(ctx, total, types), discount))
            keys, counts = np.unique(_low(keys, order - 1), return_counts=True)  # continuation counts
        self.levels = levels[::-1]

    def prob(self, keys: np.ndarray, order: int = ORDER) -> np.ndarray:
        if order == 0:
            return np.full(len(keys), self.uniform)
        keys = _low(keys, order)
        lower = self.prob(keys, order - 1)
        ngrams, contexts, discount = self.levels[order - 1]
        at, seen = contexts.find(keys >> np.uint64(16))
        if not seen.any():
            return lower
        total, types = contexts.values[0][at], contexts.values[1][at]
        g, has = ngrams.find(keys)
        count = np.where(has, ngrams.values[0][g] if len(ngrams.hashes) else 0.0, 0.0)
        return np.where(seen, (np.maximum(count - discount, 0) + discount * types * lower) / total, lower)


def _band(n: np.ndarray) -> np.ndarray:
    return np.clip(np.log2(np.maximum(n, 1) / SHORTEST), 0, 15).astype(int)


def _limits(z: np.ndarray, n: np.ndarray, rate: float) -> np.ndarray:
    """For each band the value that a further row exceeds with at most probability ``rate``.

    That is an order statistic of the band's rows, with neighbouring bands' where it has too few
    for the rate; if all together are too few, the tail is carried on as an exponential one.
    """
    band, out = _band(n), np.zeros(16)
    for b in range(16):
        for width in range(16):
            mine = np.sort(z[abs(band - b) <= width])
            at = int(np.ceil((len(mine) + 1) * (1 - rate)))
            if at <= len(mine):
                out[b] = mine[at - 1]
                break
        else:
            share = min(0.5, max(0.1, 20 / len(z)))
            start = np.quantile(z, 1 - share)
            out[b] = max(z.max(), start + (z[z >= start] - start).mean() * np.log(share / rate))
    return out


@dataclass
class LanguageModel:
    languages: list[str]
    models: list[KneserNey] = field(default_factory=list)
    known: HashArray | None = None  # every 4-gram that some model has seen: row of ``logp``
    logp: np.ndarray | None = None  # log probability by known 4-gram and language
    power: float = 1.0
    scale: float = 1.0
    mean: np.ndarray | None = None
    spread: np.ndarray | None = None  # a, b of the variance a + b / n by language
    limits: np.ndarray | None = None  # by band of length, in standard deviations

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cross-entropy per character by text and language; characters; letters."""
        k = len(self.languages)
        sums, n, letters = np.zeros((len(texts), k)), np.zeros(len(texts)), np.zeros(len(texts))
        for group in text_slices(texts, SLICE):
            rows = np.array([r for r, _ in group])
            key, owner, let = grams([t for _, t in group])
            np.add.at(letters, rows, let)
            if not len(key):
                continue
            at, hit = self.known.find(key)
            place = self.known.values[0][at]
            if not hit.all():
                odd, inv = np.unique(key[~hit], return_inverse=True)
                extra = np.stack([np.log(m.prob(odd)) for m in self.models], axis=1)
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            np.add.at(n, rows[owner[starts]], np.diff(np.r_[starts, len(owner)]))
            for j in range(k):
                logp = self.logp[:, j][place]
                if not hit.all():
                    logp[~hit] = extra[inv, j]
                np.add.at(sums[:, j], rows[owner[starts]], -np.add.reduceat(logp, starts))
        return sums / np.maximum(n, 1)[:, None], n, letters

    def build(self) -> LanguageModel:
        keys = np.unique(np.concatenate([m.keys for m in self.models]))
        self.logp = np.asfortranarray(np.stack([np.log(m.prob(keys)) for m in self.models], axis=1))
        self.known = HashArray(keys, np.arange(len(keys)))
        return self

    def predict(self, texts: list[str | None]) -> pd.DataFrame:
        size = len(texts)
        if not self.languages:
            return pd.DataFrame({"lang_pred": ["und"] * size, "score": 0.0, "entropy": np.nan, "accepted": False})
        return self.verdict(*self.entropies(texts))

    def verdict(self, h: np.ndarray, n: np.ndarray, letters: np.ndarray) -> pd.DataFrame:
        size = len(n)
        best = h.argmin(axis=1) if size else np.zeros(0, dtype=int)
        low = h[np.arange(size), best]
        score = 1.0 / np.exp(-(h - low[:, None]) * (self.scale * np.maximum(n, 1) ** self.power)[:, None]).sum(axis=1)
        ok = letters > 0
        if self.mean is not None:
            sd = np.sqrt(self.spread[best, 0] + self.spread[best, 1] / np.maximum(n, 1))
            ok = ok & (low <= self.mean[best] + self.limits[_band(n)] * sd)
        return pd.DataFrame({
            "lang_pred": np.where(letters > 0, np.array(self.languages, dtype=object)[best], "und"),
            "score": np.where(letters > 0, score, 0.0),
            "entropy": np.where(letters > 0, low, np.nan),
            "accepted": ok,
        })


def _low_col(gram, chars: int):
    return gram.bitwiseAND(F.lit((1 << (16 * chars)) - 1)) if chars < ORDER else gram


class TableModel:
    """The models of ``counted`` (lang, gram, n) as tables of any size.

    For each order: n-gram -> what its discounted count is by language, and context ->
    (total, weight of the order below) by language, as maps from the language's number.
    ``head`` holds the log probabilities of the most frequent 4-grams, by language;
    what it lacks is joined. ``verdicts`` is its ``LanguageModel`` for calibration and results.
    """

    def __init__(self, counted: DataFrame, languages: list[str], alphabet: int):
        self.languages, self.uniform = languages, 1.0 / max(alphabet, 1)
        self.verdicts = LanguageModel(languages)
        number = F.create_map(*[x for j, la in enumerate(languages) for x in (F.lit(la), F.lit(j))])
        grams_of = counted.select(number[F.col("lang")].alias("j"), "gram", "n")
        self.levels: list[tuple[DataFrame, DataFrame]] = []
        for order in range(ORDER, 0, -1):
            found = {r["j"]: (r["n1"], r["n2"]) for r in grams_of.groupBy("j").agg(
                F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2")).collect()}  # a row a language
            off = F.array(*[F.lit(discount_of(*found[j])) for j in range(len(languages))])[F.col("j")]
            ngrams = grams_of.groupBy("gram").agg(F.map_from_entries(F.collect_list(F.struct(
                "j", F.greatest(F.col("n") - off, F.lit(0.0))))).alias("known"))  # at most one entry a language
            contexts = grams_of.groupBy("j", F.shiftrightunsigned("gram", 16).alias("ctx")) \
                .agg(F.sum("n").cast("double").alias("total"), F.count("*").alias("types")) \
                .groupBy("ctx").agg(F.map_from_entries(F.collect_list(F.struct(
                    "j", F.struct("total", (off * F.col("types") / F.col("total")).alias("weight"))))).alias("after"))
            self.levels.insert(0, (stage(ngrams, f"language-ngrams-{order}"), stage(contexts, f"language-contexts-{order}")))
            if order > 1:
                grams_of = stage(grams_of.groupBy("j", _low_col(F.col("gram"), order - 1).alias("gram"))
                                 .agg(F.count("*").alias("n")), f"language-continuations-{order - 1}")
        top = counted.groupBy("gram").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "gram") \
            .limit(max(1, min(LOCAL_GRAMS, DENSE_CELLS) // len(languages))).select("gram")
        rows = self.logs(top).toPandas()
        self.head = HashArray(rows["gram"].to_numpy(copy=True).view(np.uint64), np.arange(len(rows)))
        self.logp = np.stack(rows["logp"].to_numpy())

    def logs(self, wanted: DataFrame) -> DataFrame:
        """(gram, logp by language) of the distinct 4-grams in ``wanted``, known or not."""
        below = None
        for order, (ngrams, contexts) in enumerate(self.levels, 1):
            need = wanted.select(_low_col(F.col("gram"), order).alias("gram")).distinct()
            need = need.withColumn("ctx", F.shiftrightunsigned("gram", 16)).withColumn("low", _low_col(F.col("gram"), order - 1))
            if below is None:
                need = need.withColumn("p", F.array_repeat(F.lit(self.uniform), len(self.languages)))
            else:  # each key has one row on the right and at most an alphabet of them on the left
                need = need.join(below.withColumnRenamed("gram", "low"), "low")
            rows = need.join(ngrams, "gram", "left").join(contexts, "ctx", "left")

            def step(lower, j):
                there = F.try_element_at(F.col("after"), j)
                own = F.coalesce(F.try_element_at(F.col("known"), j), F.lit(0.0))
                return F.when(there.isNull(), lower).otherwise(own / there["total"] + there["weight"] * lower)

            below = rows.select("gram", F.transform("p", step).alias("p"))
        return below.select("gram", F.transform("p", lambda p: F.log(p)).alias("logp"))

    def entropies(self, texts: DataFrame) -> DataFrame:
        """(key, h by language, n, letters) of each distinct ``text`` of ``texts`` that isn't null."""
        k, shared = len(self.languages), texts.sparkSession.sparkContext.broadcast((self.head, self.logp))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            head, logp = shared.value
            for batch in batches:
                parts, keys = batch.column(1).to_pylist(), batch.column(0)
                sums, n, letters = np.zeros((len(parts), k)), np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
                for group in text_slices(parts, SLICE):
                    rows = np.array([r for r, _ in group])
                    key, owner, let = grams([t for _, t in group])
                    np.add.at(letters, rows, let)
                    np.add.at(n, rows, np.bincount(owner, minlength=len(rows)))
                    at, hit = head.find(key)
                    place = head.values[0][at[hit]]
                    for j in range(k):
                        np.add.at(sums[:, j], rows, -np.bincount(owner[hit], weights=logp[place, j], minlength=len(rows)))
                    rare, c = np.unique(np.stack([rows[owner[~hit]].astype(np.uint64), key[~hit]]), axis=1, return_counts=True)
                    if len(c):
                        yield pa.RecordBatch.from_arrays(
                            [keys.take(pa.array(rare[0].astype(np.int64))), pa.array(rare[1].view(np.int64)), pa.array(c.astype(np.int64)),
                             *[pa.nulls(len(c), t) for t in (pa.int64(), pa.int64(), pa.list_(pa.float64()))]], names)
                if parts:
                    yield pa.RecordBatch.from_arrays(
                        [keys, pa.nulls(len(parts), pa.int64()), pa.array(np.ones(len(parts), np.int64)), pa.array(n), pa.array(letters),
                         pa.array(list(sums), pa.list_(pa.float64()))], names)

        names = ["key", "gram", "c", "n", "letters", "s"]
        rows = texts.filter("text is not null").select(text_key("text").alias("key"), "text")
        rows = stage(rows.mapInArrow(run, "key binary, gram long, c long, n long, letters long, s array<double>"), "language-lookups")
        whole, rare = rows.filter("gram is null"), rows.filter("gram is not null").select("key", "gram", "c")
        joined = rare.join(self.logs(rare), "gram").select(
            "key", F.lit(0).cast("long").alias("copies"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("letters"),
            F.transform("logp", lambda x: -x * F.col("c")).alias("s"))
        every = whole.select("key", F.col("c").alias("copies"), "n", "letters", "s").unionByName(joined)
        sums = every.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("copies", "n", "letters")],
                                        *[F.sum(F.col("s")[j]).alias(f"s{j}") for j in range(k)])  # copies of a text add up alike
        return sums.select("key", F.array(*[F.col(f"s{j}") / F.greatest(F.col("n"), F.lit(1)) for j in range(k)]).alias("h"),
                           *[(F.col(c) / F.col("copies")).alias(c) for c in ("n", "letters")])

    def results(self, docs: DataFrame, text_col: str) -> DataFrame:
        """(key, result) of each distinct text of ``docs``."""
        shared = docs.sparkSession.sparkContext.broadcast(self.verdicts)

        @F.pandas_udf(RESULT)
        def judge(h: pd.Series, n: pd.Series, letters: pd.Series) -> pd.DataFrame:
            return shared.value.verdict(np.stack(h.to_numpy()) if len(h) else np.zeros((0, 1)), n.to_numpy(), letters.to_numpy())

        return self.entropies(docs.select(F.col(text_col).alias("text"))).select("key", judge.asNondeterministic()("h", "n", "letters").alias("result"))


def text_key(text):
    return F.unhex(F.md5(F.col(text).cast("binary")))


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, 4-gram, count) of this task; counts of one language are merged as they come."""
    seen: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def merged(parts):
        keys, inv = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        return keys, np.bincount(inv, weights=np.concatenate([c for _, c in parts]), minlength=len(keys)).astype(np.int64)

    def rows(lang, parts):
        keys, counts = merged(parts)
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(counts)], ["lang", "gram", "n"])

    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang in sorted(set(langs)):
            for group in text_slices([t for la, t in zip(langs, texts, strict=True) if la == lang], SLICE):
                parts = seen.setdefault(lang, [])
                parts.append(np.unique(grams([t for _, t in group])[0], return_counts=True))
                if len(parts) >= 8:
                    parts[:] = [merged(parts)]
                if sum(len(k) for k, _ in parts) > 4_000_000:  # bounded memory: hand on what has been counted
                    yield rows(lang, parts)
                    parts.clear()
    for lang, parts in seen.items():
        if parts:
            yield rows(lang, parts)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          calibration_rows: int = 20_000, max_languages: int = 500) -> LanguageModel | TableModel:
    """Count, build and calibrate on the rows given; rows without a language are left out.

    About ``calibration_rows`` rows (by the id's hash, of a null id the text's; at most one in
    four) set the posterior's temperature and the rejection limit; all others are counted,
    with all their 4-grams, and so are all rows of a language that would have none counted. Models of at most
    ``LOCAL_GRAMS`` entries and ``DENSE_CELLS`` probabilities come to the driver; larger
    ones stay tables, with the same results.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")) \
        .filter("lang is not null and text is not null")
    part = F.pmod(F.xxhash64(F.col("id"), F.when(F.col("id").isNull(), F.col("text")), F.lit("calibrate")), F.lit(1 << 20))
    found = rows.groupBy("lang").agg(F.count("*").alias("c"), F.max(F.when(F.col("text").rlike(r"\p{L}"), part)).alias("last")) \
        .limit(max_languages + 1).collect()
    if len(found) > max_languages:
        raise ValueError(f"more than {max_languages} languages (max_languages)")
    if not found:
        return LanguageModel([])
    bound = int(min(0.25, calibration_rows / sum(r["c"] for r in found)) * (1 << 20))
    aside = (part < bound) & ~F.col("lang").isin([r["lang"] for r in found if (r["last"] or 0) < bound])
    counted = rows.filter(~aside).select("lang", "text") \
        .mapInArrow(then_give_back(_count_grams), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counted = stage(counted, "language-grams")
    languages, total = sorted(r["lang"] for r in found), counted.count()
    if total > LOCAL_GRAMS or total * len(languages) > DENSE_CELLS:
        alphabet = counted.select(_low_col(F.col("gram"), 1).alias("c")).distinct().count() + 1
        model = TableModel(counted, languages, alphabet)
    else:
        model = LanguageModel(languages)
        kept = counted.toPandas()
        alphabet = len(np.unique(kept["gram"].to_numpy().view(np.uint64) & np.uint64(0xFFFF))) + 1
        for lang in model.languages:
            mine = kept[kept["lang"] == lang]
            keys = mine["gram"].to_numpy(copy=True).view(np.uint64)
            order = np.argsort(keys)
            model.models.append(KneserNey(keys[order], mine["n"].to_numpy()[order], alphabet))
        model.build()
    _calibrate(model, rows.filter(aside).select("lang", "text"))
    return model


def _measured(model: LanguageModel | TableModel, rows: DataFrame) -> pd.DataFrame:
    """(lang, whole, n, h) of the rows (lang, whole, text) with a letter."""
    if isinstance(model, TableModel):
        rows = stage(rows, "language-calibration")
        measured = model.entropies(rows.select("text")).filter("letters > 0")
        return rows.select("lang", "whole", text_key("text").alias("key")).join(measured, "key").select("lang", "whole", "n", "h").toPandas()
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, n, letters = shared.value.entropies(batch.column("text").to_pylist())
            use = np.flatnonzero(letters > 0)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).take(pa.array(use)) for c in ("lang", "whole")], pa.array(n[use]), pa.array(list(h[use]), pa.list_(pa.float64()))],
                ["lang", "whole", "n", "h"])

    return rows.mapInArrow(then_give_back(measure), "lang string, whole boolean, n double, h array<double>").toPandas()


def _with_beginnings(rows: DataFrame) -> DataFrame:
    """(lang, whole, text): each text, and its first 16, 32, 64 ... characters, one of these by the text's hash."""
    bands = F.floor(F.log2(F.length("text") / F.lit(SHORTEST))).cast("int")
    size = F.lit(SHORTEST) * F.pow(F.lit(2), F.pmod(F.xxhash64("text"), F.greatest(bands, F.lit(1))))
    part = F.when(F.length("text") > SHORTEST, F.substring(F.col("text"), F.lit(1), size.cast("int")))
    each = F.explode(F.array(F.struct(F.lit(True).alias("whole"), "text"), F.struct(F.lit(False).alias("whole"), part.alias("text"))))
    return rows.select("lang", each.alias("x")).select("lang", "x.whole", "x.text").filter("text is not null")


def _calibrate(model: LanguageModel | TableModel, rows: DataFrame) -> None:
    """Fit temperature and rejection limit on a bounded random sample of rows that no model has counted."""
    got = _measured(model, _with_beginnings(rows))
    names = model.languages
    model = model.verdicts if isinstance(model, TableModel) else model
    if not len(got):
        return
    h, n = np.stack(got["h"].to_numpy()), got["n"].to_numpy()
    true = np.array([names.index(x) for x in got["lang"]])
    whole = got["whole"].to_numpy(bool)
    best = None
    for power in (0.25, 0.5, 1.0):
        for scale in 2.0 ** np.arange(-4, 6):
            z = (-h * (scale * n ** power)[:, None])[whole]
            z -= z.max(axis=1, keepdims=True)
            loss = float(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), true[whole]]))
            if best is None or loss < best[0]:
                best = (loss, power, scale)
    model.power, model.scale = best[1], best[2]
    k, right = len(names), h.argmin(axis=1) == true  # mislabelled texts set no limit
    if not right.any():
        return
    n, true = n[right], true[right]
    own = h[right, true]
    model.mean = np.array([own[true == j].mean() if (true == j).any() else own.mean() for j in range(k)])
    model.spread = np.zeros((k, 2))
    off = own - model.mean[true]
    for j in range(k):
        mine = true == j if (true == j).sum() >= 30 else np.ones(len(true), dtype=bool)
        a = np.stack([np.ones(mine.sum()), 1 / n[mine]], axis=1)
        w = 1 / (1 + 1000 / n[mine])  # short texts vary more
        fit = np.linalg.lstsq(a * w[:, None], off[mine] ** 2 * w, rcond=None)[0]
        model.spread[j] = np.maximum(fit, [1e-4, 1e-2])
    z = off / np.sqrt(model.spread[true, 0] + model.spread[true, 1] / n)
    model.limits = _limits(z, n, FALSE_REJECT)


def language_of(spark: SparkSession, model: LanguageModel, text):
    """The struct (lang_pred, score, entropy, accepted) of a text column."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        release_cache()
        for batch in texts:
            yield shared.value.predict([t if isinstance(t, str) else None for t in batch])
        give_back()

    # not moved or repeated by the optimizer, whatever is done with its fields
    return predict.asNondeterministic()(text)


def _und():
    return F.struct(F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("entropy"), F.lit(False).alias("accepted"))


def add_language(docs: DataFrame, model: LanguageModel | TableModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score``, ``entropy`` and ``accepted``."""
    names = ("lang_pred", "score", "entropy", "accepted")
    own = free_name(docs, "language")
    if isinstance(model, TableModel):
        key = free_name(docs, "text_key")
        found = model.results(docs, text_col).select(F.col("key").alias(key), F.col("result").alias(own))
        out = docs.withColumn(key, text_key(text_col)).join(found, key, "left").drop(key).withColumn(own, F.coalesce(own, _und()))
    else:
        out = docs.withColumn(own, language_of(docs.sparkSession, model, F.col(text_col)))
    return out.withColumns({c: F.col(f"{own}.{c}") for c in names}).drop(own)


def keep_accepted(docs: DataFrame, model: LanguageModel | TableModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model accepts, unchanged."""
    if isinstance(model, TableModel):
        key = free_name(docs, "text_key")
        good = model.results(docs, text_col).filter("result.accepted").select(F.col("key").alias(key))
        return docs.withColumn(key, text_key(text_col)).join(good, key, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
    return keep_where(docs, language_of(docs.sparkSession, model, F.col(text_col)), "accepted")


def held_out(id_col: str = "doc_id"):
    """Rows that no model may learn from: crc32 of the id as text leaves 2 by 4."""
    return F.pmod(id_bucket(id_col), F.lit(4)) == 2


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", held_out())
    model = train(docs.filter("not held_out"))
    return add_language(docs.select("doc_id", "text", "held_out"), model) \
        .select("doc_id", "held_out", "lang_pred", "score", "entropy", "accepted")
