"""URL rules and block lists by Bloom filter cascades.

A cascade answers membership in a list exactly for every key of a known
universe: level 1 holds the listed keys, level 2 those other keys of the universe
that level 1 passes by mistake, level 3 the listed keys that level 2 passes, and
so on until no mistake is left. It is small enough to be sent to all tasks, so
judging a URL needs no join and no shuffle; the universe is the complete set of
keys of the corpus to be judged.

A URL's keys are its host and every parent domain, each with the beginnings of its
path that are as long as some rule's path; the longest key that a rule lists
decides. Where none does, a second kind of key, host and path as a whole, is looked
up in a cascade of blocked pages.

Cascades are built by Spark jobs over the keys' hashes (two 64-bit hashes a key)
and each level's bits are put together by ``bit_or``. A level may have at most ``MOST_BITS``
bits, which bounds what is broadcast; a list that needs more is looked up by an
exact semi-join instead (``blocked_by_join``).

Defined results: host: from the first ``://`` up to ``/``, ``?``, ``#`` or the end,
A-Z as a-z; path: from there up to ``?``, ``#`` or the end; without ``://``, and for a
null url, both are empty. No rule fits an empty host. Repeated rows get equal results; an
empty list blocks nothing. Input columns with the names of output columns are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import mix64, stage, table

MOST_BITS = 1 << 28
MOST_LEVELS = 64

# Rules as given: (verdict, host and path)
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))


def host_and_path(url_col: str = "url"):
    """The two expressions."""
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_keys(rules, host: str = "host", path: str = "path"):
    """Array of the keys of a URL that could be a rule: longest first, equally long ones by text."""
    lengths = sorted({len(r) - r.index("/") for _, r in rules})
    labels = F.split(F.col(host), r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    keys = F.flatten(F.transform(parents, lambda h: F.transform(
        F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(path)),
        lambda n: F.concat(h, F.col(path).substr(F.lit(1), n)))))
    return F.reverse(F.array_sort(F.transform(F.when(F.col(host) != "", keys).otherwise(F.array().cast("array<string>")),
                                              lambda k: F.struct(F.length(k).alias("n"), k.alias("k")))))["k"]


def hashes(key):
    return F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(7), key).alias("h2")


def _places(h1: np.ndarray, h2: np.ndarray, level: int, bits: int, probes: int) -> np.ndarray:
    """Bits of each key, one column a probe."""
    with np.errstate(over="ignore"):
        a = mix64(h1.view(np.uint64) + np.uint64(level) * np.uint64(0x9E3779B97F4A7C15))
        b = mix64(h2.view(np.uint64) ^ np.uint64(level)) | np.uint64(1)
        return (a[:, None] + np.arange(probes, dtype=np.uint64)[None] * b[:, None]) % np.uint64(bits)


@dataclass
class Cascade:
    """Levels of (bits, probes, words); the listed keys are in level 1, what it passes by mistake in level 2 ..."""

    levels: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def passes(self, level: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        bits, probes, words = self.levels[level]
        at = _places(h1, h2, level, bits, probes)
        return ((words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=1)

    def contains(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Exact for all keys of the universe the cascade was built over."""
        out = np.zeros(len(h1), bool)
        open_ = np.arange(len(h1))
        for level in range(len(self.levels)):
            ok = self.passes(level, h1[open_], h2[open_])
            out[open_[~ok]] = level % 2 == 1  # the set of this level isn't the key's
            open_ = open_[ok]
        out[open_] = len(self.levels) % 2 == 1
        return out


class TooLarge(ValueError):
    pass


def build_cascade(listed: DataFrame, universe: DataFrame, most_bits: int = MOST_BITS) -> Cascade:
    """``listed`` and ``universe``: columns h1, h2 of distinct keys; listed keys outside the universe don't matter."""
    spark = universe.sparkSession
    inside = stage(listed.join(universe, ["h1", "h2"], "left_semi"), "listed")
    others = stage(universe.join(listed, ["h1", "h2"], "left_anti"), "unlisted")
    cascade = Cascade()
    own, other = inside, others
    n, m = own.count(), other.count()
    while n:
        if len(cascade.levels) >= MOST_LEVELS:
            raise RuntimeError("the cascade does not end")
        # so few mistakes in level 1 that level 2 is about as small as level 1
        wrong = min(0.5, n / (2 * m)) if not cascade.levels and m else 0.5
        probes = max(1, round(-np.log2(wrong)))
        bits = max(64, int(np.ceil(n * probes / np.log(2) / 64)) * 64)
        if bits > most_bits:
            raise TooLarge(f"a level of {bits} bits; most_bits is {most_bits}")
        level = len(cascade.levels)

        def touch(batches: Iterator[pa.RecordBatch], level=level, bits=bits, probes=probes) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = _places(batch.column("h1").to_numpy(), batch.column("h2").to_numpy(), level, bits, probes).ravel()
                at = np.unique(at)
                word, start = np.unique(at >> np.uint64(6), return_index=True)
                if len(word):
                    value = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), start)
                    yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int64)), pa.array(value.view(np.int64))], ["word", "value"])

        words = np.zeros(bits // 64, np.uint64)
        got = own.mapInArrow(touch, "word long, value long").groupBy("word").agg(F.bit_or("value").alias("value")).toArrow()
        words[got.column("word").to_numpy()] = got.column("value").to_numpy().view(np.uint64)  # at most bits / 64 rows
        cascade.levels.append((bits, probes, words))
        shared = spark.sparkContext.broadcast(cascade)

        def mistaken(batches: Iterator[pa.RecordBatch], level=level, shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(shared.value.passes(level, batch.column("h1").to_numpy(), batch.column("h2").to_numpy())))

        own, other = stage(other.mapInArrow(mistaken, "h1 long, h2 long"), "mistaken"), own
        n, m = own.count(), n
    return cascade


def with_keys(pages: DataFrame, rules, url_col: str = "url") -> DataFrame:
    """``pages`` with host, path, the keys of possible rules, and the hashes of the page's own key."""
    host, path = host_and_path(url_col)
    out = pages.withColumns({"host": host, "path": path})
    h1, h2 = hashes(F.concat("host", "path"))
    return out.withColumns({"__keys": rule_keys(rules), "__h1": h1, "__h2": h2})


def rule_universe(keyed: DataFrame) -> DataFrame:
    return keyed.select(F.explode("__keys").alias("k")).select(*hashes(F.col("k"))).distinct()


def page_universe(keyed: DataFrame) -> DataFrame:
    return keyed.select(F.col("__h1").alias("h1"), F.col("__h2").alias("h2")).distinct()


def judge(pages: DataFrame, rules=RULES, blocked: DataFrame | None = None, url_col: str = "url", most_bits: int = MOST_BITS) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` (allow or block).

    ``blocked``: a column ``key`` of blocked pages, host and path. If its cascade would be too large to broadcast,
    the same answer comes from a semi-join.
    """
    spark = pages.sparkSession
    keyed = with_keys(pages, rules, url_col)
    universe = stage(rule_universe(keyed), "rule-keys")
    cascades = {}
    for verdict in ("allow", "block"):
        mine = [(r,) for v, r in rules if v == verdict]
        listed = spark.createDataFrame(mine, "k string").select(*hashes(F.col("k"))).distinct()
        cascades[verdict] = build_cascade(listed, universe, most_bits)
    exact = None
    cascades["page"] = Cascade()
    if blocked is not None:
        listed = blocked.select(*hashes(F.col("key"))).distinct()
        try:
            cascades["page"] = build_cascade(listed, stage(page_universe(keyed), "page-keys"), most_bits)
        except TooLarge:
            exact = listed
    shared = spark.sparkContext.broadcast(cascades)

    @F.pandas_udf("rule int, verdict string")
    def look_up(k1: pd.Series, k2: pd.Series, h1: pd.Series, h2: pd.Series) -> pd.DataFrame:
        size = np.array([len(k) for k in k1], np.int64)
        a, b = (np.concatenate([np.zeros(0, np.int64), *x]).astype(np.int64) for x in (k1, k2))
        allow, block = shared.value["allow"].contains(a, b), shared.value["block"].contains(a, b)
        row = np.repeat(np.arange(len(size)), size)
        hit = np.flatnonzero(allow | block)
        rows, first = np.unique(row[hit], return_index=True)  # keys are longest first
        hit = hit[first]
        page = shared.value["page"].contains(h1.to_numpy(), h2.to_numpy())
        verdict = np.where(page, "block", "allow").astype(object)
        verdict[rows] = np.where(block[hit], "block", "allow")
        rule = np.zeros(len(size), np.int32)
        rule[rows] = hit - (np.cumsum(size) - size)[rows] + 1
        return pd.DataFrame({"rule": rule, "verdict": verdict})

    found = keyed.withColumn("__found", look_up.asNondeterministic()(
        F.transform("__keys", lambda k: F.xxhash64(k)), F.transform("__keys", lambda k: F.xxhash64(F.lit(7), k)), F.col("__h1"), F.col("__h2")))
    out = found.withColumns({"rule": F.try_element_at(F.col("__keys"), F.nullif(F.col("__found.rule"), F.lit(0))),
                             "verdict": F.col("__found.verdict")})
    if exact is not None:
        out = blocked_by_join(out, exact)
    return out.drop("__keys", "__h1", "__h2", "__found")


def blocked_by_join(judged: DataFrame, listed: DataFrame) -> DataFrame:
    """The verdict of pages without a rule, for a list beyond the bound of a cascade."""
    known = listed.select(F.col("h1").alias("__h1"), F.col("h2").alias("__h2"), F.lit(True).alias("__listed"))
    return judged.join(known, ["__h1", "__h2"], "left") \
        .withColumn("verdict", F.when(F.col("rule").isNull() & F.col("__listed"), "block").otherwise(F.col("verdict"))).drop("__listed")


def pages_of_toxic_documents(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Block list of the query: keys of pages whose number names a document labelled toxic."""
    host, path = host_and_path()
    number = F.expr("try_cast(regexp_extract(__path, '^/[a-z]+/([0-9]{1,18})', 1) as bigint)")
    toxic = labels.filter("toxic = 1 and doc_id is not null").select(F.col("doc_id").alias("n")).distinct()
    return pages.select(host.alias("__host"), path.alias("__path")).withColumn("n", number) \
        .join(toxic, "n", "left_semi").select(F.concat("__host", "__path").alias("key")).distinct()


def op6_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    blocked = pages_of_toxic_documents(pages, table(spark, sf_dir, "labels"))
    return judge(pages, RULES, blocked).select("page_id", "host", "path", "rule", "verdict")


# The rules by hand, and the block list by a join
OP6_SQL = """
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), rules(verdict, rule, rule_host, rule_path) AS (
  VALUES ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'), ('block', 'example.org/en/1', 'example.org', '/en/1'),
         ('allow', 'com/fr/', 'com', '/fr/'), ('block', 'com/de/', 'com', '/de/')
), fits AS (
  SELECT s.page_id, s.host, s.path, r.rule, r.verdict, row_number() OVER (PARTITION BY s.page_id ORDER BY length(r.rule) DESC) AS k
  FROM split s JOIN rules r ON (s.host = r.rule_host OR ends_with(s.host, '.' || r.rule_host)) AND starts_with(s.path, r.rule_path)
), blocked AS (
  SELECT DISTINCT host, path FROM split
  WHERE try_cast(regexp_extract(path, '^/[a-z]+/([0-9]{1,18})', 1) AS BIGINT) IN (SELECT doc_id FROM labels WHERE toxic = 1)
)
SELECT s.page_id, s.host, s.path, f.rule, coalesce(f.verdict, CASE WHEN b.host IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM split s LEFT JOIN (SELECT * FROM fits WHERE k = 1) f ON f.page_id = s.page_id
LEFT JOIN blocked b ON b.host = s.host AND b.path = s.path
"""
