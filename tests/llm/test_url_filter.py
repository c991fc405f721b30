import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardflow.llm import url_filter as U

URLS = ["http://a.example.org/es/1", "https://example.org/es/", "https://example.org/es", "https://badexample.org/es/1", "https://EXAMPLE.org/en/12?x#y", "https://x.com/fr/", "https://x.com/fr",
        "https://x.com/de/1", "x.com/de/1", "://com/de/", "https:///de/", "", None, "https://org", "https://org/", "https://org?/", "ftp://user@host.com:80/de/", "http://x.net/a",
        "http://x.net/b?q", "http://x.net/b#z", "a://b://com/fr/", "https://example.org./es/", "https://é.com/fr/ü", "http://İ.org/", "http://x.com/FR/", "https://x.com\n/fr/"]


def by_hand(url, rules, blocked=frozenset()):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = []
    for verdict, rule in rules:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(rule), rule, verdict))
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    return host, path, None, "block" if host + path in blocked else "allow"


def pages(spark, urls=URLS):
    return spark.createDataFrame([(i, u, "mine", "h", 1) for i, u in enumerate(urls)], "page_id long, url string, verdict string, host string, h1 int")


@pytest.mark.parametrize("bits", [U.MOST_BITS, 128])
def test_by_hand(spark, bits):
    """With room for the cascades, and with so little that the block list is joined."""
    blocked = {"x.net/a", "x.net/b", "org", "unknown.net/z"} | {f"n{i}.net/" for i in range(300)}
    listed = spark.createDataFrame([(k,) for k in blocked] * 2, "key string")
    urls = URLS + [f"http://n{i}.net/" for i in range(0, 600, 2)] + URLS
    got = U.judge(pages(spark, urls), U.RULES, listed, most_bits=bits)
    rows = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got.collect()}
    assert rows == {i: by_hand(u, U.RULES, blocked) for i, u in enumerate(urls)}
    assert sorted(got.columns) == sorted(["page_id", "url", "verdict", "host", "h1", "path", "rule"])


def test_no_list_and_empty_table(spark):
    assert {r["page_id"]: r["verdict"] for r in U.judge(pages(spark)).collect()} == {i: by_hand(u, U.RULES)[3] for i, u in enumerate(URLS)}
    none = spark.createDataFrame([], "key string")
    assert U.judge(pages(spark), U.RULES, none).filter("rule is null and verdict = 'block'").count() == 0
    assert U.judge(pages(spark).filter("false"), U.RULES, none).count() == 0


def test_cascade_is_exact(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id")).alias("k"))
    universe = keys.select(*U.hashes(F.col("k"))).distinct()
    listed = keys.filter("k like '%7'").select(*U.hashes(F.col("k")))
    cascade = U.build_cascade(listed, universe)
    rows = keys.select("k", *U.hashes(F.col("k"))).toPandas()
    got = cascade.contains(rows["h1"].to_numpy(), rows["h2"].to_numpy())
    assert np.array_equal(got, rows["k"].str.endswith("7").to_numpy())
    assert len(cascade.levels) > 1  # mistakes there were, and they were mended
    with pytest.raises(U.TooLarge):
        U.build_cascade(listed, universe, most_bits=64)


def test_everything_listed(spark):
    universe = spark.range(100).select(*U.hashes(F.col("id").cast("string")))
    rows = universe.toPandas()
    assert U.build_cascade(universe, universe).contains(rows["h1"].to_numpy(), rows["h2"].to_numpy()).all()
    assert not U.build_cascade(universe.filter("false"), universe).contains(rows["h1"].to_numpy(), rows["h2"].to_numpy()).any()
