"""License notices in texts: MinHash bands over text windows, then exact shingle containment.

DataFrame functions only. Words are runs of letters and digits in lower case,
shingles five words. For each length of template, windows of that many words
begin at every ``stride``-th word of a text (an eighth of the template's shingles, so
some window nearly lines up with any notice). A window signs with the least hash of
its shingles in each of ``BANDS`` hash functions, one row a band, and meets the
templates that have the same sign. As that takes the very shingle that gives the
template its sign, only windows around such shingles are signed. A notice that keeps
0.8 of its template's shingles has a similarity of at least 0.55 with some window,
and is retrieved with a probability of 1 - 0.45 ** BANDS, all but a few in a million
(an unchanged notice that lines up always). Retrieved windows, widened by a stride at both ends, are
compared with the template: the share of its shingles that they hold must reach
``CONTAINED``.

Each template has anchors, long words that occur in more of its shingles than a match
may lack. A text without any anchor can't match and is passed over before windows
are cut, which loses nothing.

Defined results: null, empty and short texts have no match; of several matches of one
template in a text there is one row with their number, the best containment and the
first word (from 0); repeated rows count together; a null id is an id like others. Only id and
text are read, so other columns can't clash. Whole texts are read.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import table

N = 5
BANDS = 16
CONTAINED = 0.8

# Fixed texts: common license notices
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "BSD-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "GPL-text": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                "the Free Software Foundation",
    "MPL-2.0-text": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Apache-text": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
}


def words_of(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def anchors(templates: dict[str, str], n: int = N, contained: float = CONTAINED) -> list[str]:
    """Words such that a text that holds enough of a template's shingles holds one of them.

    The shingles of a template that have no anchor must be fewer than a match needs; long words are taken first.
    """
    out: list[str] = []
    for words in map(words_of, templates.values()):
        every = {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}
        open_ = {s for s in every if set(s).isdisjoint(out)}
        while open_ and len(open_) >= contained * len(every):
            best = max({w for s in open_ for w in s}, key=lambda w: (len(w), w))
            out.append(best)
            open_ = {s for s in open_ if best not in s}
    return out


def _word_array(text):
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _shingles(words: str, n: int):
    """Hashes of the word n-grams at each place of an array column."""
    w = F.col(words)
    shifted = F.arrays_zip(*[F.slice(w, j + 1, F.size(w) - (n - 1)).alias(f"w{j}") for j in range(n)])
    hashed = F.transform(shifted, lambda z: F.xxhash64(*[z[f"w{j}"] for j in range(n)]))
    return F.when(F.size(w) >= n, hashed).otherwise(F.array().cast("array<bigint>"))


def _computed(rows: DataFrame, keep: list[str], **columns) -> DataFrame:
    """``keep`` and ``columns`` as a row of their own: what follows refers to the values and doesn't repeat the expressions."""
    return rows.select(*keep, F.inline(F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))))


def template_table(spark, templates: dict[str, str], n: int = N) -> DataFrame:
    """(license, width in shingles, stride, shingles) of each template with at least ``n`` words."""
    rows = spark.createDataFrame([(k, words_of(t)) for k, t in templates.items()], "license string, w array<string>")
    rows = rows.withColumn("s", _shingles("w", n)).filter(F.size("s") > 0)
    return rows.select("license", F.size("s").alias("width"), F.greatest(F.lit(1), F.floor(F.size("s") / 8).cast("int")).alias("stride"),
                       F.array_distinct("s").alias("template"))


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text", n: int = N,
         bands: int = BANDS, contained: float = CONTAINED) -> DataFrame:
    """(id, license, n_windows, containment, first_word)"""
    spark = docs.sparkSession
    known = template_table(spark, templates, n)
    # one row for each template and band: the band's sign, and the shingle that has it
    by_band = [F.array_min(F.transform("template", _signed(j))) for j in range(bands)]
    signs = known.select("*", F.posexplode(F.array(*by_band)).alias("band", "least")) \
        .select("license", "width", "stride", "template", "band", F.col("least.h").alias("sign"), F.col("least.x").alias("x"))
    wanted = F.array(*[F.lit(r["x"]) for r in signs.select("x").distinct().collect()])  # at most templates x bands
    widths = [len(words_of(t)) - n + 1 for t in templates.values()]
    reach = max(widths) + 2 * max(1, max(widths) // 8)
    text = F.col(text_col).cast("string")
    may = F.lower(text).rlike("|".join(re.escape(a) for a in anchors(templates, n, contained)))
    rows = _computed(docs.select(F.col(id_col).alias("id"), text.alias("text")).filter(may), ["id"], w=_word_array(F.col("text")))
    rows = _computed(rows, ["id"], s=_shingles("w", n)).filter(F.size("s") > 0)
    # a window's sign in a band is a template's only if the window holds the shingle that has that sign
    places = F.filter(F.transform("s", lambda x, i: F.struct(x.alias("x"), (i + 1).alias("p"))), lambda z: F.array_contains(wanted, z["x"]))
    hits = rows.select("id", "s", F.inline(places)) \
        .select("id", "p", "x", F.size("s").alias("n"), F.greatest(F.lit(1), F.col("p") - reach).alias("base"),
                F.slice("s", F.greatest(F.lit(1), F.col("p") - reach), F.lit(2 * reach + 1)).alias("near"))
    first = F.greatest(F.lit(0), F.ceil((F.col("p") - F.col("width")) / F.col("stride")).cast("int"))
    last = F.least(F.floor((F.col("p") - 1) / F.col("stride")),
                   F.floor(F.greatest(F.lit(0), F.col("n") - F.col("width")) / F.col("stride"))).cast("int")
    windows = hits.join(F.broadcast(signs), "x") \
        .withColumns({"first": first, "last": last}).filter("first <= last") \
        .withColumn("k", F.explode(F.sequence("first", "last"))).withColumn("start", F.col("k") * F.col("stride") + 1)
    window = F.slice("near", F.col("start") - F.col("base") + 1, F.col("width"))
    met = windows.filter(F.array_min(F.transform(window, lambda x: F.xxhash64(x, F.col("band")))) == F.col("sign"))
    left = F.greatest(F.lit(1), F.col("start") - F.col("stride"))
    wide = F.slice("near", left - F.col("base") + 1, F.col("width") + 2 * F.col("stride"))
    checked = met.withColumn("containment", F.size(F.array_intersect("template", wide)) / F.size("template")) \
        .filter(F.col("containment") >= contained)
    return checked.groupBy("id", "license").agg(
        F.countDistinct("start").alias("n_windows"), F.max("containment").alias("containment"), (F.min("start") - 1).alias("first_word"))


def _signed(band: int):
    """A shingle with its hash in a band; the least of them by hash is the band's sign."""
    return lambda x: F.struct(F.xxhash64(x, F.lit(band)).alias("h"), x.alias("x"))


def op7_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
