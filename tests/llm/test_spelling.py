import random
import re
from collections import Counter
from zlib import crc32

import numpy as np

from tests.llm.conftest import prose
from wardflow.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def plain_counts(rows, typo=97):
    out = Counter()
    for i, text, *_ in rows:
        for run in RUN.findall(text or ""):
            run = lower(run)
            h = crc32(f"{'' if i is None else i}:{run}".encode())
            if h % typo == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_groups(counts):
    form = {}
    near = {w: [v for v in counts if one_apart(w, v)] for w in counts}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return out


def rows_of(df):
    return [tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()]


def check(df, counts):
    got = rows_of(df)
    assert len(got) == len(set(got)) == len(counts)
    assert set(got) == plain_groups(counts)


def test_equals_brute_force(spark, make_docs, odd_texts):
    rng = random.Random(4)
    rows = [(i, prose(i % 50, 60, ("en", "fr", "de")[i % 3]), "en") for i in range(120)]
    base = ["leuchten", "Ébène", "aaaaaaa", "aaaaaaaa", "aaaaaa", "xyzzyxyzzy", "É" * 6, "É" * 7, "w" * 60, "w" * 61, "w" * 30 + "v" + "w" * 29]
    noisy = []
    for w in base:
        for _ in range(40):
            v = w
            if rng.random() < 0.4:
                p = rng.randrange(len(w))
                v = w[:p] + rng.choice(["", "q", "ß"]) + w[p + 1:]
            noisy.append(v)
    rng.shuffle(noisy)
    rows += [(500, " ".join(noisy), None), (500, " ".join(noisy[:200]), None), (None, "THE·leuchten×leuchten÷ébène 12leuchten", None)]
    rows += [(600 + i, t, None) for i, t in enumerate(odd_texts)]
    docs = make_docs(rows).repartition(5)
    counts = plain_counts(rows)
    assert {r["word"]: r["n"] for r in spelling.count_words(docs, typo=97).collect()} == counts
    check(spelling.group_variants(spelling.count_words(docs, typo=97), buckets=7), counts)


def test_chain_of_forms(spark):
    """Each word is one letter from the next, which is twice as frequent: the root is the last."""
    words = ["abcdefghij"[:i] + "z" * (10 - i) for i in range(11)]
    counts = {w: 3 * 2**i for i, w in enumerate(words)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    check(spelling.group_variants(df), counts)
    assert {r["root"] for r in spelling.group_variants(df).collect()} == {words[-1]}


def test_many_words_with_one_signature(spark):
    """Anagrams have equal letters, so all signatures agree; only those one code point apart come out."""
    rng = random.Random(1)
    words = {"".join(rng.sample("abcdefg", 7)) for _ in range(400)} | {"".join(rng.choices("ab", k=9)) for _ in range(300)}
    counts = {w: rng.randint(3, 40) for w in words}
    check(spelling.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long"), buckets=4), counts)


def test_near_words_share_a_signature():
    rng = random.Random(2)
    for _ in range(300):
        w = "".join(rng.choices("abcdeé", k=rng.randint(5, 12)))
        p = rng.randrange(len(w))
        v = w[:p] + rng.choice(["", "x", "aa"]) + w[p + rng.randint(0, 1):]
        if w != v and one_apart(w, v):
            a, b = spelling.signatures(spelling.Letters([w, v]).groups())
            assert np.any(a == b)


def test_query_and_empty_tables(spark, make_docs):
    assert rows_of(spelling.group_variants(spelling.count_words(make_docs([]), typo=97))) == []
    assert rows_of(spelling.group_variants(spelling.count_words(make_docs([(1, None, None), (2, "", None)])))) == []
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    counts = plain_counts([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    got = {r[0]: r[3] for r in rows_of(spelling.op13_spelling(spark, "/root/testdata/sf0.001"))}
    assert got == counts
