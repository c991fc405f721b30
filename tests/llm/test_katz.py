import math
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest

from tests.llm.conftest import prose
from wardflow.llm import katz

WORD = re.compile("[^\x20\x09-\x0d]+")
TOP = 5


def tokens_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*WORD.findall(low), None]  # None: the end


def factors(n):
    rest = (TOP + 1) * n[TOP] / n[0] if n[0] else 1.0
    out = {}
    for r in range(1, TOP + 1):
        d = ((r + 1) * n[r] / (r * n[r - 1]) - rest) / (1 - rest) if n[r - 1] and rest < 1 else 0
        out[r] = d if 0 < d < 1 else (r - 0.5) / r
    return out


class Plain:
    """Katz back-off by dictionaries, straight from the definition."""

    def __init__(self, texts, order):
        self.order = order
        self.after = [defaultdict(Counter) for _ in range(order)]
        for t in texts:
            seq = ["<begin>", *tokens_of(t)]
            for i in range(1, len(seq)):
                for k in range(1, order + 1):
                    if i >= k - 1:
                        self.after[k - 1][tuple(seq[i - k + 1:i])][seq[i]] += 1
        self.d = []
        for level in self.after:
            r = Counter(c for words in level.values() for c in words.values())
            self.d.append(factors([r[i] for i in range(1, TOP + 2)]))
        self.words = set(self.after[0][()])
        self.known = {}

    def p(self, word, ctx):
        if word not in self.words:
            word = "<unknown>"
        return self.prob(word, tuple(ctx))

    def figures(self, ctx):
        """(occurrences, those given up, sum of the seen words' probabilities one level down)."""
        if ctx not in self.known:
            seen = self.after[len(ctx)][ctx]
            d = self.d[len(ctx)]
            total, lost = sum(seen.values()), sum((1 - d[c]) * c for c in seen.values() if c <= TOP)
            if not lost:
                total, lost = total + 1, 1.0
            self.known[ctx] = total, lost, sum(self.prob(w, ctx[1:]) for w in seen) if ctx else None
        return self.known[ctx]

    def prob(self, word, ctx):
        seen = self.after[len(ctx)].get(ctx)
        lower = (lambda w: self.prob(w, ctx[1:])) if ctx else None
        if not seen:
            return lower(word) if ctx else 1.0
        d = self.d[len(ctx)]
        total, lost, below = self.figures(ctx)
        if word in seen:
            return d.get(seen[word], 1.0) * seen[word] / total
        if not ctx:
            return lost / total  # the one class of unknown words
        return lost / total / (1 - below) * lower(word)

    def score(self, text):
        seq = ["<begin>", *tokens_of(text)]
        return sum(math.log10(self.p(seq[i], seq[max(0, i - self.order + 1):i])) for i in range(1, len(seq)))


def held(i):
    return crc32(b"" if i is None else str(i).encode()) % 10 == 0


def corpus():
    rows = [(i, prose(i % 37, 5 + i % 60, ("en", "fr", "de")[i % 3]) if i % 5 else "the the the sh sh on", "en") for i in range(150)]
    return rows


def odd(odd_texts):
    return [(1000 + i, t, None) for i, t in enumerate(odd_texts)] + [(None, "no id", None), (7, "again the SHer", None), (7, "again the SHer", None), (None, None, None)]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_equals_plain_katz(spark, make_docs, odd_texts, order):
    rows = corpus() + odd(odd_texts)
    got = katz.katz_scores(make_docs(rows).repartition(5), order=order).collect()
    plain = Plain([t for i, t, _ in rows if not held(i)], order)
    uni = plain.after[0][()]
    total, known = sum(uni.values()), len(uni)
    want = sorted(((str(i), held(i), len(tokens_of(t)), sum(w in uni for w in tokens_of(t)), total,
                    round(sum(math.log10((uni[w] + 0.1) / (total + 0.1 * (known + 1))) for w in tokens_of(t)), 6), round(plain.score(t), 6)) for i, t, _ in rows), key=str)
    have = sorted(((str(r["id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6)) for r in got), key=str)
    assert len(have) == len(want)
    for a, b in zip(have, want, strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], abs=2e-6, rel=1e-9)


def test_contexts_add_up_to_one():
    plain = Plain([t for i, t, _ in corpus() if not held(i)], 3)
    for ctx in [(), *list(plain.after[1])[:20], *list(plain.after[2])[:20]]:
        assert sum(plain.prob(w, ctx) for w in [*plain.words, "<unknown>"]) == pytest.approx(1.0, abs=1e-9)


def test_one_hot_context_is_split(spark, make_docs):
    """A word that is a third of all tokens: its n-grams lie in several buckets, with the same scores."""
    rows = [(i, " ".join(f"so w{(i * 7 + j * j) % 400} x{j % 3}" for j in range(40)), "en") for i in range(120)]
    got = {r["id"]: r["score"] for r in katz.katz_scores(make_docs(rows).repartition(12)).collect()}
    plain = Plain([t for i, t, _ in rows if not held(i)], 2)
    assert len(got) == len(rows)
    for i, t, _ in rows[::9]:
        assert got[i] == pytest.approx(plain.score(t), rel=1e-9)


def test_empty_table_and_nothing_to_learn_from(spark, make_docs):
    from pyspark.sql import functions as F

    assert katz.katz_scores(make_docs([])).count() == 0
    for order in (1, 2):
        got = katz.katz_scores(make_docs([(1, "a b", None), (2, None, None)]), held=F.lit(True), order=order).orderBy("id").collect()
        assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got] == [(3, 0, 0, 0, 0), (1, 0, 0, 0, 0)]


def test_learning_helps(spark):
    from wardflow.llm.common import table

    got = katz.op12_katz(spark, "/root/testdata/sf0.01")
    assert got.count() == table(spark, "/root/testdata/sf0.01", "documents").count()
    r = got.filter("held_out").selectExpr("sum(score) / sum(n_tokens) AS own", "sum(base_score) / sum(n_tokens) AS base").first()
    assert r["own"] > r["base"]


def test_discounts_are_factors():
    for n in ([0] * 6, [5, 0, 0, 0, 0, 0], [100, 40, 20, 12, 8, 5], [1, 9, 9, 9, 9, 9]):
        d = katz.discounts(n)
        assert d[0] == 1 and np.all((d[1:] > 0) & (d[1:] < 1))


def test_buckets_follow_the_text_not_the_partitions(spark, make_docs, monkeypatch):
    """One large partition: its n-grams are dealt to as many buckets as its text asks for, with the same scores."""
    asked, whole = [], katz.count_grams
    monkeypatch.setattr(katz, "count_grams", lambda messages, buckets, numbered: asked.append(buckets) or whole(messages, buckets, numbered))
    rows = corpus()
    size = sum(len(t.encode()) for _, t, _ in rows)
    monkeypatch.setattr(katz, "BUCKET_BYTES", size // 6)
    got = {r["id"]: r["score"] for r in katz.katz_scores(make_docs(rows).coalesce(1)).collect()}
    assert asked == [-(-size // (size // 6))]
    plain = Plain([t for i, t, _ in rows if not held(i)], 2)
    assert len(got) == len(rows)
    for i, t, _ in rows[::9]:
        assert got[i] == pytest.approx(plain.score(t), rel=1e-9)


def test_wide_word_numbers_keep_their_order():
    for most in (katz.LAST - 1, katz.LAST, 1 << 40):
        word = np.array([most, katz.UNKNOWN, 3, most, 0, katz.UNKNOWN])
        got = katz._in_32_bits(word)
        assert got.max() <= katz.LAST
        assert np.array_equal(np.argsort(got, kind="stable"), np.argsort(word, kind="stable"))
        assert [len(set(got[word == w])) for w in np.unique(word)] == [1] * 4
