import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, id string"


def prose(seed: int, words: int, vocab: str = "en") -> str:
    """Invented sentences; each vocabulary has letters and endings of its own."""
    rng = random.Random(f"{vocab}{seed}")
    parts = {"en": ["the", "ing", "ly", "tion", "sh", "er", "on"], "fr": ["eau", "elle", "é", "ment", "oi", "que", "aux"],
             "de": ["sch", "ung", "keit", "ü", "ein", "ver", "ß"]}[vocab]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with columns whose names operators use themselves."""
    def make(rows):
        return spark.createDataFrame([(i, t, la, "src", len(t or ""), 0.5, True, "x") for i, t, la in rows], DOCS)
    return make


@pytest.fixture(scope="session")
def odd_texts():
    return [None, "", "   \n\t ", "a", "word", "é ñ ß 中文 \U0001f600 ok", "x " * 50_000, "\x00 nul \x1c!\x1c! \xa0  b  c", "a" * 20_000]
