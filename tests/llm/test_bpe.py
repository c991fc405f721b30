import public_tokenizers
import pytest

from wardflow.llm import bpe

from .conftest import prose

PATH = public_tokenizers.path("byte_bpe_50k.json")

SPACES = ["a  b", "a \n b", "x\n  b", " \n\n y", "a\xa0  b", "a\xa0 b  ", "\t\tz", "end  ", "a  b", "!\x1c! \x1c", "\x85x \x85", "it's  they'LL",
          "<|endoftext|>  a<|endoftext|> b  <|endoftext|>", "1 23  456", "ﬁ ½ ²"]


@pytest.fixture(scope="module")
def tok():
    return bpe.load_tokenizer(PATH)


def expected(tok, text):
    ids = tok.encode(text or "", add_special_tokens=False).ids
    return ids, tok.decode(ids, skip_special_tokens=False)


def test_equals_the_library(make_docs, odd_texts, tok, monkeypatch):
    texts = odd_texts + SPACES + [prose(i, 300, v) for i, v in enumerate(("en", "fr", "de"))]
    rows = [(i, t, None) for i, t in enumerate(texts)] + [(None, "null id", None), (1000, "twice", None), (1000, "twice", None)]
    docs = make_docs(rows).repartition(3)
    out = bpe.encode_documents(docs.select("doc_id", "text", "source"), PATH, buckets=4).collect()
    assert len(out) == len(rows)
    by_id = {i: t for i, t, _ in rows}
    for r in out:
        assert (list(r["ids"]), r["decoded"]) == expected(tok, by_id[r["id"]]), repr(by_id[r["id"]])[:60]


def test_cuts_are_hard(tok):
    """Words encoded one by one give the text's ids, for any mix of white space and signs."""
    import random
    import re

    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice([" ", "  ", "\n", "\t", "\xa0", " ", "a", "Bc", "é", "1", "!", "'s", "\x1c", "中"]) for _ in range(rng.randint(1, 25)))
        words = re.findall(bpe.WORD, text)
        assert "".join(words) == text
        assert [i for w in words for i in tok.encode(w, add_special_tokens=False).ids] == tok.encode(text, add_special_tokens=False).ids, repr(text)


def test_small_chunks(make_docs, tok, monkeypatch):
    docs = make_docs([(i, prose(i % 7, 50), None) for i in range(40)]).coalesce(1)
    old = bpe.CHUNK_CHARS
    try:
        bpe.CHUNK_CHARS = 1000
        got = {r["id"]: list(r["ids"]) for r in bpe.encode_documents(docs, PATH, buckets=3).collect()}
    finally:
        bpe.CHUNK_CHARS = old
    assert all(got[i] == expected(tok, prose(i % 7, 50))[0] for i in range(40))


def test_empty_table_and_only_empty_texts(make_docs):
    docs = make_docs([(1, None, None), (2, "", None)])
    assert [(r["id"], list(r["ids"]), r["decoded"]) for r in bpe.encode_documents(docs, PATH).orderBy("id").collect()] == [(1, [], ""), (2, [], "")]
    assert bpe.encode_documents(docs.filter("false"), PATH).count() == 0


def test_decode_any_ids(spark, tok):
    rows = [(1, [31373, 995, 50256]), (2, []), (3, None), (4, [11737, 447, 999999])]
    got = {r["id"]: r["decoded"] for r in bpe.decode_ids(spark.createDataFrame(rows, "id long, ids array<int>"), PATH).collect()}
    assert got[1] == tok.decode([31373, 995, 50256], skip_special_tokens=False) and got[2] == got[3] == ""
    assert got[4] == tok.decode([11737, 447], skip_special_tokens=False)
