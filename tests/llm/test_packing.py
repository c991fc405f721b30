from zlib import crc32

import numpy as np
import public_tokenizers
import pytest

from wardflow.llm import packing
from wardflow.llm.bpe import load_tokenizer

from .conftest import prose

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, docs, capacity=packing.CAPACITY):
    """Every id lies in one piece, sequences are gapless and within capacity; returns padding by tokens."""
    tok = load_tokenizer(PATH)
    ids = {i: np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4") for i, t in docs}
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(pieces) == set(ids)
    for i, mine in pieces.items():
        at = 0
        for r in sorted(mine, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids[i]) and 0 < r["length"] <= capacity
            assert r["ids_crc32"] == crc32(ids[i][at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids[i])
    padding = total = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
        total += at
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding / total


def test_cuts():
    for n in [1, 2, 63, 64, 65, 4095, 4096, 4097, 10_000]:
        got = packing.cuts(n)
        assert sum(got) == n and all(x == 4096 or x < 64 or x & (x - 1) == 0 for x in got) and sum(x < 64 for x in got) <= 1


def test_small_corpus(make_docs, odd_texts):
    docs = [(i, t) for i, t in enumerate(odd_texts)] + [(100 + i, prose(i, 5 + 37 * i % 900, ("en", "fr", "de")[i % 3])) for i in range(150)]
    out = packing.pack_documents(make_docs([(i, t, None) for i, t in docs]).repartition(3), PATH).collect()
    assert check(out, docs) < 0.05


def test_shares_and_leftovers(make_docs):
    docs = [(i, prose(i, 1 + i * 7 % 120)) for i in range(300)]
    pieces = packing.cut_documents(make_docs([(i, t, None) for i, t in docs]), PATH).cache()
    rows = packing.pack(pieces, share=16).collect()
    check(rows, docs)
    assert len(rows) == pieces.count()


def test_repeated_rows_null_ids_and_empty_table(make_docs):
    rows = [(1, "one two", None), (1, "one two", None), (None, "three", None)]
    out = packing.pack_documents(make_docs(rows), PATH).collect()
    assert sorted((r["doc_id"] or -1, r["start"], r["length"]) for r in out) == [(-1, 0, 2), (1, 0, 3), (1, 0, 3)]
    assert len({(r["sequence_id"], r["offset"]) for r in out}) == 3
    empty = packing.pack_documents(make_docs(rows).filter("false"), PATH)
    assert empty.count() == 0 and "sequence_id" in empty.columns


def test_with_ids(make_docs):
    out = packing.pack_documents(make_docs([(1, prose(1, 2000), None)]), PATH, with_ids=True).orderBy("start").collect()
    tok = load_tokenizer(PATH)
    assert [i for r in out for i in r["ids"]] == tok.encode(prose(1, 2000), add_special_tokens=False).ids + [2]


@pytest.mark.parametrize("text", ["A'b don't DON'T l'été ÀÉß½² x²y áb ΣΑΣ", "<|endoftext|> foo<|endoftext|>bar <|startoftext|>! abc<| ~~a !!!",
                                  "ÿŸ İI ａｂ 1234 a1b2 \x00 \x1c!\x1c! a b a ! !? ñ̃ 한글", "µ ª º × ÷ «x» naïve-co-op's é ́a", "\x0b\x0c\r z"])
def test_word_ids_equal_the_library(text):
    got = next(iter(packing.WordIds(PATH).texts([text.encode()])))
    assert np.frombuffer(got, "<u4").tolist() == load_tokenizer(PATH).encode(text, add_special_tokens=False).ids


def test_cache_bound(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 20)
    monkeypatch.setattr(packing, "STEP_WORDS", 15)
    texts = [prose(i, 12) for i in range(20)] * 2
    words, tok = packing.WordIds(PATH), load_tokenizer(PATH)
    assert [np.frombuffer(x, "<u4").tolist() for x in words.texts([t.encode() for t in texts])] == \
        [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_any_tokenizer(spark, make_docs, odd_texts):
    """One that neither lower-cases nor cuts at white space encodes whole texts, as the library does."""
    import public_tokenizers

    from wardflow.llm.bpe import load_tokenizer

    for name, words in (("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)):
        path = public_tokenizers.path(name)
        assert packing.cuts_at_white_space(path) == words
        rows = list(enumerate([*odd_texts, "Hello world, Again", "a  b\n\nC"]))
        got = {}
        for r in packing.cut_documents(make_docs([(i, t, None) for i, t in rows]), path, with_ids=True).collect():
            got.setdefault(r["doc_id"], []).append((r["start"], r["ids"]))
        tok = load_tokenizer(path)
        for i, t in rows:
            assert [x for _, ids in sorted(got[i]) for x in ids] == [*tok.encode(t or "", add_special_tokens=False).ids, 2]
