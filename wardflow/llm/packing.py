"""Harmonic packing of token sequences.

Lengths fall into reciprocal-capacity classes: class ``k`` holds lengths of at
most ``capacity / k`` (and more than ``capacity / (k + 1)``), and its bins take
exactly ``k`` pieces, so a worker fills the bins of a class without looking at
any other class or worker. As documents may be cut, a document is first cut so
that its pieces fill their class's bins: whole sequences, then its remainder in
powers of two down to ``TAIL``, and a tail below that which stays whole (the class
of a tail is its exact length, bins waste less than a tail).

Each (class, shard) pair is one worker's share; shards grow with the number of
pieces, so a share is bounded. What a share has left over in its last bin is
split by the binary digits of the count: every such sequence is a power of two
long and needs no padding. Left-over tails of all classes fill common bins.

Defined results: a null or empty text is a document of one token (the end id);
repeated rows and null ids are packed as often as they come; an empty table
gives an empty result. Only id and text are read, so other columns can't clash. The id
must be a whole number. A tokenizer that doesn't cut at white space as the usual vocabulary does
encodes whole texts instead of words.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm.bpe import byte_alphabet, load_tokenizer
from wardflow.llm.common import give_back, stage, table, worker_cache

CAPACITY = 4096
TAIL = 64
SHARE = 4096  # pieces of one class that one worker numbers
CACHE_WORDS = 300_000  # bound on the words a task remembers
STEP_WORDS = 200_000  # words looked up at once
STEP_BYTES = 4_000_000  # of whole texts encoded at once

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def cuts(n: int, capacity: int = CAPACITY, tail: int = TAIL) -> list[int]:
    """Lengths of the pieces of a document of ``n`` tokens: full ones, powers of two, a tail."""
    out, size = [capacity] * (n // capacity), capacity // 2
    n %= capacity
    while size >= tail:
        if n >= size:
            out.append(size)
            n -= size
        size //= 2
    return out + [n] * (n > 0)


# Fixed value: how the vocabulary that words are encoded for one by one cuts a text
CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# A word of Latin letters and signs after them, of which the vocabulary makes two pieces of text
PLAIN = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\[-`{-~]*)")


class WordIds:
    """Ids of words as little-endian bytes; the words last seen are remembered up to a bound."""

    def __init__(self, path: str):
        self.path, self.tok = path, load_tokenizer(path)
        self.model = self.tok.model
        self.known: dict[bytes, bytes] = {}
        self.letters: dict[str, bytes] = {}
        self.spell = {b: c for c, b in byte_alphabet().items()}

    def texts(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of each text. White space is a cut for this vocabulary: what lies between is encoded by itself."""
        group: list[list[bytes]] = []
        size = 0
        for text in texts:
            group.append(text.split())
            size += len(group[-1])
            if size >= STEP_WORDS:
                yield from self._ids(group)
                group, size = [], 0
        yield from self._ids(group)

    def _ids(self, group: list[list[bytes]]) -> Iterator[bytes]:
        words = set().union(*group)
        new = words.difference(self.known)
        if len(self.known) + len(new) > CACHE_WORDS:
            self.known = {w: self.known[w] for w in words if w in self.known}
        if len(self.letters) > CACHE_WORDS:
            self.letters.clear()
        other = []
        for w in new:
            text = w.decode()
            if plain := PLAIN.fullmatch(text):
                self.known[w] = self._plain(plain[1].lower()) + (self._plain(plain[2]) if plain[2] else b"")
            else:
                other.append(text)
        for at in range(0, len(other), 10_000):
            some = other[at:at + 10_000]
            found = self.tok.encode_batch_fast(some, add_special_tokens=False)
            self.known.update((w.encode(), np.array(e.ids, "<u4").tobytes()) for w, e in zip(some, found, strict=True))
        for words in group:
            yield b"".join(map(self.known.__getitem__, words))

    def _plain(self, text: str) -> bytes:
        """Ids of lower-case Latin letters, or of signs: nothing is left to the library's steps but its model's."""
        if (found := self.letters.get(text)) is None:
            spelled = text.encode().decode("latin-1").translate(self.spell)
            found = self.letters[text] = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(spelled)])
        return found


class WholeTexts:
    """Ids of whole texts, for any tokenizer."""

    def __init__(self, path: str):
        self.tok = load_tokenizer(path)

    def texts(self, texts: list[bytes]) -> Iterator[bytes]:
        at = 0
        while at < len(texts):
            upto, size = at, 0
            while upto < len(texts) and (upto == at or size + len(texts[upto]) <= STEP_BYTES):
                size += len(texts[upto])
                upto += 1
            for e in self.tok.encode_batch_fast([t.decode() for t in texts[at:upto]], add_special_tokens=False):
                yield np.array(e.ids, "<u4").tobytes()
            at = upto


def cuts_at_white_space(path: str) -> bool:
    """Whether the tokenizer lower-cases and cuts texts as ``WordIds`` takes for granted: then words can be encoded by themselves."""
    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    normal = [x["type"] for x in (made["normalizer"] or {}).get("normalizers", [])]
    cut = (made["pre_tokenizer"] or {}).get("pretokenizers", [])
    return (normal == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in cut] == ["Split", "ByteLevel"] and cut[0]["behavior"] == "Removed"
            and cut[0]["pattern"] == {"Regex": CUT} and not cut[1]["add_prefix_space"] and not cut[1]["use_regex"] and made["model"]["type"] == "BPE"
            and not any(x["normalized"] or x["lstrip"] or x["rstrip"] or " " in x["content"] for x in made["added_tokens"]))


def _encoder(path: str) -> WordIds | WholeTexts:
    """One per Python worker, which serves many tasks."""
    return worker_cache(("packing", path), lambda: (WordIds if cuts_at_white_space(path) else WholeTexts)(path))


def cut_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                  end_id: int = 2, capacity: int = CAPACITY, tail: int = TAIL, with_ids: bool = False) -> DataFrame:
    """The pieces of every document; ``with_ids`` adds their token ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _encoder(tokenizer_path)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for doc, ids in zip(batch.column(0).to_pylist(), words.texts([t or b"" for t in texts]), strict=True):
                ids += end
                at, n = 0, len(ids) // 4
                for size in cuts(n, capacity, tail):
                    body = ids[4 * at:4 * (at + size)]
                    rows.append((doc, at, size, crc32(body), n, *([np.frombuffer(body, "<u4").astype(np.int32)] if with_ids else [])))
                    at += size
                if len(rows) >= 20_000:
                    yield arrow(rows)
                    rows = []
            if rows:
                yield arrow(rows)
        give_back()

    def arrow(rows):
        columns = list(zip(*rows, strict=True))
        arrays = [pa.array(c, pa.int64()) for c in columns[:5]] + [pa.array(c, pa.list_(pa.int32())) for c in columns[5:]]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][:len(arrays)])

    schema = _PIECES + (", ids array<int>" if with_ids else "")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY, tail: int = TAIL, share: int = SHARE) -> DataFrame:
    """``pieces`` (doc_id, start, length, ...; read several times) with ``sequence_id`` and ``offset``.

    Lengths must be those that :func:`cuts` gives: a power of two from ``tail`` to ``capacity``, or below ``tail``.
    """
    counts = pieces.groupBy("length").count().collect()  # at most tail + log2(capacity) rows
    shards = {r["length"]: -(-r["count"] // share) for r in counts}
    if not shards:
        return pieces.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    per_class = F.create_map(*[F.lit(x).cast("long") for kv in shards.items() for x in kv])
    mine = Window.partitionBy("length", "shard")
    base = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "start"), per_class[F.col("length")])) \
        .withColumn("at", F.row_number().over(mine.orderBy("doc_id", "start")).cast("long") - 1) \
        .withColumn("n", F.count(F.lit(1)).over(mine)) \
        .withColumn("k", F.floor(F.lit(capacity) / F.col("length"))) \
        .withColumn("bin", F.floor(F.col("at") / F.col("k"))) \
        .withColumn("rest", F.col("n") % F.col("k")) \
        .withColumn("p", F.col("at") - (F.col("n") - F.col("rest")))  # 0 and on for what no full bin takes

    def sequence(kind: int, length, shard, number):
        return F.lit(kind << 60).bitwiseOR(F.shiftleft(length.cast("long"), 46)).bitwiseOR(F.shiftleft(shard.cast("long"), 22)) \
            .bitwiseOR(number.cast("long"))

    # p < rest: at their highest differing binary digit, rest has 1; that digit's block of places holds p
    digit = F.floor(F.log2(F.col("p").bitwiseXOR(F.col("rest")).cast("double"))).cast("int")
    block = F.expr("shiftleft(shiftright(rest, digit + 1), digit + 1)")
    full = F.col("p") < 0
    placed = base.withColumn("digit", F.when(~full, digit)).withColumn("kind", F.when(full, 0).when(F.col("length") >= tail, 1).otherwise(2))
    exact = placed.filter("kind < 2") \
        .withColumn("offset", F.when(full, F.col("at") % F.col("k")).otherwise(F.col("p") - block) * F.col("length")) \
        .withColumn("sequence_id", F.when(full, sequence(0, F.col("length"), F.col("shard"), F.col("bin")))
                    .otherwise(sequence(1, F.col("length"), F.col("shard"), F.col("digit"))))
    # tails in a row; a bin begins every `width` tokens and its last tail may reach over by less than a tail
    width = capacity - (tail - 2)
    row = Window.partitionBy("shard").orderBy(F.col("length").desc(), "doc_id", "start").rowsBetween(Window.unboundedPreceding, -1)
    mixed = placed.filter("kind = 2").withColumn("from", F.coalesce(F.sum("length").over(row), F.lit(0))) \
        .withColumn("bin", F.floor(F.col("from") / width)) \
        .withColumn("offset", F.col("from") - F.min("from").over(Window.partitionBy("shard", "bin"))) \
        .withColumn("sequence_id", sequence(2, F.lit(0), F.col("shard"), F.col("bin")))
    out = [*pieces.columns, "sequence_id", "offset"]
    return exact.select(out).unionByName(mixed.select(out))


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """Every document cut, and every piece placed; the pieces are kept in the shared folder between the two."""
    return pack(stage(cut_documents(docs, tokenizer_path, id_col, text_col, **how), "pieces"))


def op5_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
