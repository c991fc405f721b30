"""BPE encoding and decoding through a table of distinct words.

Every text is cut into words (white space before a word belongs to it, and no
token crosses such a cut); a chunk of documents has its distinct words once and
its texts as places in that list.

1. ``split``, first reading: the chunks' word lists are dealt out by a hash of the
   word, and each bucket encodes each distinct word once with the tokenizers library.
2. ``split``, second reading: the chunks' places meet the encoded words by chunk. A
   text's ids are those of its words by position; for the decoded text the chunk's
   words' ids are joined to the pieces of the vocabulary, and put together likewise.

What is shuffled are word lists, ids and places as compressed Arrow buffers, about
as much as the text's entropy, never one row per token. Reading twice is cheaper
than keeping the chunks on disk. A chunk's key holds a hash of its texts, so an
input that changes between the readings fails instead of giving wrong ids. Only
the pieces are sent to all tasks, whose size the tokenizer's file fixes.

Defined results: a null text is the empty text (no ids, empty decoded text);
repeated rows and null ids come back as often as they came; special tokens
written out in a text become their ids, as the library does by default. A chunk
closes at ``CHUNK_CHARS`` characters or at the end of its partition; one text is
never cut, so a longer text makes a chunk of its own. Columns other than id and text
aren't carried.
"""

from __future__ import annotations

import os
from collections import defaultdict, deque
from collections.abc import Iterator
from itertools import count
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import table

CHUNK_CHARS = 24_000_000
ENCODE_STEP = 20_000  # words handed to the tokenizer at once

# Unicode's White_Space, which the tokenizer's pattern splits at
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORD = f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+"

_ROW = "chunk long, bucket int, body binary"


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable Latin-1 stands for itself, the rest follows from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in set(plain))
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def pieces(tokenizer) -> list[bytes]:
    """The id-to-piece table: what each id adds to the decoded bytes."""
    to_byte = byte_alphabet()
    special = set(tokenizer.get_added_tokens_decoder())
    out = []
    for i in range(tokenizer.get_vocab_size(with_added_tokens=True)):
        piece = tokenizer.id_to_token(i) or ""
        plain = i in special or any(c not in to_byte for c in piece)
        out.append(piece.encode() if plain else bytes(to_byte[c] for c in piece))
    return out


def _pack(**columns: pa.Array) -> bytes:
    batch = pa.RecordBatch.from_pydict(columns)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack(body) -> pa.RecordBatch:
    return pa.ipc.open_stream(body).read_next_batch()


def _rows(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    chunk, bucket, body = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(chunk, pa.int64()), pa.array(bucket, pa.int32()), pa.array(body, pa.binary())], ["chunk", "bucket", "body"])


def _planes(codes: np.ndarray) -> bytes:
    """32-bit numbers as four runs of bytes, the high ones mostly zero: these compress well."""
    return codes.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _codes(planes: bytes) -> np.ndarray:
    return np.frombuffer(planes, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


def split_words(docs: DataFrame, buckets: int, words: bool) -> DataFrame:
    """Of each chunk, either its distinct words by bucket or (bucket -1) its documents as places in their list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        from xxhash import xxh64

        words_of = re.compile(WORD).findall
        number = count(TaskContext.get().partitionId() << 32)
        content = xxh64()

        def close() -> pa.RecordBatch:
            content.update(str(next(number)))
            chunk = content.intdigest() - (1 << 63)
            # in the order in which the words come, the places of frequent words are small
            share = np.fromiter((crc32(w.encode("utf-8", "surrogatepass")) for w in place), np.int64, len(place)) % buckets
            if not words:
                return _rows([(chunk, -1, _pack(
                    ids=pa.array([ids], pa.list_(pa.int64())), lens=pa.array([lens], pa.list_(pa.int64())),
                    codes=pa.array([_planes(np.concatenate([*texts, np.zeros(0, np.int32)]))], pa.binary()),
                    share=pa.array([share], pa.list_(pa.int32()))))])
            order = np.argsort(share, kind="stable")
            cuts = np.searchsorted(share[order], np.arange(buckets + 1))
            known = pa.array(place.keys(), pa.string())
            return _rows([(chunk, b, _pack(word=known.take(pa.array(order[cuts[b]:cuts[b + 1]]))))
                          for b in range(buckets) if cuts[b] < cuts[b + 1]] or [(chunk, 0, _pack(word=pa.array([], pa.string())))])

        ids, lens, texts, size = [], [], [], 0
        place: dict[str, int] = defaultdict(count().__next__)
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py() or ""
                found = words_of(text)
                ids.append(i)
                lens.append(len(found))
                at = map(place.__getitem__, found)
                if words:
                    deque(at, 0)
                else:
                    texts.append(np.fromiter(at, np.int32, len(found)))
                content.update(text.encode("utf-8", "surrogatepass"))
                size += len(text)
                if size >= CHUNK_CHARS:
                    yield close()
                    ids, lens, texts, size = [], [], [], 0
                    place = defaultdict(count().__next__)
                    content = xxh64()
        if ids:
            yield close()

    return docs.mapInArrow(run, _ROW)


def encode_words(chunks: DataFrame, tokenizer_path: str, width=np.int32) -> DataFrame:
    """Each bucket's distinct words, encoded once; their ids go back to the chunks in the order of the chunks' lists."""

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = load_tokenizer(tokenizer_path)
        place: dict[str, int] = defaultdict(count().__next__)
        lists = []
        for batch in batches:
            for chunk, body in zip(batch.column("chunk").to_pylist(), batch.column("body"), strict=True):
                words = _unpack(body.as_buffer()).column("word").to_pylist()
                lists.append((chunk, np.fromiter(map(place.__getitem__, words), np.int64, len(words))))
        words = list(place)
        place.clear()
        ids = []
        for at in range(0, len(words), ENCODE_STEP):
            ids.extend(np.array(e.ids, width) for e in tok.encode_batch_fast(words[at:at + ENCODE_STEP], add_special_tokens=False))
        ids = pa.ListArray.from_arrays(np.r_[0, np.cumsum([len(x) for x in ids])].astype(np.int32), pa.array(np.concatenate([*ids, np.zeros(0, width)])))
        for chunk, which in lists:
            mine = ids.take(pa.array(which))
            lens = np.diff(mine.offsets.to_numpy()).astype(np.int32)
            yield _rows([(chunk, key[0].as_py(), _pack(lens=pa.array([_planes(lens)], pa.binary()), ids=pa.array([mine.flatten()], pa.list_(mine.type.value_type))))])

    return chunks.groupBy("bucket").applyInArrow(run, _ROW)


def join_back(places: DataFrame, encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """(id, ids, decoded) of each document, by position in its chunk's word list."""

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = pieces(load_tokenizer(tokenizer_path))
        docs, parts = None, {}
        for batch in batches:
            for bucket, body in zip(batch.column("bucket").to_pylist(), batch.column("body"), strict=True):
                if bucket < 0:
                    docs = _unpack(body.as_buffer())
                else:
                    parts[bucket] = _unpack(body.as_buffer())
        if docs is None or not parts:
            raise ValueError("the documents changed between two readings")
        share = docs.column("share").flatten().to_numpy()
        size = np.zeros(len(share), np.int64)
        flat, lists = [], []
        for b, part in parts.items():
            mine = np.flatnonzero(share == b)
            lens = _codes(part.column("lens")[0].as_py())
            if len(lens) != len(mine):
                raise ValueError("the documents changed between two readings")
            lists.append(mine)
            size[mine] = lens
            flat.append(part.column("ids").flatten().to_numpy())
        order = np.concatenate(lists)  # of the words, as their ids lie in a row
        flat = np.concatenate(flat)
        starts = np.zeros(len(share), np.int64)
        starts[order] = np.r_[0, np.cumsum(size[order])[:-1]] if len(order) else 0
        spelled = [b"".join([piece[i] for i in flat[a:a + n]]) for a, n in zip(starts.tolist(), size.tolist(), strict=True)]
        doc_ids, lens = docs.column("ids").flatten(), docs.column("lens").flatten().to_numpy()
        codes = _codes(docs.column("codes")[0].as_py())
        ends = np.cumsum(lens)
        at = 0
        while at < len(lens):
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 500_000, "right")))  # about so many words a batch
            out_ids, texts = [], []
            for d in range(at, upto):
                mine = codes[ends[d] - lens[d]:ends[d]].astype(np.int64)
                n = size[mine]
                step = np.repeat(starts[mine] - np.r_[0, np.cumsum(n)[:-1]], n) if len(mine) else np.zeros(0, np.int64)
                out_ids.append(flat[step + np.arange(int(n.sum()))])
                texts.append(b"".join([spelled[i] for i in mine.tolist()]).decode("utf-8", "replace"))
            offsets = np.r_[0, np.cumsum([len(x) for x in out_ids])].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [doc_ids.slice(at, upto - at), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(out_ids).astype(np.int32))),
                 pa.array(texts, pa.string())], ["id", "ids", "decoded"])
            at = upto

    # both sides are grouped by chunk in one shuffle
    return places.unionByName(encoded).groupBy("chunk").applyInArrow(run, "id long, ids array<int>, decoded string")


def encode_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                     buckets: int | None = None) -> DataFrame:
    """(id, ids array<int>, decoded string) of every row of ``docs``, which is read twice and must stay the same.

    ``buckets``: into how many parts the words are dealt, by default as many as the scan has partitions, so that
    a bucket stays as large as a chunk's list.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    buckets = buckets or max(1, rows.rdd.getNumPartitions())
    size = load_tokenizer(tokenizer_path).get_vocab_size(with_added_tokens=True)
    encoded = encode_words(split_words(rows, buckets, words=True), tokenizer_path, np.uint16 if size <= 1 << 16 else np.int32)
    return join_back(split_words(rows, buckets, words=False), encoded, tokenizer_path)


def decode_ids(rows: DataFrame, tokenizer_path: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded) for any ids: one row per id, joined to its piece, put together by position.

    The pieces are the vocabulary, whose size the file fixes, so that side is broadcast. ``id`` must name a row.
    Null ids arrays and empty ones give the empty text; unknown ids add nothing.
    """
    spark = rows.sparkSession
    known = spark.createDataFrame([(i, bytearray(p)) for i, p in enumerate(pieces(load_tokenizer(tokenizer_path)))], "tok int, piece binary")
    each = rows.select(F.col(id_col).alias("id"), F.posexplode_outer(ids_col).alias("pos", "tok"))
    joined = each.join(F.broadcast(known), "tok", "left").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "piece"))).alias("p"))

    @F.pandas_udf("string")
    def text(p):
        return p.map(lambda rows: b"".join(r["piece"] or b"" for r in rows).decode("utf-8", "replace"))

    return joined.select("id", text("p").alias("decoded"))


def op3_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select(
        F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
