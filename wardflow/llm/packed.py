"""Compressed Arrow buffers as the unit of a shuffle: one row carries thousands of words or numbers."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext


def pack(**columns) -> bytes:
    """One row of byte strings and Arrow arrays (these as lists), compressed."""
    made = {}
    for name, x in columns.items():
        if isinstance(x, bytes):
            made[name] = pa.array([x], pa.binary())
        else:
            made[name] = pa.array([x], pa.list_(x.type))
    batch = pa.RecordBatch.from_pydict(made)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(body: pa.Scalar) -> dict[str, pa.Scalar]:
    batch = pa.ipc.open_stream(body.as_buffer()).read_next_batch()
    return {name: batch.column(name)[0] for name in batch.schema.names}


def planes(x: np.ndarray) -> bytes:
    """Non-negative integers as runs of their first, second ... bytes, as many as the largest has; high ones compress away."""
    x = x.astype("<u8", copy=False)
    width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    return bytes([width]) + x.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def numbers(body: pa.Scalar) -> np.ndarray:
    """The integers of ``planes`` as int64."""
    raw = np.frombuffer(body.as_buffer(), np.uint8)
    width = int(raw[0])
    out = np.zeros(((len(raw) - 1) // width, 8), np.uint8)
    out[:, :width] = raw[1:].reshape(width, -1).T
    return out.view("<u8").ravel().astype(np.int64)


def floats(body: pa.Scalar) -> np.ndarray:
    return np.frombuffer(body.as_buffer(), np.float64)


def text_chunks(batches: Iterator[pa.RecordBatch], chars: int, text: str = "text") -> Iterator[tuple[int, pa.Table, list[bytes]]]:
    """(key, rows, texts as UTF-8) of about ``chars`` bytes each; a longer text makes a chunk of its own.

    The key holds a hash of the texts and of the partition, so that two readings of an unchanged input give the same
    keys and those of a changed one don't meet.
    """
    from xxhash import xxh64

    part = TaskContext.get().partitionId()
    number = count()
    rows, texts, size = [], [], 0

    def key() -> int:
        content = xxh64(f"{part},{next(number)},{len(texts)}")
        for t in texts:
            content.update(t)
            content.update(b"\0")
        return content.intdigest() - (1 << 63)

    for batch in batches:
        if not batch.num_rows:
            continue
        body = batch.column(text).cast(pa.binary()).to_pylist()
        rest = batch.drop_columns([text])
        start = 0
        for i, t in enumerate(body):
            texts.append(t or b"")
            size += len(texts[-1])
            if size >= chars:
                rows.append(rest.slice(start, i + 1 - start))
                yield key(), pa.Table.from_batches(rows), texts
                rows, texts, size, start = [], [], 0, i + 1
        if start < len(body):
            rows.append(rest.slice(start))
    if texts:
        yield key(), pa.Table.from_batches(rows), texts
