"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str, options: dict | None = None) -> DataFrame:
    """Write ``df`` under the shared folder and reread it: later steps don't recompute it, lost executors don't matter."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").options(**options or {}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_bucket(col: str):
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")))


def text_slices(texts: list[str | None], most: int) -> Iterator[list[tuple[int, str]]]:
    """Groups of (row, text) of at most about ``most`` characters; a longer text comes in consecutive slices."""
    group: list[tuple[int, str]] = []
    size = 0
    for row, text in enumerate(texts):
        text = text or ""
        for at in range(0, max(1, len(text)), most):
            part = text[at:at + most]
            if group and size + len(part) > most:
                yield group
                group, size = [], 0
            group.append((row, part))
            size += len(part)
    if group:
        yield group


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: one-to-one on 64-bit integers (wraps on purpose)."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the first of name_1, name_2 ... that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    out, i = name, 0
    while out.lower() in taken:
        i += 1
        out = f"{name}_{i}"
    return out


def keep_where(docs: DataFrame, result, field: str) -> DataFrame:
    """The rows of ``docs``, all columns as they are, for which the boolean ``field`` of the struct ``result`` is true."""
    name = free_name(docs, "verdict")
    return docs.withColumn(name, result).filter(F.col(f"{name}.{field}")).select(*[F.col(f"`{c}`") for c in docs.columns])


def give_back() -> None:
    """Return what a task's arrays held to the system: a worker that serves other tasks later keeps none of it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


_kept: dict = {}  # what this worker keeps from task to task, for one owner at a time


def worker_cache(owner, make):
    """``make()``, kept in this Python worker until a task of another owner runs in it."""
    if owner not in _kept:
        release_cache()
        _kept[owner] = make()
    return _kept[owner]


def release_cache() -> None:
    if _kept:
        _kept.clear()
        give_back()


def then_give_back(run):
    """``run`` of mapInArrow or applyInArrow (an iterator of batches), around which the worker's free memory is returned."""
    def wrapped(*args):
        release_cache()
        try:
            yield from run(*args)
        finally:
            give_back()
    return wrapped
