"""WARC records in ZIP packages: writing them, and reading records back by range without extraction.

A package holds stored (uncompressed) members: ``archive/data.warc.gz`` with one
gzip member per record, and ``indexes/index.cdxj`` with each record's place. The
reader looks at a package's end, parses the central directory (with its ZIP64
records), checks that the members it needs are stored, reads the index and then
only the ranges that hold records.

Each writing task makes packages of at most about ``PACKAGE_BYTES`` under a name of
its own attempt; the manifest, written by Spark, names those of the attempts that
counted, so lost or repeated tasks leave no wrong package in the result. Files are
reached through pyarrow's file systems (local, HDFS, object stores), under the
shared folder.

Payloads that agree (same SHA-1 and length) and have at least ``min_bytes`` bytes
are stored once: the record with the smallest page_id is the response, the others
are revisits. Defined results: null html is an empty payload; a null page_id
counts as larger than any other; rows that repeat the smallest page_id and its
payload are responses all; a null url is left out. Other columns aren't read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm.common import stage, table
from wardflow.session import scratch_path

PACKAGE_BYTES = 128 << 20
READ_BYTES = 4 << 20  # read at once, or one record
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
DATE = "2024-01-01T00:00:00Z"
_MANIFEST = "path string, records long, bytes long"
_RECORD = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long"

# fixed values of the ZIP format
EOCD, EOCD64, LOCATOR64, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"


def open_store(path: str):
    """(file system, path in it)"""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


# -- records

def record(page_id, url, kind: str, refers_to, digest: str, size: int, payload: bytes) -> bytes:
    """One WARC record; a revisit has the HTTP head only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{page_id}>"), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", re.sub(r"[\r\n]", lambda m: "%%%02X" % ord(m[0]), url)))
    if kind == "revisit":
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    head += [("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Payload-Length", str(size)),
             ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, payload) of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    return headers, rest[:int(headers["Content-Length"])].partition(b"\r\n\r\n")[2]


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# -- packages

def read_directory(f) -> dict[str, tuple[int, int, int]]:
    """Members of an open ZIP file: name -> (method, offset of the local header, stored size)."""
    size = f.size()
    tail_at = max(0, size - 22 - 65535 - 20)
    tail = f.read_at(size - tail_at, tail_at)
    at = tail.rfind(EOCD)
    if at < 0:
        raise ValueError("no end of central directory: not a ZIP file")
    count, length, start = struct.unpack("<HII", tail[at + 10:at + 20])
    if count == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
        locator = tail[at - 20:at]
        if locator[:4] != LOCATOR64:
            raise ValueError("no ZIP64 locator")
        end = f.read_at(56, struct.unpack("<Q", locator[8:16])[0])
        if end[:4] != EOCD64:
            raise ValueError("no ZIP64 end of central directory")
        count, length, start = struct.unpack("<QQQ", end[32:56])
    raw, pos, out = f.read_at(length, start), 0, {}
    for _ in range(count):
        if raw[pos:pos + 4] != ENTRY:
            raise ValueError("broken central directory")
        flags, method = struct.unpack("<HH", raw[pos + 8:pos + 12])
        packed, full, n, e, c = struct.unpack("<IIHHH", raw[pos + 20:pos + 34])
        offset = struct.unpack("<I", raw[pos + 42:pos + 46])[0]
        name = raw[pos + 46:pos + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        extra, x = raw[pos + 46 + n:pos + 46 + n + e], 0
        while x + 4 <= len(extra):
            kind, width = struct.unpack("<HH", extra[x:x + 4])
            if kind == 1:  # ZIP64: the fields that don't fit, in this order
                wide, y = extra[x + 4:x + 4 + width], 0
                if full == 0xFFFFFFFF:
                    full, y = struct.unpack("<Q", wide[y:y + 8])[0], y + 8
                if packed == 0xFFFFFFFF:
                    packed, y = struct.unpack("<Q", wide[y:y + 8])[0], y + 8
                if offset == 0xFFFFFFFF:
                    offset = struct.unpack("<Q", wide[y:y + 8])[0]
            x += 4 + width
        out[name] = (method, offset, packed)
        pos += 46 + n + e + c
    return out


def stored_member(f, members: dict[str, tuple[int, int, int]], name: str) -> tuple[int, int]:
    """(offset, size) of a stored member's bytes."""
    method, offset, size = members[name]
    if method != 0:
        raise ValueError(f"{name} is compressed (method {method}); only stored members can be read by range")
    local = f.read_at(30, offset)
    if local[:4] != LOCAL:
        raise ValueError(f"no local header for {name}")
    n, e = struct.unpack("<HH", local[26:30])
    return offset + 30 + n + e, size


def read_index(f, members) -> list[dict]:
    at, size = stored_member(f, members, INDEX)
    return [json.loads(line.split(" ", 2)[2]) for line in f.read_at(size, at).decode().splitlines()]


def read_package(f, entries: list[dict] | None = None) -> Iterator[bytes]:
    """The records of an open package, or those of some index entries, read by range."""
    members = read_directory(f)
    base, size = stored_member(f, members, DATA)
    entries = read_index(f, members) if entries is None else entries
    entries = sorted(entries, key=lambda e: e["offset"])
    i = 0
    while i < len(entries):
        j, start = i + 1, entries[i]["offset"]
        end = start + entries[i]["length"]
        while j < len(entries) and entries[j]["offset"] == end and end + entries[j]["length"] - start <= READ_BYTES:
            end += entries[j]["length"]
            j += 1
        if end > size:
            raise ValueError("index points beyond its archive")
        data = f.read_at(end - start, base + start)
        for e in entries[i:j]:
            yield gzip.decompress(data[e["offset"] - start:e["offset"] - start + e["length"]])
        i = j


class Package:
    """One ZIP package written front to back."""

    def __init__(self, path: str):
        import zipfile

        self.path = path
        self.store, inner = open_store(path)
        self.out = self.store.open_output_stream(inner)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED)
        self.data = self.zip.open(DATA, "w", force_zip64=True)
        self.index, self.bytes = [], 0

    def add(self, page_id, url, body: bytes) -> None:
        packed = zlib.compressobj(4, zlib.DEFLATED, 31)
        body = packed.compress(body) + packed.flush()
        self.data.write(body)
        key = re.sub(r"\s", "+", url or "-")
        self.index.append(f"{key} {re.sub('[^0-9]', '', DATE)} " + json.dumps({"filename": DATA, "offset": self.bytes, "length": len(body), "page_id": page_id}))
        self.bytes += len(body)

    def close(self) -> tuple[str, int, int]:
        self.data.close()
        self.zip.writestr(INDEX, "\n".join(sorted(self.index)))
        self.zip.close()
        self.out.close()
        return self.path, len(self.index), self.bytes


# -- Spark steps

def plan_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, digest in hex, size, first): ``first`` is the response's page_id for revisits, else null."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload").cast("long"))
    lead = rows.groupBy("digest", "size").agg(F.min("page_id").alias("lead"))
    same = F.col("page_id").eqNullSafe(F.col("lead")) | (F.col("size") < min_bytes) | F.col("lead").isNull()
    return rows.join(lead, ["digest", "size"]).withColumn("first", F.when(~same, F.col("lead"))).drop("lead")


def write_packages(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """The manifest (path, records, bytes) of the packages written under ``folder``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, inner = open_store(folder)
        store.create_dir(inner, recursive=True)
        done, now = [], None
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                for r in batch.slice(at, 500).to_pylist():
                    now = now or Package(f"{folder}/{uuid.uuid4().hex}.zip")
                    kind = "response" if r["first"] is None else "revisit"
                    digest = base64.b32encode(bytes.fromhex(r["digest"])).decode()
                    now.add(r["page_id"], r["url"], record(r["page_id"], r["url"], kind, r["first"], digest, r["size"], r["payload"]))
                    if now.bytes >= PACKAGE_BYTES:
                        done.append(now.close())
                        now = None
        if now:
            done.append(now.close())
        if done:
            path, n, size = zip(*done, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(path), pa.array(n, pa.int64()), pa.array(size, pa.int64())], ["path", "records", "bytes"])

    return stage(plan_records(pages, min_bytes).mapInArrow(run, _MANIFEST), "warc-manifest")


def read_packages(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """One row per record of the packages named in ``manifest``; a response's payload must have its digest."""

    def number(value: str | None) -> int | None:
        found = re.fullmatch(r"<urn:page:(-?\d+)>", value or "")
        return int(found[1]) if found else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()] + [pa.binary()] * with_payload
        names = [c.split()[0] for c in _RECORD.split(", ")] + ["payload"] * with_payload

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, inner = open_store(path)
                rows, size = [], 0
                with store.open_input_file(inner) as f:
                    for data in read_package(f):
                        head, payload = parse_record(data)
                        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                        full = head["WARC-Type"] == "response"
                        if full and sha1_base32(payload) != digest:
                            raise ValueError(f"payload of {head['WARC-Record-ID']} in {path} has another digest")
                        rows.append((number(head["WARC-Record-ID"]), head.get("WARC-Target-URI"), head["WARC-Type"],
                                     number(head.get("WARC-Refers-To")), digest, len(payload) if full else int(head["WARC-Payload-Length"]),
                                     *([payload if full else None] if with_payload else [])))
                        size += len(data) if with_payload else 0
                        if len(rows) >= 5000 or size > READ_BYTES:
                            yield out(rows)
                            rows, size = [], 0
                if rows:
                    yield out(rows)

    packages = manifest.count()  # of files, not records
    return manifest.select("path").repartition(max(1, packages)).mapInArrow(run, _RECORD + ", payload binary" * with_payload)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_packages(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return read_packages(manifest, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")
