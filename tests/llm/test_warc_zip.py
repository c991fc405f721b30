import gzip
import io
import os
import uuid
import zipfile

import pyarrow as pa
import pytest

from wardflow.llm import warc_zip as W
from wardflow.session import scratch_path

SCHEMA = "page_id long, url string, html string, payload string, digest string, size int"


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "p", "d", 1) for i, u, h in rows], SCHEMA)


def run(spark, rows, **how):
    return W.read_packages(W.write_packages(frame(spark, rows).repartition(3), scratch_path(spark, "warc-test"), **how)).collect()


def test_round_trip(spark):
    rows = [(3, "http://a.example/ü", "<p>same é</p>"), (1, "http://b.example/\r\nX: y", "<p>same é</p>"), (2, None, "<p>same é</p>"), (7, "u", "\r\n\r\nWARC/1.1\r\n"),
            (8, "u", None), (9, "u", ""), (10, "u", "x" * 3_000_000), (None, "u", "<p>same é</p>"), (None, "u", "only here"), (1, "u2", "<p>same é</p>"), (-4, "u", "neg")]
    got = {}
    for r in run(spark, rows):
        got.setdefault(r["page_id"], []).append(r)
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    assert sum(map(len, got.values())) == len(rows)
    for i, _, h in rows:
        body = (h or "").encode()
        r = next(x for x in got[i] if x["payload_digest"] == W.sha1_base32(body))
        lead = first.get(h or "")
        assert r["payload_bytes"] == len(body)
        if lead is None or lead == i:
            assert (r["record_type"], r["refers_to"], bytes(r["payload"])) == ("response", None, body)
        else:
            assert (r["record_type"], r["refers_to"], r["payload"]) == ("revisit", lead, None)
    assert {r["url"] for r in got[1]} == {"http://b.example/%0D%0AX: y", "u2"} and got[2][0]["url"] is None


def test_small_payloads_can_stay_responses(spark):
    got = run(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], min_bytes=3)
    assert sorted((r["page_id"], r["record_type"]) for r in got) == [(1, "response"), (2, "response"), (3, "response"), (4, "revisit")]


def test_empty_table(spark):
    assert run(spark, []) == []


def test_several_packages_a_task(spark, monkeypatch):
    monkeypatch.setattr(W, "PACKAGE_BYTES", 500)
    manifest = W.write_packages(frame(spark, [(i, "u", str(uuid.uuid4()) * 5) for i in range(30)]).coalesce(1), scratch_path(spark, "warc-test"))
    assert sum(r["records"] for r in manifest.collect()) == 30
    assert sorted(r["page_id"] for r in W.read_packages(manifest).collect()) == list(range(30))


def open_bytes(data):
    return pa.PythonFile(io.BytesIO(data), mode="r")


class Reader:
    """A file of which each read is noted."""

    def __init__(self, data):
        self.data, self.reads = data, []

    def size(self):
        return len(self.data)

    def read_at(self, n, at):
        self.reads.append((at, n))
        return self.data[at:at + n]


def package(path, bodies):
    p = W.Package(path)
    for i, b in enumerate(bodies):
        p.add(i, f"http://x/{i}", W.record(i, f"http://x/{i}", "response", None, W.sha1_base32(b), len(b), b))
    p.close()
    return open(path, "rb").read()


def test_reads_by_range(tmp_path):
    bodies = [os.urandom(20_000) for _ in range(50)]
    data = package(str(tmp_path / "a.zip"), bodies)
    f = Reader(data)
    members = W.read_directory(f)
    assert set(members) == {W.DATA, W.INDEX}
    index = {e["page_id"]: e for e in W.read_index(f, members)}
    f.reads.clear()
    got = list(W.read_package(f, [index[7], index[30]]))
    assert [W.parse_record(r)[1] for r in got] == [bodies[7], bodies[30]]
    at = W.stored_member(f, members, W.DATA)[0]
    wide = [(a, n) for a, n in f.reads if n > 10_000 and a < at + members[W.DATA][2] - 70_000]
    assert wide == [(at + index[i]["offset"], index[i]["length"]) for i in (7, 30)]
    # any other reader of ZIP and gzip agrees
    with zipfile.ZipFile(tmp_path / "a.zip") as z:
        assert z.testzip() is None and gzip.decompress(z.read(W.DATA)).count(b"WARC/1.1") >= 50


def test_zip64_directory(monkeypatch, tmp_path):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 100)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    data = package(str(tmp_path / "b.zip"), [os.urandom(500) for _ in range(5)])
    assert W.EOCD64 in data and W.LOCATOR64 in data
    f = Reader(data)
    assert len(list(W.read_package(f))) == 5


def test_broken_packages(tmp_path):
    with pytest.raises(ValueError, match="not a ZIP"):
        W.read_directory(Reader(b"no zip at all"))
    with zipfile.ZipFile(tmp_path / "c.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(W.DATA, b"x" * 1000)
    f = Reader((tmp_path / "c.zip").read_bytes())
    with pytest.raises(ValueError, match="compressed"):
        W.stored_member(f, W.read_directory(f), W.DATA)
