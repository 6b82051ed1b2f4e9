"""WARC files: round trip, ranges, revisits and damage."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io

import pyarrow as pa
import pytest

from tidelog.llm import warc

FIELDS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


@pytest.fixture
def pages(spark):
    embedded = "text with WARC/1.1 and \x1f\x8b inside"
    rows = [(i, f"http://h/{i}", f"<p>{i % 40} " + "é" * (i % 7) * 50) for i in range(120)]
    rows += [(200, None, None), (201, "", ""), (202, "http://a b/\r\nX: y", embedded), (203, "u", "z" * 300_000), (None, "u", "z" * 300_000), (203, "u", "z" * 300_000), (None, "n", "only")]
    return spark.createDataFrame([(*r, 5) for r in rows], "page_id long, url string, html string, sha1 int")


def wanted(pages, least: int = 0) -> list[tuple]:
    rows = [(r.page_id, (r.html or "").encode()) for r in pages.collect()]
    first: dict[bytes, int] = {}
    for i, p in rows:
        if i is not None:
            first[p] = min(i, first.get(p, i))
    out = []
    for i, p in rows:
        refers = first.get(p) if len(p) >= least and first.get(p) != i else None
        hashed = base64.b32encode(hashlib.sha1(p).digest()).decode()
        out.append((i, len(p), hashed, "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


@pytest.mark.parametrize("range_bytes", [700, 50_000, 16 << 20])
def test_round_trip_for_any_ranges(pages, monkeypatch, range_bytes):
    monkeypatch.setattr(warc, "RANGE_BYTES", range_bytes)
    monkeypatch.setattr(warc, "FILE_BYTES", 9_000)
    got = warc.read(warc.write(pages), payload=False).select(FIELDS).collect()
    assert sorted(map(tuple, got), key=str) == wanted(pages)


def test_small_payloads_stay_responses(pages):
    got = warc.read(warc.write(pages, least=100)).collect()
    assert sorted([tuple(r[f] for f in FIELDS) for r in got], key=str) == wanted(pages, 100)
    assert all((r.payload is None) == (r.record_type == "revisit") and r.error is None for r in got)


def test_files_are_plain_gzip(pages):
    manifest = warc.write(pages).collect()
    data = b"".join(gzip.decompress(open(r.path, "rb").read()) for r in manifest if r.records)
    assert data.count(b"WARC/1.1\r\nWARC-Type: ") == pages.count()


def test_damaged_record_is_reported_and_the_next_is_read():
    a, b, c = (warc.record(i, "u", f"text {i} ".encode() * 400, None) for i in range(3))
    spoilt = b[: len(b) // 2] + b"\0\0\0\0" + b[len(b) // 2 + 4 :]
    data = a + spoilt + c
    file = pa.PythonFile(io.BytesIO(data), mode="r")
    found = list(warc.members(file, len(data), 0, len(data)))
    assert [e is None for _, _, e in found] == [True, False, True]
    assert [warc.parsed(x)["key"] for _, x, e in found if e is None] == [0, 2]


def test_no_pages(pages):
    assert warc.read(warc.write(pages.limit(0))).count() == 0
