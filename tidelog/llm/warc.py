"""WARC archives: a writer with revisit records and a reader that splits files by byte ranges.

Every record is a gzip member of its own. A reading task owns a byte range: it looks for the gzip magic
number, takes a place as the start of a record only if it decodes to a WARC header there, and reads
every record that starts inside its range to the end, beyond the range if need be. So each record is
read exactly once, whatever the ranges, and no index is needed.

Writing: tasks write files under names of their own and return them; only files in the manifest of
tasks that succeeded are read, so a task that runs again leaves at most an orphan behind. Files go
through Arrow's file systems (local and mounted folders, S3, GCS, HDFS), below the shared folder.

Null payloads are written as empty ones. Keys must be whole numbers. Of records with equal payloads of at least ``least`` bytes,
those with the smallest id are responses and the others revisit it; ids that are null never are the
smallest, and records of a payload that only null ids have are all responses. Repeated rows of the
smallest id are responses each. A null or empty URL leaves its header out. An empty table gives an empty
manifest. A record that cannot be decoded to its end gives a row with its place and ``error``.
Further columns are not written.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import landed, shared_path, ship, whole_number_key

#: Bytes after which a writer starts another file, and bytes of a reader's range.
FILE_BYTES, RANGE_BYTES = 256 << 20, 16 << 20
#: Most reading tasks; with more ranges, tasks read several.
MOST_TASKS = 100_000
_MAGIC, _CHUNK, _LEVEL = b"\x1f\x8b\x08", 64 << 10, 4
_DATE = "2024-01-01T00:00:00Z"
_SAFE = "!#$%&'()*+,-./:;=?@[]_~"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    """SHA-1 in base 32, as WARC headers have it after their ``sha1:``."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(key: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One gzip member: a response, or a revisit of the record ``refers_to``, which leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if key is None else key}>",
        f"WARC-Date: {_DATE}",
        *([f"WARC-Target-URI: {quote(url, safe=_SAFE)}"] if url else []),
        *([f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_PROFILE}"] if refers_to is not None else []),
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    packer = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + packer.flush()


def write(pages: DataFrame, least: int = 0, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write a record per row below the shared folder; returns the manifest ``path, bytes, records``."""
    whole_number_key(pages, key)
    spark = ship(pages.sparkSession)
    folder = shared_path(spark, "warc")
    data = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).alias("url"), data.alias("payload"), F.sha1(data).alias("sha1"))
    copied = rows.where(F.octet_length("payload") >= least).groupBy("sha1").agg(F.min("key").alias("first"), F.count("*").alias("copies"))
    # Landed, so that the join below reads two plain shuffles and a payload that very many rows share can be split.
    copied = landed(copied.where("copies > 1").select("sha1", "first"), "copied")
    keys = rows.select("key", "sha1").join(copied, "sha1").where("key is null or key <> first").select("key", "sha1", "first").distinct()
    revisits = landed(keys.withColumnRenamed("key", "k").withColumnRenamed("sha1", "s"), "revisits")
    marked = rows.join(revisits, F.col("key").eqNullSafe(F.col("k")) & (F.col("sha1") == F.col("s")), "left").select("key", "url", "payload", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(folder)
        out, path, size, count, done = None, "", 0, 0, []
        for batch in batches:
            for k, u, p, first in zip(*batch.columns, strict=True):
                if out is None:
                    files.create_dir(root, recursive=True)
                    path = f"{uuid.uuid4().hex}.warc.gz"
                    out, size, count = files.open_output_stream(f"{root}/{path}", compression=None), 0, 0
                member = record(k.as_py(), u.as_py(), p.as_py(), first.as_py())
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= FILE_BYTES:
                    out.close()
                    done.append((path, size, count))
                    out = None
        if out is not None:
            out.close()
            done.append((path, size, count))
        paths, sizes, counts = zip(*done, strict=True) if done else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array([f"{folder}/{p}" for p in paths], pa.string()), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], ["path", "bytes", "records"]
        )

    return landed(marked.mapInArrow(run, "path string, bytes long, records long"), "manifest")


class _Tail:
    """A file from some place on, read in pieces of bounded size."""

    def __init__(self, file: pa.NativeFile, size: int) -> None:
        self.file, self.size, self.begin, self.data = file, size, 0, b""

    def at(self, place: int, length: int) -> bytes:
        if place < self.begin or place + length > self.begin + len(self.data):
            want = min(max(length, 1 << 20), self.size - place)
            self.begin, self.data = place, self.file.read_at(want, place) if want > 0 else b""
        return self.data[place - self.begin : place - self.begin + length]


def _starts_record(tail: _Tail, place: int) -> bool:
    try:
        return zlib.decompressobj(31).decompress(tail.at(place, 1024), 64).startswith(b"WARC/1.")
    except zlib.error:
        return False


def _member(tail: _Tail, place: int) -> tuple[bytes, int]:
    """Content of the member that starts at a place, and the place after it."""
    unpacker, parts, at = zlib.decompressobj(31), [], place
    while not unpacker.eof:
        piece = tail.at(at, _CHUNK)
        if not piece:
            raise ValueError("the file ends inside a record")
        parts.append(unpacker.decompress(piece))
        at += len(piece)
    return b"".join(parts), at - len(unpacker.unused_data)


def members(file: pa.NativeFile, size: int, begin: int, end: int) -> Iterator[tuple[int, bytes | None, str | None]]:
    """Place, content and error of every record that starts in [begin, end)."""
    tail, place = _Tail(file, size), begin
    while place < end:
        window = tail.at(place, _CHUNK)
        if not window:
            return
        found = window.find(_MAGIC)
        if found < 0:
            place += max(1, len(window) - len(_MAGIC) + 1)
            continue
        place += found
        if place >= end:
            return
        if not _starts_record(tail, place):
            place += 1
            continue
        try:
            content, after = _member(tail, place)
        except (zlib.error, ValueError) as e:
            yield place, None, str(e)
            place += 1
            continue
        yield place, content, None
        place = after


def _number(text: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", text or "")
    return int(found[1]) if found else None


def parsed(content: bytes) -> dict:
    """Fields of a record; length and digest are those of the full payload."""
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])}
    body = rest[: int(fields["content-length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    kind = fields["warc-type"]
    if kind == "revisit":
        length = int(re.search(rb"(?i)content-length:\s*(\d+)", http)[1])
        hashed, payload = fields["warc-payload-digest"].removeprefix("sha1:"), None
    else:
        length, hashed = len(payload), digest(payload)
    return {
        "key": _number(fields.get("warc-record-id")), "url": fields.get("warc-target-uri"), "record_type": kind, "refers_to": _number(fields.get("warc-refers-to")),
        "payload_bytes": length, "payload_digest": hashed, "payload": payload,
    }


def read(manifest: DataFrame, key: str = "page_id", payload: bool = True) -> DataFrame:
    """A row per record of the files in a table with ``path`` and ``bytes``; without ``payload`` that column is left out."""
    ship(manifest.sparkSession)
    ranges = manifest.where("bytes > 0").select("path", "bytes", F.explode(F.sequence(F.lit(0), F.col("bytes") - 1, F.lit(RANGE_BYTES).cast("long"))).alias("begin"))
    tasks = max(1, min(ranges.count(), MOST_TASKS))
    columns = {
        "path": pa.string(), "place": pa.int64(), "key": pa.int64(), "url": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(),
        "payload_bytes": pa.int64(), "payload_digest": pa.string(), "error": pa.string(), **({"payload": pa.binary()} if payload else {}),
    }
    kinds = {pa.string(): "string", pa.int64(): "long", pa.binary(): "binary"}

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], kind) for c, kind in columns.items()], list(columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, begin in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                files, place = fs.FileSystem.from_uri(path)
                held, weight = [], 0
                with files.open_input_file(place) as file:
                    for at, content, error in members(file, size, begin, min(size, begin + RANGE_BYTES)):
                        held.append({"path": path, "place": at, "error": error, **(parsed(content) if error is None else {})})
                        weight += len(content or b"") * payload + 200
                        if weight > 4 << 20:
                            yield batch_of(held)
                            held, weight = [], 0
                if held:
                    yield batch_of(held)

    schema = ", ".join(f"{c} {kinds[k]}" for c, k in columns.items())
    return ranges.repartition(tasks).mapInArrow(run, schema).withColumnRenamed("key", key)
