"""Shared folders, landed tables and worker helpers of the text operators."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidelog.session import scratch_root

REPOSITORY = Path(__file__).resolve().parents[2]

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Make this package importable in the workers where the Python path does not have it already."""
    paths = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    app = spark.sparkContext.applicationId
    if app not in _shipped and str(REPOSITORY) not in paths:
        base = os.path.join(tempfile.mkdtemp(), "tidelog_package")
        spark.sparkContext.addPyFile(shutil.make_archive(base, "zip", REPOSITORY, "tidelog"))
    _shipped.add(app)
    return spark


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the folder that all executors share."""
    return f"{scratch_root(spark)}/llm/{name}-{uuid.uuid4().hex}"


def landed(df: DataFrame, name: str, options: dict[str, int] | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back, which cuts its lineage."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_number_key(df: DataFrame, key: str) -> str:
    """The type of a key column; keys that are not whole numbers are refused before any work."""
    kind = dict(df.dtypes)[key]
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError(f"keys must be whole numbers, but {key} is {kind}")
    return kind


def fresh_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def texts(column: pa.Array) -> Iterator[str]:
    """Values of a string column one at a time, with empty text for null."""
    for value in column:
        yield value.as_py() or ""


def blocks(column: pa.Array, limit: int = 4 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of consecutive rows as UTF-8 with about ``limit`` bytes each, with the first row's index."""
    start, held, size = 0, [], 0
    for i, value in enumerate(column.cast(pa.large_binary())):
        data = value.as_py() or b""
        if held and size + len(data) > limit:
            yield start, held
            start, held, size = i, [], 0
        held.append(data)
        size += len(data)
    if held:
        yield start, held


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SLOTS = 64
_BYTE_AT = mixed(np.arange(1, _SLOTS * 256 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def words_of(documents: list[bytes], separators: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of several texts: their 64-bit hashes (A-Z as a-z), document numbers, and first and end byte in the text.

    A word is a longest run of bytes that are not ``separators``; its hash sums a random number for
    each byte and place, so equal words have equal hashes and others collide with chance 2^-64.
    """
    data = np.frombuffer(b"\n".join(documents), dtype=np.uint8)
    inside = ~separators[data]
    lengths = np.fromiter(map(len, documents), dtype=np.int64, count=len(documents))
    begins = np.concatenate(([0], np.cumsum(lengths + 1)))[:-1]
    inside[begins[1:] - 1] = False
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False]))))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none, none
    size = ends - starts
    place = np.arange(int(size.sum()), dtype=np.int32) - np.repeat((np.cumsum(size) - size).astype(np.int32), size)
    value = _BYTE_AT[((place & (_SLOTS - 1)) << 8) | _LOWER[data[inside]]]
    if size.max() > _SLOTS:
        far = place >= _SLOTS
        value[far] *= mixed((place[far] // _SLOTS).astype(np.uint64)) | np.uint64(1)
    hashes = mixed(np.add.reduceat(value, np.cumsum(size) - size))
    owner = np.searchsorted(begins, starts, side="right") - 1
    return hashes, owner, starts - begins[owner], ends - begins[owner]
