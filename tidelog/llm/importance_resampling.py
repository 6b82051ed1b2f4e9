"""Resampling of a corpus towards a target distribution, by hashed word features.

Every text is a bag of features: all runs of ``runs`` consecutive words, hashed into ``BUCKETS``
buckets. A bucket's gain is the logarithm of how much likelier it is in the target texts than in the
corpus. The weight of a text is the mean gain of its features, read from one array of gains. To each
weight comes Gumbel noise that follows from the key alone, so the highest scores are a sample without
replacement in proportion to the weights' exponentials, the same on every run.

The sample's end is found without sorting the corpus: scores are written once, and bisection narrows
the cutoff by exact count jobs, on the score first, then on the key among ties, and among rows with
one key on a hash of the text and on the row's number. Only the rows that are drawn are range-partitioned
and sorted, which gives their ranks; a hot score is split over ranges by the key.

Null and empty texts have no features and weight 0. Equal scores rank by smaller key, a null key last;
repeated rows count one by one. An empty corpus gives an empty table, an empty target equal counts of
nothing. Texts of any length are read whole, piece by piece. Columns other than the key and the text
are ignored. Keys must be whole numbers, as bisection needs; others are refused.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import landed, ship, whole_number_key

BUCKETS = 10_000
SEED = 2024
#: Texts with fewer words are weighed, but never drawn.
LEAST_WORDS = 20
#: Drawn rows that one task sorts.
RANGE = 500_000
#: Features whose bucket a worker keeps, and bytes of a text that are split into words at a time.
CACHE, PIECE = 600_000, 1 << 20

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
_LAST = (1 << 63) - 1


def pieces(data: bytes) -> Iterator[bytes]:
    """A text in pieces of about ``PIECE`` bytes that end between words."""
    at = 0
    while len(data) - at > PIECE:
        gap = _GAP.search(data, at + PIECE)
        if not gap:
            break
        yield data[at : gap.start()]
        at = gap.start()
    yield data[at:]


class Buckets(dict):
    """Bucket of each feature asked for."""

    def __init__(self, runs: int) -> None:
        self._runs = runs

    def __missing__(self, feature: bytes) -> int:
        bucket = zlib.crc32(feature) % BUCKETS
        if len(self) < CACHE:
            self[feature] = bucket
        return bucket

    def of(self, data: bytes) -> Iterator[tuple[int, np.ndarray]]:
        """For each piece of a text its words, counted, and the buckets of the features that end in it."""
        before: list[bytes] = []
        for piece in pieces(data):
            words = _WORD.findall(piece.lower())
            features: list[bytes] = list(words)
            for size in range(2, self._runs + 1):
                near = before[len(before) - min(size - 1, len(before)) :] + words
                features += map(b" ".join, zip(*(near[i:] for i in range(size)), strict=False))
            yield len(words), np.fromiter(map(self.__getitem__, features), dtype=np.int32, count=len(features))
            before = (before + words)[-(self._runs - 1) :] if self._runs > 1 else []


def bucket_counts(df: DataFrame, text: str = "text", runs: int = 1) -> DataFrame:
    """``bucket``, ``n``: how often the features of all texts fall into each bucket; a task sums up before the shuffle."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, total = Buckets(runs), np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for value in batch.column(0):
                for _, found in buckets.of(value.as_py() or b""):
                    total += np.bincount(found, minlength=BUCKETS)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], ["bucket", "n"])

    rows = df.select(F.col(text).cast("binary").alias("text")).mapInArrow(run, "bucket long, n long")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame) -> np.ndarray:
    """Gain of every bucket in thousandths from two tables of bucket counts (``BUCKETS`` rows each at most)."""

    def dense(counts: DataFrame) -> list[int]:
        found = dict(counts.select("bucket", "n").collect())
        return [found.get(b, 0) for b in range(BUCKETS)]

    s, t = dense(corpus), dense(target)
    all_s, all_t = float(sum(s) + BUCKETS), float(sum(t) + BUCKETS)
    return np.array([math.floor(1000 * math.log((b + 1.0) * all_s / ((a + 1.0) * all_t))) for a, b in zip(s, t, strict=True)], dtype=np.int64)


def noise(key: Column) -> Column:
    """Gumbel noise in thousandths that follows from the key."""
    digest = F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def weighed(df: DataFrame, gain: np.ndarray, key: str = "doc_id", text: str = "text", runs: int = 1) -> DataFrame:
    """``key``, n_words, n_features, weight and content (a hash of the text) of every row."""
    shared = ship(df.sparkSession).sparkContext.broadcast(gain)  # BUCKETS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, gain = Buckets(runs), shared.value
        for batch in batches:
            words, features, weights = [], [], []
            for value in batch.column(1):
                n_words = n = total = 0
                for new, found in buckets.of(value.as_py() or b""):
                    n_words, n, total = n_words + new, n + len(found), total + int(gain[found].sum())
                words.append(n_words)
                features.append(n)
                weights.append(total // n if n else 0)
            columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in (words, features, weights)), batch.column(2)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "n_words", "n_features", "weight", "content"])

    rows = df.select(F.col(key).cast("long").alias("key"), F.col(text).cast("binary").alias("text"), F.xxhash64(text).alias("content"))
    return rows.mapInArrow(run, "key long, n_words long, n_features long, weight long, content long")


def cutoff(rows: DataFrame, columns: Sequence[str], place: int) -> list[int]:
    """Values, in ``columns``, of the row at ``place`` (from 1) in their ascending order, found by counting.

    The columns hold whole numbers and no nulls. Columns after the first one whose ties all lie before
    the place are left out.
    """
    found: list[int] = []
    tied, wanted = F.lit(True), place
    for name in columns:
        here = rows.where(tied)
        low, high, upto = here.agg(F.min(name), F.max(name), F.count("*")).first()
        below = 0
        while low < high:
            middle = (low + high) // 2
            n = here.where(F.col(name) <= middle).count()
            if n >= wanted:
                high, upto = middle, n
            else:
                low, below = middle + 1, n
        found.append(low)
        if upto == wanted:
            break
        tied, wanted = tied & (F.col(name) == low), wanted - below
    return found


def up_to(columns: Sequence[str], values: Sequence[int]) -> Column:
    """Whether a row stands no later than ``values`` in the order of the columns."""
    before, tied = F.lit(False), F.lit(True)
    for name, value in zip(columns, values, strict=False):
        before, tied = before | (tied & (F.col(name) < value)), tied & (F.col(name) == value)
    return before | tied


def ranked(rows: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    """``n`` rows with ``rank`` by the columns: ranges are sorted side by side, and sizes of the ranges before are added."""
    ranges = -(-n // RANGE)
    placed = rows.repartitionByRange(max(ranges, 1), *columns).sortWithinPartitions(*columns)
    # The number holds the range above bit 33 and the place in it below.
    placed = landed(placed.withColumn("_at", F.monotonically_increasing_id()), "ranges")
    of_range = F.shiftright("_at", 33).cast("int")
    sizes = sorted(placed.groupBy(of_range.alias("_range")).count().collect())
    starts, start = [], 0
    for number, size in sizes:
        starts.append((number, start))
        start += size
    first = rows.sparkSession.createDataFrame(starts, "_range int, _start long")  # a row per range
    joined = placed.withColumn("_range", of_range).join(F.broadcast(first), "_range")
    return joined.withColumn("rank", F.col("_at").bitwiseAND((1 << 33) - 1) + F.col("_start") + 1).drop("_at", "_range", "_start")


def resampled(corpus: DataFrame, target: DataFrame, percent: int, key: str = "doc_id", text: str = "text", target_text: str = "text", runs: int = 1) -> DataFrame:
    """``key``, n_features, weight, score and rank (null where not drawn) of every row of the corpus."""
    kind = whole_number_key(corpus, key)
    gain = gains(bucket_counts(corpus, text, runs), bucket_counts(target, target_text, runs))
    scores = weighed(corpus, gain, key, text, runs).withColumn("score", F.col("weight") + noise(F.col("key")))
    order = ["_score", "_key", "content", "_row"]
    scores = scores.withColumns({"_score": -F.col("score"), "_key": F.coalesce("key", F.lit(_LAST)), "_row": F.monotonically_increasing_id()})
    scores = landed(scores, "scores")
    eligible = scores.where(F.col("n_words") >= LEAST_WORDS)
    n = eligible.count() * percent // 100
    result = ["key", "n_features", "weight", "score", "rank"]
    if n:
        drawn = (F.col("n_words") >= LEAST_WORDS) & up_to(order, cutoff(eligible, order, n))
        out = ranked(scores.where(drawn), order, n).select(result)
        out = out.unionByName(scores.where(~drawn).withColumn("rank", F.lit(None).cast("long")).select(result))
    else:
        out = scores.withColumn("rank", F.lit(None).cast("long")).select(result)
    return out.withColumn("key", F.col("key").cast(kind)).withColumnRenamed("key", key)
