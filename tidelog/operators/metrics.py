"""Rates and alerts over metric samples: label columns, ``ts`` and ``value``.

One series may hold most of a table. Ordered work is cut into short time chunks per series, and
only one or two rows per chunk meet in a second pass. Samples of a series may share a timestamp:
``order`` names a column that tells which came first, such as an offset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

CHUNK_S = 60


def _slot(seconds: int) -> Column:
    """Number of the ``seconds`` long slot that holds ``ts``, counted from the epoch."""
    return F.expr(f"floor(unix_micros(ts) / {seconds * 1_000_000}L)")


def _slot_start(slot: Column, seconds: int) -> Column:
    return F.timestamp_micros(slot * (seconds * 1_000_000))


def _step(value: Column, previous: Column) -> Column:
    """Growth of a counter between two samples; a drop means that it restarted from zero."""
    return F.when(value >= previous, value - previous).when(previous.isNotNull(), value)


def increase(
    samples: DataFrame, series: Sequence[str], every_s: int, order: str, chunk_s: int = CHUNK_S
) -> DataFrame:
    """Counter growth and rate per second for each series and window of ``every_s`` seconds.

    The growth from the last sample of an earlier window counts in the window it ends in. No
    extrapolation to the window edges.
    """
    if every_s % chunk_s:
        raise ValueError("every_s must be a multiple of chunk_s")
    keys = list(series)
    at = F.struct("ts", F.col(order).alias("order")).alias("_at")
    cut = samples.select(*keys, at, "value", _slot(chunk_s).alias("_chunk"))
    inside = Window.partitionBy(*keys, "_chunk").orderBy("_at")
    chunks = (
        cut.withColumn("_grown", _step(F.col("value"), F.lag("value").over(inside)))
        .groupBy(*keys, "_chunk")
        .agg(
            F.min_by("value", "_at").alias("_first"),
            F.max_by("value", "_at").alias("_last"),
            F.sum("_grown").alias("_grown"),
            F.count(F.lit(1)).alias("_samples"),
        )
    )
    across = Window.partitionBy(*keys).orderBy("_chunk")
    carried = _step(F.col("_first"), F.lag("_last").over(across))
    slot = F.expr(f"floor(_chunk / {every_s // chunk_s})")
    return (
        chunks.withColumn("_carried", carried)
        .groupBy(*keys, slot.alias("_slot"))
        .agg(
            F.sum("_samples").cast("bigint").alias("samples"),
            F.sum(
                F.coalesce("_grown", F.lit(0)) + F.coalesce("_carried", F.lit(0))
            ).alias("increase"),
        )
        .select(
            *keys,
            _slot_start(F.col("_slot"), every_s).alias("window_start"),
            "samples",
            "increase",
            (F.col("increase").cast("double") / F.lit(float(every_s))).alias("rate"),
        )
    )


def increase_above(increases: DataFrame, limit: float) -> DataFrame:
    return increases.filter(F.col("increase") > limit)


def sum_by(rows: DataFrame, labels: Sequence[str], value: str) -> DataFrame:
    """Sum over all series that share the labels; leave a label out to aggregate without it."""
    return rows.groupBy(*labels).agg(F.sum(value).alias(value))


def top_series(increases: DataFrame, series: Sequence[str], n: int = 10) -> DataFrame:
    """The series that grew most; labels break ties."""
    grown = increases.groupBy(*series).agg(F.sum("increase").alias("increase"))
    return grown.orderBy(F.desc("increase"), *series).limit(n)


def sustained(
    samples: DataFrame,
    series: Sequence[str],
    breach: Column,
    for_s: int,
    order: str,
    chunk_s: int = CHUNK_S,
) -> DataFrame:
    """Stretches of consecutive samples in breach that last at least ``for_s`` seconds."""
    keys = list(series)
    chunk = [*keys, "_chunk"]
    cut = samples.select(
        *keys,
        "ts",
        F.col(order).alias("_order"),
        _slot(chunk_s).alias("_chunk"),
        F.coalesce(breach, F.lit(False)).alias("_on"),
    )
    inside = Window.partitionBy(*chunk).orderBy("ts", "_order")
    turned = F.coalesce((F.col("_on") != F.lag("_on").over(inside)).cast("int"), F.lit(0))
    runs = (
        cut.withColumn("_turned", turned)
        .withColumn("_run", F.sum("_turned").over(inside))
        .groupBy(*chunk, "_run")
        .agg(
            F.first("_on").alias("_on"),
            F.min("ts").alias("started_at"),
            F.max("ts").alias("ended_at"),
            F.count(F.lit(1)).alias("samples"),
        )
        .withColumn("_last", F.max("_run").over(Window.partitionBy(*chunk)))
    )
    # Runs in the middle of a chunk are complete. The first and last may go on next door, so the
    # edges of a series meet in a place of their own; all other runs stay with their chunk.
    edge = (F.col("_run") == 0) | (F.col("_run") == F.col("_last"))
    across = Window.partitionBy(*keys, "_place").orderBy("_chunk", "_run")
    apart = (
        (F.col("_on") != F.lag("_on").over(across))
        | F.col("_place").isNotNull()
        | (
            (F.col("_chunk") == F.lag("_chunk").over(across))
            & (F.col("_run") - F.lag("_run").over(across) > 1)
        )
    )
    length = F.unix_micros("ended_at") - F.unix_micros("started_at")
    return (
        runs.withColumn("_place", F.when(~edge, F.col("_chunk")))
        .withColumn("_apart", F.coalesce(apart.cast("int"), F.lit(0)))
        .withColumn("_stretch", F.sum("_apart").over(across))
        .filter("_on")
        .groupBy(*keys, "_place", "_stretch")
        .agg(
            F.min("started_at").alias("started_at"),
            F.max("ended_at").alias("ended_at"),
            F.sum("samples").cast("bigint").alias("samples"),
        )
        .filter(length >= for_s * 1_000_000)
        .select(*keys, "started_at", "ended_at", "samples")
    )


def absent(
    samples: DataFrame, series: Sequence[str], start: str, end: str, every_s: int
) -> DataFrame:
    """Slots of ``every_s`` seconds in [start, end) in which a series has no sample.

    The expected slots are generated day by day from one row per series.
    """
    day = 86_400
    if day % every_s:
        raise ValueError("every_s must divide a day")
    keys = list(series)
    first, last = F.unix_seconds(F.lit(start).cast("timestamp")), F.unix_seconds(
        F.lit(end).cast("timestamp")
    )
    per_day = day // every_s
    days = F.sequence(F.floor(first / day), F.floor((last - 1) / day))
    slots = F.sequence(F.col("_day") * per_day, F.col("_day") * per_day + per_day - 1)
    in_range = (F.col("_slot") * every_s >= first) & (F.col("_slot") * every_s < last)
    expected = (
        samples.select(*keys)
        .distinct()
        .select(*keys, F.explode(days).alias("_day"))
        .select(*keys, F.explode(slots).alias("_slot"))
        .filter(in_range)
    )
    seen = samples.select(*keys, _slot(every_s).alias("_slot")).distinct()
    return expected.join(seen, [*keys, "_slot"], "left_anti").select(
        *keys, _slot_start(F.col("_slot"), every_s).alias("window_start")
    )


def ratio_below(
    left: DataFrame, right: DataFrame, on: Sequence[str], value: str, limit: float
) -> DataFrame:
    """Rows where left / right, matched on labels and window, is below the limit."""
    pairs = left.select(*on, F.col(value).alias("numerator")).join(
        right.select(*on, F.col(value).alias("denominator")), list(on)
    )
    ratio = F.col("numerator").cast("double") / F.nullif(
        F.col("denominator").cast("double"), F.lit(0.0)
    )
    return pairs.withColumn("ratio", ratio).filter(F.col("ratio") < limit)


def staleness(samples: DataFrame, series: Sequence[str], as_of: str) -> DataFrame:
    """Seconds since the last sample of each series."""
    now = F.unix_micros(F.lit(as_of).cast("timestamp"))
    last = samples.groupBy(*series).agg(F.max("ts").alias("last_ts"))
    return last.withColumn("idle_us", now - F.unix_micros("last_ts"))


def both(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Alerts of the left rule that the right rule raises as well."""
    return left.join(right.select(*on).distinct(), list(on), "left_semi")


def either(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """All alerts of the left rule, and those of the right rule with no left match."""
    return left.unionByName(right.join(left.select(*on).distinct(), list(on), "left_anti"))
