"""Small column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(value: Column, precision: int = 18) -> Column:
    """Amount with two decimals; every aggregate over money ends with this one cast."""
    return value.cast(f"decimal({precision},2)")


def average(total: Column, count: Column, precision: int = 18) -> Column:
    """Total by count with two decimals, rounded half up once.

    The total is narrowed first: Spark then divides with 22 digits, so the last cast rounds the
    exact quotient. Dividing a wide sum would already have rounded to six digits.
    """
    return money(money(total) / count, precision)


def record_id(topic: Column, partition: Column, offset: Column) -> Column:
    """Stable id of a topic record in UUID form, the same on every run and retry."""
    digest = F.md5(F.concat_ws(":", topic, partition.cast("string"), offset.cast("string")))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(digest, start, length) for start, length in cuts])


def run_time(run_ts: str | None) -> Column:
    """Given run timestamp, or the start of the query when none is given."""
    return F.lit(run_ts).cast("timestamp") if run_ts else F.current_timestamp()


def typed_null(spark_type: str) -> Column:
    return F.lit(None).cast(spark_type)
