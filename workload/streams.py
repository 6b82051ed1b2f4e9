"""Streams over topics that are first written as record files, one slice of days at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog import schemas
from tidelog.functions.columns import money
from tidelog.operators.envelope import bronze_events
from tidelog.session import new_folder, setting
from tidelog.sources.topics import Topic, from_messages, read_records, stream_records
from tidelog.streaming.jobs import start_append, start_bronze, start_order_revenue
from tidelog.streaming.settled import SettledWindows, start_settled_windows
from tidelog.streaming.windows import tumbling_revenue
from workload import logs
from workload.domain import RUN_TS, table

SLICES = 2


def slices(records: DataFrame) -> list[DataFrame]:
    """The records, landed once and cut at day boundaries into a few parts, oldest first.

    Spark compares rows with the watermark of earlier batches, so a part must not hold rows from
    before the end of the part that went in first.
    """
    spark = records.sparkSession
    landed = new_folder(spark, "landed")
    records.write.parquet(landed)
    records = spark.read.parquet(landed)
    day = F.to_date("timestamp")
    low, high = records.agg(F.min(day), F.max(day)).first()
    step = (high - low) / SLICES
    cuts = [low + step * n for n in range(1, SLICES)]
    bounds = [None, *cuts, None]
    parts = []
    for start, end in zip(bounds, bounds[1:]):
        part = records
        if start is not None:
            part = part.filter(day >= F.lit(start))
        if end is not None:
            part = part.filter(day < F.lit(end))
        parts.append(part)
    return parts


def _feed(spark: SparkSession, parts: list[DataFrame], path: str, run) -> None:
    """Write each part and let the stream, restarted from its checkpoint, read what is new.

    One state partition per core: the number is fixed for the life of a checkpoint.
    """
    cores = str(spark.sparkContext.defaultParallelism)
    for part in parts:
        part.write.mode("append").parquet(path)
        with setting(spark, "spark.sql.shuffle.partitions", cores):
            run().awaitTermination()


def stream_order_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_folder(spark, "order-revenue")
    source = Topic("cdc.orders", path=f"{root}/in")
    sink = Topic("gold.order-revenue-1m", path=f"{root}/out")
    _feed(
        spark,
        slices(logs.order_records(spark, sf_dir)),
        source.path,
        lambda: start_order_revenue(spark, source, sink, f"{root}/checkpoint"),
    )
    messages = spark.read.parquet(sink.path)
    return from_messages(messages, schemas.REVENUE_WINDOW)


def stream_order_revenue_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of the settled lane; a part of the older orders arrives after all others."""
    root = new_folder(spark, "late")
    source = Topic("cdc.orders", path=f"{root}/in")
    lane = SettledWindows(spark, f"{root}/lane", rows=50_000)
    early, recent = slices(logs.order_records(spark, sf_dir))
    withheld = F.col("offset") % 136 >= 104  # the orders whose number leaves 13 to 16 when divided by 17
    _feed(
        spark,
        [early.where(~withheld), recent, early.where(withheld)],
        source.path,
        lambda: start_settled_windows(spark, source, lane, f"{root}/checkpoint"),
    )
    return lane.settled()


def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_folder(spark, "tumbling")
    records = logs.event_amount_records(spark, sf_dir)
    topic = Topic("raw.events", path=f"{root}/in")

    def run():
        rows = stream_records(spark, topic).select(
            F.col("timestamp").alias("ts"),
            money(F.col("value").cast("string").try_cast("decimal(18,2)"), 12).alias("amount"),
        )
        windows = tumbling_revenue(rows.withWatermark("ts", "5 seconds"), "ts", "amount")
        return start_append(windows, f"{root}/out", f"{root}/checkpoint")

    _feed(spark, slices(records), topic.path, run)
    return spark.read.parquet(f"{root}/out")


def stream_bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_folder(spark, "events")
    topic = Topic("raw.events", path=f"{root}/in")

    def run():
        rows = bronze_events(stream_records(spark, topic), RUN_TS)
        return start_append(rows, f"{root}/out", f"{root}/checkpoint")

    _feed(spark, slices(logs.event_records(spark, sf_dir)), topic.path, run)
    return spark.read.parquet(f"{root}/out")


def stream_bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_folder(spark, "cdc-orders")
    topic = Topic("cdc.orders", path=f"{root}/in")
    _feed(
        spark,
        slices(logs.order_records(spark, sf_dir)),
        topic.path,
        lambda: start_bronze(spark, topic, f"{root}/out", f"{root}/checkpoint", RUN_TS),
    )
    return spark.read.parquet(f"{root}/out")


def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-minute windows over the event table, as a batch."""
    rows = table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), money(F.col("value"), 12).alias("amount")
    )
    return tumbling_revenue(rows, "ts", "amount")


def landed_records(spark: SparkSession, records: DataFrame, name: str) -> DataFrame:
    """Records written to a topic folder and read back as a bounded snapshot."""
    topic = Topic(name, path=new_folder(spark, "topic"))
    records.write.parquet(topic.path)
    return read_records(spark, topic)
