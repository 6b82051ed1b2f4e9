"""Running streams: Bronze append and the revenue windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidelog.operators.envelope import parse_envelope, topic_values
from tidelog.session import configure
from tidelog.sources.topics import Topic, message_stream, stream_records, to_messages
from tidelog.streaming.windows import order_revenue

# Interval between checkpoints of a stream that runs all day.
TRIGGER = "60 seconds"


def start_append(
    rows: DataFrame, path: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Append a stream to a Parquet folder. The checkpoint makes a restart skip what is landed."""
    writer = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
    )
    trigger = {"availableNow": True} if once else {"processingTime": TRIGGER}
    return writer.trigger(**trigger).start()


def start_bronze(
    spark: SparkSession,
    topic: Topic,
    path: str,
    checkpoint: str,
    run_ts: str | None = None,
    once: bool = True,
) -> StreamingQuery:
    rows = parse_envelope(topic_values(stream_records(spark, topic)), run_ts)
    return start_append(rows, path, checkpoint, once)


def start_order_revenue(
    spark: SparkSession,
    source: Topic,
    sink: Topic,
    checkpoint: str,
    per_trigger: int | None = None,
    once: bool = True,
) -> StreamingQuery:
    """Order changes in, one JSON message per closed window out; state in RocksDB.

    The number of state partitions is ``spark.sql.shuffle.partitions`` at the first start of a
    checkpoint and holds for its life.
    """
    configure(spark)
    bronze = parse_envelope(topic_values(stream_records(spark, source, per_trigger)))
    messages = to_messages(order_revenue(bronze), "window_start", sink.name)
    trigger = {"availableNow": True} if once else {"processingTime": TRIGGER}
    return message_stream(messages, sink, checkpoint).trigger(**trigger).start()
