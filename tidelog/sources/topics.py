"""Topics: a Kafka topic where the connector is installed, or a folder of record files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from tidelog import schemas


@dataclass(frozen=True)
class Topic:
    """``servers`` names the Kafka brokers; ``path`` a Parquet folder with the same columns.

    ``data_loss``: what a Kafka read does about offsets that the broker no longer holds: "fail", or
    "ignore" to go on without them.
    """

    name: str
    servers: str | None = None
    path: str | None = None
    data_loss: str = "fail"

    def __post_init__(self) -> None:
        if self.data_loss not in ("fail", "ignore"):
            raise ValueError("data_loss must be 'fail' or 'ignore'")
        if (self.servers is None) == (self.path is None):
            raise ValueError("give either servers or path")

    @property
    def ordered(self) -> bool:
        """Whether a snapshot holds each partition as one run of offsets without repeats."""
        return self.servers is not None

    def kafka_options(self) -> dict[str, str]:
        return {
            "kafka.bootstrap.servers": self.servers or "",
            "subscribe": self.name,
            "startingOffsets": "earliest",
            "failOnDataLoss": str(self.data_loss == "fail").lower(),
        }


def read_records(spark: SparkSession, topic: Topic) -> DataFrame:
    """Bounded snapshot: every record from the earliest to the latest offset at the start."""
    if topic.path:
        files = spark.read.schema(schemas.TOPIC_RECORD).parquet(topic.path)
        return files.filter(F.col("topic") == topic.name)
    options = {**topic.kafka_options(), "endingOffsets": "latest"}
    return spark.read.format("kafka").options(**options).load()


def stream_records(
    spark: SparkSession, topic: Topic, per_trigger: int | None = None
) -> DataFrame:
    """The same records as a stream. ``per_trigger`` limits offsets, or files for a folder."""
    if topic.path:
        reader = spark.readStream.schema(schemas.TOPIC_RECORD)
        if per_trigger:
            reader = reader.option("maxFilesPerTrigger", per_trigger)
        return reader.parquet(topic.path).filter(F.col("topic") == topic.name)
    reader = spark.readStream.format("kafka").options(**topic.kafka_options())
    if per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    return reader.load()


def to_messages(df: DataFrame, key: str, topic: str) -> DataFrame:
    """One JSON message per row, keyed by a column so that a key stays in one partition."""
    return df.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*df.columns)).alias("value"),
        F.lit(topic).alias("topic"),
    )


def from_messages(records: DataFrame, schema: StructType) -> DataFrame:
    """Rows of a JSON topic, with the record's partition and offset when it has them."""
    identity = [c for c in ("partition", "offset") if c in records.columns]
    return records.select(
        F.from_json(F.col("value").cast("string"), schema).alias("_row"), *identity
    ).select("_row.*", *identity)


def write_messages(messages: DataFrame, topic: Topic) -> None:
    if topic.path:
        messages.write.mode("append").parquet(topic.path)
    else:
        messages.write.format("kafka").option("kafka.bootstrap.servers", topic.servers).save()


def message_stream(messages: DataFrame, topic: Topic, checkpoint: str) -> DataStreamWriter:
    """Writer for a message stream; the folder form commits each batch exactly once."""
    writer = messages.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if topic.path:
        return writer.format("parquet").option("path", topic.path)
    return writer.format("kafka").option("kafka.bootstrap.servers", topic.servers)
