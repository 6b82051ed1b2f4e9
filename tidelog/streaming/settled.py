"""Revenue windows that late changes still correct.

The window stream (``windows.order_revenue``) is quick and final: what comes behind its watermark is dropped. This
second lane keeps the sums of every window in a hashed table and takes in signed changes of any age. A window is
emitted when the lane's own watermark passes its end, and again, with a higher revision, whenever a later
change alters it. The last revision of a window is its settled result; one that nothing is left in is emitted with no orders.

The last accepted image of every entity is a hashed table as well (``images``), merged once for each batch: the signed
changes are those of its new version. So a batch is a few joins, not one call for each entity. With ``ttl_days`` the
images are state of the stream instead (``keyed``), which can forget entities.

Batches are taken in exactly once. The changes of a batch land in a folder of the batch, the sums remember the batch
that they have, and the ledger names a batch after its emissions are written. A batch that comes again after a crash
goes on where it broke off, or does nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog import rules, schemas
from tidelog.functions.columns import average, money
from tidelog.operators.changelog import VERSION_ORDER, latest_per_key
from tidelog.operators.envelope import accepted, parse_envelope, topic_values, upserts
from tidelog.session import configure
from tidelog.sources.hashed import ROWS, HashedTable, added
from tidelog.sources.topics import Topic, stream_records
from tidelog.streaming.batches import BatchLog, drained
from tidelog.streaming.jobs import TRIGGER
from tidelog.streaming.keyed import accepted_changes


def shaped_windows(sums: DataFrame, size: str) -> DataFrame:
    """Window sums in the columns of emitted windows; windows without orders have neither sum nor mean."""
    some = F.col("orders") != 0
    return sums.select(
        "window_start",
        (F.col("window_start") + F.expr(f"INTERVAL {size}")).alias("window_end"),
        F.col("orders").alias("order_count"),
        money(F.when(some, F.col("revenue")), 14).alias("total_revenue"),
        average(F.when(some, F.col("revenue")), F.when(some, F.col("orders")), 12).alias("avg_order_value"),
    )


@dataclass(frozen=True)
class SettledWindows:
    """The lane below a folder."""

    spark: SparkSession
    root: str
    size: str = rules.WINDOW_SIZE
    delay: str = rules.WATERMARK_DELAY
    rows: int = ROWS

    @property
    def sums(self) -> HashedTable:
        return HashedTable(self.spark, f"{self.root}/sums", schemas.WINDOW_SUMS, ("window_start",), self.rows)

    @property
    def images(self) -> HashedTable:
        return HashedTable(self.spark, f"{self.root}/images", schemas.image_schema(schemas.ORDERS), (schemas.ORDERS.key,), self.rows)

    @property
    def log(self) -> BatchLog:
        return BatchLog(self.spark, f"{self.root}/batches")

    @property
    def signed(self) -> BatchLog:
        return BatchLog(self.spark, f"{self.root}/signed")

    def take_changes(self, changes: DataFrame, batch_id: int) -> None:
        """Take in the accepted order changes of a batch, in any order and repeated or not; for ``foreachBatch``."""
        if self.log.committed(batch_id):
            return
        images = self.images
        if images.directory().run != str(batch_id):
            newest = latest_per_key(changes.select(*images.schema.fieldNames()), list(images.key), VERSION_ORDER)
            landed = BatchLog(self.spark, f"{self.root}/newest").write(newest, batch_id)
            images.merge(landed, images.newest(VERSION_ORDER), str(batch_id))
        signed = images.changes(images.version()).where(upserts()).where("updated_at is not null")
        self.take(signed, batch_id)

    def take(self, signed: DataFrame, batch_id: int) -> None:
        """Take in the signed changes of a batch; for ``foreachBatch``."""
        if self.log.committed(batch_id):
            return drained(signed)
        changes = self.signed.write(signed.select("sign", "updated_at", "total_amount"), batch_id)
        if self.sums.directory().run != str(batch_id):
            start = F.window("updated_at", self.size)["start"]
            sums = changes.groupBy(start.alias("window_start")).agg(
                F.sum("sign").cast("bigint").alias("orders"),
                F.sum(F.col("sign") * F.coalesce("total_amount", F.lit(0))).cast("decimal(38,2)").alias("revenue"),
            )
            landed = BatchLog(self.spark, f"{self.root}/changes").write(sums, batch_id)
            self.sums.merge(landed, added(("orders", "revenue"), ("window_start",)), str(batch_id))
        before = self.log.note()
        newest = F.unix_micros(F.max("updated_at") - F.expr(f"INTERVAL {self.delay}"))
        seen = changes.where("sign = 1").agg(newest).first()[0]
        passed = max((t for t in (before and int(before), seen) if t is not None), default=None)
        self.log.write(self._emitted(before, passed, batch_id), batch_id)
        self.log.commit(batch_id, None if passed is None else str(passed))

    def _emitted(self, before: str | None, passed: int | None, batch_id: int) -> DataFrame:
        """Windows behind the new watermark (microseconds) that this batch altered, or that it has passed just now."""
        changed = self.sums.changes(self.sums.version()).where("sign = 1").drop("sign")
        if passed is None:
            rows = changed.limit(0)
        else:
            size = F.expr(f"INTERVAL {self.size}")
            upto = F.col("window_start") <= F.timestamp_micros(F.lit(passed)) - size
            closing = upto
            if before is not None:
                closing = upto & (F.col("window_start") > F.timestamp_micros(F.lit(int(before))) - size)
            # Bounds of the start times are pushed down, so windows of long ago are not read again.
            rows = self.sums.state().where(closing).unionByName(changed.where(upto)).dropDuplicates(["window_start"])
        return shaped_windows(rows, self.size).withColumn("revision", F.lit(batch_id + 1).cast("bigint"))

    def emissions(self) -> DataFrame:
        """Everything emitted so far: the columns of a window, and its revision."""
        schema = schemas.with_column(schemas.REVENUE_WINDOW, "revision", "long")
        return self.log.read(schema)

    def settled(self) -> DataFrame:
        """The last revision of every window behind the watermark that has orders."""
        from tidelog.operators.serving import latest_emissions

        return latest_emissions(self.emissions(), "revision").where("order_count > 0").drop("revision")


def start_settled_windows(
    spark: SparkSession,
    source: Topic,
    lane: SettledWindows,
    checkpoint: str,
    per_trigger: int | None = None,
    once: bool = True,
    ttl_days: int | None = None,
) -> StreamingQuery:
    """Order changes in, corrected windows out."""
    configure(spark)
    bronze = parse_envelope(topic_values(stream_records(spark, source, per_trigger)))
    if ttl_days is None:
        writer = accepted(bronze, schemas.ORDERS).writeStream.foreachBatch(lane.take_changes).outputMode("append")
    else:
        changes = accepted_changes(bronze, schemas.ORDERS, ttl_days).where("updated_at is not null")
        writer = changes.writeStream.foreachBatch(lane.take).outputMode("update")
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(**({"availableNow": True} if once else {"processingTime": TRIGGER})).start()
