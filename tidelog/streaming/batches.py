"""Output of stream batches that a restart neither loses nor repeats.

Every batch has a folder of its own, which a second attempt overwrites, and counts once the log names it.
The log is written last, one small file per batch, so a reader sees whole batches only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidelog.sources.tables import existing

_LOG = "batch long, note string"


def drained(rows: DataFrame) -> None:
    """Run a batch without keeping it: the state of the stream moves on only where its rows are read."""
    rows.write.format("noop").mode("overwrite").save()


@dataclass(frozen=True)
class BatchLog:
    """Batches below a folder."""

    spark: SparkSession
    path: str

    def _log(self) -> DataFrame:
        found = existing(self.spark, f"{self.path}/log", _LOG)
        return self.spark.createDataFrame([], _LOG) if found is None else found

    def committed(self, batch_id: int) -> bool:
        return not self._log().where(F.col("batch") == batch_id).isEmpty()

    def note(self) -> str | None:
        """The note of the last committed batch."""
        last = self._log().agg(F.max_by("note", "batch").alias("note")).first()
        return last.note

    def write(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """Write the rows of a batch, over those of an earlier attempt, and read them back."""
        path = f"{self.path}/data/batch={batch_id}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def commit(self, batch_id: int, note: str | None = None) -> None:
        self.spark.createDataFrame([(batch_id, note)], _LOG).coalesce(1).write.mode("append").parquet(f"{self.path}/log")

    def take(self, rows: DataFrame, batch_id: int) -> None:
        """Write and commit a batch unless the log has it; for ``foreachBatch``."""
        if self.committed(batch_id):
            return drained(rows)
        self.write(rows, batch_id)
        self.commit(batch_id)

    def read(self, schema: StructType) -> DataFrame:
        """Rows of the committed batches."""
        if existing(self.spark, f"{self.path}/log", _LOG) is None:
            return self.spark.createDataFrame([], schema)
        names = schema.fieldNames()
        rows = self.spark.read.schema(StructType([*schema.fields]).add("batch", "long")).parquet(f"{self.path}/data")
        # One number per batch.
        return rows.join(F.broadcast(self._log().select("batch")), "batch", "left_semi").select(*names)
