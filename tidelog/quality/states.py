"""Suites over tables that grow: what a suite needs of a part is kept, and a new part is the only one scanned.

Row rules keep counts and extremes per part, which add up. Uniqueness keeps how often each value occurs, in a
hashed table by two hashes of the value, and the numbers that follow from it; a part reads and writes the
buckets of its own values. A part has a number and is taken in once, also when it comes again after a crash.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog import schemas
from tidelog.quality.expectations import (
    KEY_NUMBERS,
    Expectation,
    key_counts,
    key_numbers,
    key_verdicts,
    measures,
    split_rules,
    verdicts,
)
from tidelog.sources.hashed import ROWS, HashedTable, added
from tidelog.streaming.batches import BatchLog

#: A second hash that tells values apart which share the first.
_SECOND = "the other half"


@dataclass(frozen=True)
class SuiteState:
    """The state of one suite below a folder."""

    spark: SparkSession
    root: str
    name: str
    rules: tuple[Expectation, ...]
    rows: int = ROWS

    @property
    def parts(self) -> BatchLog:
        return BatchLog(self.spark, f"{self.root}/measures")

    def _counts(self, key: Sequence[str]) -> HashedTable:
        return HashedTable(self.spark, f"{self.root}/counts-{'-'.join(key)}", schemas.VALUE_COUNTS, ("first", "second"), self.rows)

    def _numbers(self, key: Sequence[str]) -> BatchLog:
        return BatchLog(self.spark, f"{self.root}/numbers-{'-'.join(key)}")

    def append(self, part: DataFrame, number: int) -> None:
        """Take in a part of the table; numbers start anywhere and grow."""
        if self.parts.committed(number):
            return
        scanned, keys = split_rules(self.rules)
        for key in keys:
            table, numbers = self._counts(key), self._numbers(key)
            if numbers.committed(number):
                continue
            if table.directory().run != str(number):
                hashes = [F.xxhash64(*key).alias("first"), F.xxhash64(F.lit(_SECOND), *key).alias("second")]
                counted = key_counts(part, tuple(key)).select(*hashes, F.col("_n").alias("n"))
                landed = BatchLog(self.spark, f"{self.root}/parts-{'-'.join(key)}").write(counted, number)
                table.merge(landed, added(("n",), ("first", "second")), str(number))
            changed = table.changes(table.version()).withColumnRenamed("n", "_n")
            numbers.write(key_numbers(changed, F.col("sign")), number)
            numbers.commit(number)
        measured = part.agg(*[value.alias(name) for name, (value, _) in measures(scanned).items()])
        self.parts.write(measured.withColumn("columns", F.array(*map(F.lit, part.columns))), number)
        self.parts.commit(number)

    def results(self) -> DataFrame:
        """One row per expectation for all parts taken in, as ``evaluate`` gives it for the whole table."""
        scanned, keys = split_rules(self.rules)
        held = self.spark.read.parquet(f"{self.parts.path}/data")
        schema = held.drop("batch").schema
        measured = self.parts.read(schema)
        # The columns of the table are those that all parts share.
        names = [row[0] for row in measured.select("columns").distinct().collect()]  # one list per schema there ever was
        whole = measured.agg(*[merge(name).alias(name) for name, (_, merge) in measures(scanned).items()])
        found = [verdicts(whole, scanned, names[0] if len(names) == 1 else ())] if scanned else []
        for key, same in keys.items():
            numbers = self._numbers(key).read(schemas.KEY_NUMBERS)
            total = numbers.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in KEY_NUMBERS])
            found.append(key_verdicts(total, same))
        return reduce(DataFrame.unionByName, found).select(F.lit(self.name).alias("suite"), "*")
