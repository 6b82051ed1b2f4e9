"""Keyed state tables in hash buckets that grow with the table (linear hashing).

A table of n buckets, 2^L <= n < 2^(L+1), puts a key into the bucket of its hash modulo 2^(L+1), or, where that bucket
does not exist yet, modulo 2^L. Growing by one bucket moves rows out of exactly one other. So a merge reads
and writes the buckets of the changed keys and those that split, and no others; buckets keep about ``rows`` rows at
every size of the table.

Each merge makes a version. It writes its buckets to a folder of its own and then the directory, one file
that names for every bucket the version whose folder holds it. That file makes the version visible at once;
a merge that died before leaves the table as it was, and older versions stay readable. Rows remember which
version changed them last and what they were before, so the changes of a version are read from its own buckets.
One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from tidelog.operators.changelog import latest_per_key
from tidelog.session import SCRATCH, setting
from tidelog.sources.tables import existing

ROWS = 1_000_000
#: Changes per key from which, in any bucket, the last ones are chosen before all are moved to their buckets.
MANY = 2
_DIRECTORY = "version long, run string, buckets long, bucket long, home long, rows long"

#: What becomes of a row: the old row (NULL if there is none) and the change, as structs.
Resolve = Callable[[Column, Column], Column]


def added(names: tuple[str, ...], key: tuple[str, ...]) -> Resolve:
    """Sums plus their changes."""

    def resolve(old: Column, new: Column) -> Column:
        kept = [F.coalesce(new[k], old[k]).alias(k) for k in key]
        return F.struct(*kept, *[(F.coalesce(old[n], F.lit(0)) + F.coalesce(new[n], F.lit(0))).alias(n) for n in names])

    return resolve


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """Number of a key's bucket in a table of so many buckets."""
    low = 1 << (buckets.bit_length() - 1)
    h = F.pmod(F.xxhash64(*keys), F.lit(2 * low))
    return F.when(h < buckets, h).otherwise(h - low)


def source_of(bucket: int, buckets: int) -> int:
    """The bucket, among the first ``buckets``, that a later bucket splits off from."""
    while bucket >= buckets:
        bucket -= 1 << (bucket.bit_length() - 1)
    return bucket


@dataclass(frozen=True)
class Directory:
    """One version of a table: the run that made it, and for each bucket its home version and rows."""

    version: int = 0
    run: str | None = None
    buckets: int = 1
    homes: dict[int, tuple[int, int]] = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return sum(rows for _, rows in self.homes.values())


@dataclass(frozen=True)
class HashedTable:
    """The table at a path, with the schema of its rows and its key columns (NULL keys are equal)."""

    spark: SparkSession
    path: str
    schema: StructType
    key: tuple[str, ...]
    rows: int = ROWS

    def directory(self, version: int | None = None) -> Directory:
        """A version of the directory (a row per bucket), the last one if none is named; version 0 is empty."""
        entries = existing(self.spark, f"{self.path}/directory", _DIRECTORY)
        if entries is None or version == 0:
            return Directory()
        wanted = entries.agg(F.max("version").alias("version")) if version is None else entries.where(F.col("version") == version).select("version").distinct()
        rows = entries.join(F.broadcast(wanted), "version").collect()  # one number on the broadcast side
        if not rows:
            raise ValueError(f"{self.path} has no version {version}")
        return Directory(rows[0].version, rows[0].run, rows[0].buckets, {r.bucket: (r.home, r.rows) for r in rows})

    def version(self) -> int:
        return self.directory().version

    def _stored(self) -> StructType:
        stored = StructType(list(self.schema.fields))
        return stored.add("_before", self.schema).add("_changed", "long").add("version", "long").add("bucket", "long")

    def _read(self, directory: Directory, buckets: Sequence[int] | None = None) -> DataFrame:
        """Stored rows of a version, of some buckets only; folders and buckets are pruned before anything is read."""
        wanted: dict[int, list[int]] = {}
        for b in directory.homes if buckets is None else buckets:
            if directory.homes.get(b, (0, 0))[1]:
                wanted.setdefault(directory.homes[b][0], []).append(b)
        if not wanted:
            return self.spark.createDataFrame([], self._stored())
        data = f"{self.path}/data"
        rows = self.spark.read.schema(self._stored()).option("basePath", data).parquet(*[f"{data}/version={v}" for v in sorted(wanted)])
        here = [(F.col("version") == v) & F.col("bucket").isin(sorted(b)) for v, b in wanted.items()]
        return rows.where(reduce(Column.__or__, here))

    def state(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the last one if none is named."""
        return self._read(self.directory(version)).select(*self.schema.fieldNames())

    def changes(self, version: int) -> DataFrame:
        """``sign`` and the rows that a version took back (-1) and put in (1)."""
        directory = self.directory(version)
        own = [b for b, (home, _) in directory.homes.items() if home == version]
        changed = self._read(directory, own).where(F.col("_changed") == version)
        after = F.struct(*self.schema.fieldNames())
        sides = F.array(F.struct(F.lit(-1).alias("sign"), F.col("_before").alias("row")), F.struct(F.lit(1).alias("sign"), after.alias("row")))
        return changed.select(F.inline(sides)).where("row is not null").select("sign", "row.*")

    def newest(self, order: Sequence[str]) -> Resolve:
        """The row with the higher order; the old one stays where both are equal."""

        def resolve(old: Column, new: Column) -> Column:
            later = F.struct(*[new[c] for c in order]) > F.struct(*[old[c] for c in order])
            # Whole rows are compared and chosen once, not field by field.
            given = F.struct(*[new[f.name].cast(f.dataType).alias(f.name) for f in self.schema])
            return F.when(old.isNull() | later, given).otherwise(old)

        return resolve

    def merge(self, changes: DataFrame, resolve: Resolve, run: str | None = None, order: Sequence[str] = ()) -> int:
        """Make the next version from one change per key and return its number.

        ``resolve`` gives the new row from the old one and the change. Hand in changes that are cheap
        to read again: they are read twice. With ``order`` a key may have several, of which the highest counts. Where keys
        have few, all go to their buckets at once, and the last ones are chosen there; where a key has many, every task is
        cut to one row per key first, so that no bucket gets them all.
        """
        before = self.directory()
        version = before.version + 1
        distinct = F.approx_count_distinct(F.xxhash64(*self.key)) if order else F.count(F.lit(1))
        counts = (F.count(F.lit(1)).alias("n"), distinct.alias("keys"))
        hit = changes.groupBy(bucket_of(self.key, before.buckets).alias("b")).agg(*counts).collect()
        if any(r.n > MANY * r["keys"] for r in hit):
            changes, order = latest_per_key(changes, self.key, order), ()
            added = sum(min(r.n, r["keys"]) for r in hit)
        else:
            added = sum(r.n for r in hit)
        buckets = max(before.buckets, -(-(before.rows + added) // self.rows))
        touched = {r.b for r in hit} | {source_of(b, before.buckets) for b in range(before.buckets, buckets)}
        rewritten = [b for b in range(buckets) if source_of(b, before.buckets) in touched]
        if rewritten:
            # Both sides are spread by bucket alone, which joins and writes without another shuffle.
            with setting(self.spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"):
                self._write(self._rebuilt(before, version, sorted(touched), changes, resolve, buckets, len(rewritten), order), version)
            sizes = self._read(Directory(version, homes={b: (version, 1) for b in rewritten})).groupBy("bucket").count()
            sizes = {r.bucket: r["count"] for r in sizes.collect()}
        homes = {**before.homes, **{b: (version, sizes.get(b, 0)) for b in rewritten}} if rewritten else before.homes
        entries = [(version, run, buckets, b, home, rows) for b, (home, rows) in homes.items()]
        entries = entries or [(version, run, buckets, 0, 0, 0)]
        self.spark.createDataFrame(entries, _DIRECTORY).coalesce(1).write.mode("append").parquet(f"{self.path}/directory")
        return version

    def _write(self, rows: DataFrame, version: int) -> None:
        rows.write.options(**SCRATCH).mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/data/version={version}")

    def _rebuilt(self, before: Directory, version: int, touched: list[int], changes: DataFrame, resolve: Resolve, buckets: int, tasks: int, order: Sequence[str] = ()) -> DataFrame:
        """Rows of the touched buckets after the changes, in their buckets of the new version."""
        names = self.schema.fieldNames()
        home = bucket_of(self.key, buckets).alias("bucket")

        def spread(rows: DataFrame, side: str, *more: Column) -> DataFrame:
            whole = F.struct(*rows.columns).alias(f"_{side}")
            return rows.select(home.alias(f"_{side}_bucket"), whole, *more).repartition(tasks, f"_{side}_bucket")

        stored = self._read(before, touched)
        old = spread(stored.select(*names, "_changed"), "old").withColumn("_was", F.col("_old._changed"))
        old = old.withColumn("_old", F.col("_old").dropFields("_changed"))
        new = spread(changes, "new")
        if order:
            newest = Window.partitionBy("_new_bucket", *[f"_new.{k}" for k in self.key]).orderBy(*[F.desc(f"_new.{c}") for c in order])
            new = new.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")
        same = reduce(Column.__and__, [F.col(f"_old.{k}").eqNullSafe(F.col(f"_new.{k}")) for k in self.key])
        joined = old.join(new, (F.col("_old_bucket") == F.col("_new_bucket")) & same, "full_outer")
        # Absent sides are NULL structs, also where all keys of a present one are NULL.
        gone, fresh = F.col("_old_bucket").isNull(), F.col("_new_bucket").isNotNull()
        was = F.when(~gone, F.col("_old"))
        made = F.struct(*[F.col("_made")[f.name].cast(f.dataType).alias(f.name) for f in self.schema])
        changed = fresh & ~(F.col("_row").eqNullSafe(was))
        rows = joined.withColumn("_made", F.when(fresh, resolve(was, F.col("_new")))).withColumn("_row", F.when(fresh, made).otherwise(was))
        return rows.select(
            "_row.*",
            F.when(changed, was).alias("_before"),
            F.when(changed, F.lit(version)).otherwise(F.col("_was")).cast("long").alias("_changed"),
            F.coalesce("_old_bucket", "_new_bucket").alias("bucket"),
        )
