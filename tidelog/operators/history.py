"""History of keyed entities: how long each version was valid, and which one was at a time.

Versions are ordered by key and version over all tasks at once, so that a key with very many versions spans
tasks. What a row needs of its neighbours comes from its own task; only one row per task looks into the next or the one
before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog import rules, schemas
from tidelog.operators.changelog import VERSION_ORDER
from tidelog.operators.envelope import IDENTITY, accepted
from tidelog.session import new_folder

#: Rows that one task of an ordered pass holds.
RANGE = 1_000_000


def _ordered(rows: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Rows in one order over numbered ranges: ``_range``, and ``_at``, which ascends within and across ranges.

    Rows land first: counting them, finding the bounds of the ranges and moving them each read all of them.
    """
    spark, path = rows.sparkSession, new_folder(rows.sparkSession, "ordered")
    rows = _landed(rows, "unordered")
    ranges = max(1, -(-rows.count() // RANGE))
    placed = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    # The range in the upper bits and the place in it below; written once, so that later reads agree.
    placed.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    written = spark.read.schema(placed.schema.add("_at", "long")).parquet(path)
    return written.withColumn("_range", F.shiftright("_at", 33))


def _landed(rows: DataFrame, name: str) -> DataFrame:
    """Rows written once, so that what reads them again does not work them out again."""
    path = new_folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def accepted_versions(bronze: DataFrame, entity: schemas.Entity) -> DataFrame:
    """Accepted changes without records that came again: image fields, op and the version order."""
    identity = [c for c in IDENTITY if c in bronze.columns]
    rows = accepted(bronze, entity)
    rows = rows.dropDuplicates(identity) if identity else rows
    return rows.select(*[name for name, _ in entity.fields], "op", *VERSION_ORDER)


def history(versions: DataFrame, key: str, order: Sequence[str] = VERSION_ORDER) -> DataFrame:
    """Versions with ``valid_from`` and ``valid_to``, from the first order column; the last one has no end.

    The interval holds its start and not its end. Versions that a later one of the same time replaces have an empty interval.
    """
    rows = _ordered(versions, [key, *order])
    inside = Window.partitionBy("_range").orderBy("_at")  # RANGE rows, whatever the keys
    after = F.struct(F.col(key).alias("key"), F.col(order[0]).alias("at"))
    heads = rows.groupBy("_range").agg(F.min_by(after, "_at").alias("_head"))  # a row per range
    next_heads = _landed(heads.select(F.lag("_range").over(Window.orderBy("_range")).alias("_range"), "_head"), "ranges")
    joined = rows.withColumn("_next", F.lead(after).over(inside)).join(F.broadcast(next_heads), "_range", "left")
    following = F.coalesce("_next", "_head")
    valid_to = F.when(following["key"] == F.col(key), following["at"])
    return joined.select(*versions.columns, F.col(order[0]).alias("valid_from"), valid_to.alias("valid_to"))


def states_at(intervals: DataFrame, times: Sequence[int]) -> DataFrame:
    """Live entities at each of some times, in one pass over their history: ``as_of`` and the columns of the version."""
    begun = lambda t: F.col("valid_from") <= t
    held = F.filter(F.array(*[F.lit(t).cast("bigint") for t in times]), lambda t: begun(t) & (F.col("valid_to").isNull() | (F.col("valid_to") > t)))
    return intervals.where(F.col("op") != rules.DELETE_OP).select(F.explode(held).alias("as_of"), *[c for c in intervals.columns if c not in ("valid_from", "valid_to")])


def as_of_join(facts: DataFrame, versions: DataFrame, key: str, time: str, order: Sequence[str] = VERSION_ORDER) -> DataFrame:
    """Facts with ``version``, the version of their key that was valid at their time; NULL before the first one.

    Facts and versions go through one ordering, in which a version stands before the facts of its time. Facts
    with a NULL key or time have no version.
    """
    names = [c for c in versions.columns if c != key]
    facts = facts.withColumn("_known", F.col(key).isNotNull() & F.col(time).isNotNull())
    sides = [
        versions.select(F.col(key), F.col(order[0]).alias("_t"), F.lit(0).alias("_side"), F.struct(*order[1:]).alias("_tie"), F.struct(*names).alias("_version"), F.lit(None).alias("_fact")),
        facts.where("_known").select(F.col(key), F.col(time).alias("_t"), F.lit(1).alias("_side"), F.lit(None).alias("_tie"), F.lit(None).alias("_version"), F.struct(*facts.drop("_known").columns).alias("_fact")),
    ]
    rows = _ordered(sides[0].unionByName(sides[1]), [key, "_t", "_side", "_tie"])
    own = F.when(F.col("_side") == 0, F.struct(F.col(key).alias("key"), F.col("_version").alias("version")))
    inside = Window.partitionBy("_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_own", own)
    tails = rows.where("_side = 0").groupBy("_range").agg(F.max_by("_own", "_at").alias("_tail"))  # a row per range
    every = rows.select("_range").distinct().join(tails, "_range", "left")
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = _landed(every.select("_range", F.last("_tail", ignorenulls=True).over(earlier).alias("_carried")), "ranges")
    last = F.coalesce(F.last("_own", ignorenulls=True).over(inside), F.col("_carried"))
    joined = rows.join(F.broadcast(carried), "_range", "left").withColumn("_last", last).where("_side = 1")
    found = joined.select("_fact.*", F.when(F.col("_last.key") == F.col(key), F.col("_last.version")).alias("version"))
    unknown = facts.where("not _known").drop("_known").withColumn("version", F.lit(None).cast(found.schema["version"].dataType))
    return found.unionByName(unknown)
