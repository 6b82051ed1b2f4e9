"""State and history of keyed entities in a change log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelog import rules, schemas
from tidelog.operators.envelope import IDENTITY, accepted, image_texts, typed_fields, upserts

# Highest wins. Offsets decide ties of the commit time inside one transaction.
VERSION_ORDER = ("ts_ms", "txn_id", "offset")

# Records per step of the ordered scan; offsets are unique in a partition, so a step is bounded.
OFFSETS_PER_CHUNK = 1 << 20


def latest_per_key(
    df: DataFrame, key: str | Sequence[str], order: str | Sequence[str]
) -> DataFrame:
    """The row with the highest ``order`` per key (last write wins).

    Spark cuts each task to one row per key before the shuffle (WindowGroupLimit), so a key with
    very many versions stays cheap. NULL orders lose.
    """
    keys = [key] if isinstance(key, str) else list(key)
    orders = [order] if isinstance(order, str) else list(order)
    newest = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in orders])
    return df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def current_state(
    bronze: DataFrame,
    entity: schemas.Entity,
    deletes: str = "apply",
    as_of_ms: int | None = None,
) -> DataFrame:
    """Latest accepted version of every entity, optionally as of a commit time.

    ``deletes="apply"`` drops an entity whose last change is a delete; ``"ignore"`` looks at
    upserts only, so the last image before a delete survives.
    """
    if deletes not in ("apply", "ignore"):
        raise ValueError(f"deletes must be 'apply' or 'ignore', not {deletes!r}")
    rows = bronze if as_of_ms is None else bronze.filter(F.col("ts_ms") <= as_of_ms)
    if deletes == "ignore":
        rows = rows.filter(upserts())
    fields = [name for name, _ in entity.fields]
    order = [c for c in VERSION_ORDER if c in bronze.columns]
    slim = accepted(rows, entity).select(*fields, "op", "ingested_at", *order)
    return latest_per_key(slim, entity.key, order).filter(upserts())


def unfold(bronze: DataFrame, entity: schemas.Entity) -> DataFrame:
    """Signed images: +1 for the new row, -1 for the row it replaces or deletes.

    Each side counts if its own image can be used. Logs chain images, so an image that never
    counted is never taken back, and one that counted is taken back once, also by a change whose
    new image goes to quarantine: until the next good change the entity then counts nowhere.
    Records without a readable envelope, and upserts without an after image, count on no side.
    Batch and stream follow this rule alike; it needs no state.
    """
    delete = F.col("op") == rules.DELETE_OP
    readable = bronze.filter(
        F.col("op").isin(*rules.ALL_OPS)
        & F.col("ts_ms").isNotNull()
        & (delete | F.col("after").isNotNull())
    )
    identity = [c for c in IDENTITY if c in bronze.columns]
    create = F.col("op").isin("c", "r")
    sides = F.array(
        F.struct(F.lit(-1).alias("sign"), F.when(~create, F.col("before")).alias("image")),
        F.struct(F.lit(1).alias("sign"), F.when(~delete, F.col("after")).alias("image")),
    )
    signed = readable.select(*identity, "op", "ts_ms", F.inline(sides)).filter(
        F.col("image").isNotNull()
    )
    typed, unusable = typed_fields(entity)
    return (
        image_texts(signed, F.col("image"), entity)
        .filter(unusable.isNull())
        .select(*identity, "op", "ts_ms", "sign", *[typed[n].alias(n) for n in typed])
    )


def upsert(current: DataFrame, changes: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """State after a batch of changes: both carry ``op`` and the order columns, deletes included.

    Without a table format that merges in place this is a union and one latest-per-key pass;
    keep deleted keys in ``current`` (as rows with op ``d``) so that late changes cannot revive
    them.
    """
    return latest_per_key(current.unionByName(changes.select(*current.columns)), key, order)


def previous_in_log(
    df: DataFrame, key: str, value: str, chunk: int = OFFSETS_PER_CHUNK
) -> DataFrame:
    """``previous``: the value of the preceding record of the same key, in delivery order.

    All records of a key sit in one topic partition. The scan is cut into offset ranges, each
    with at most ``chunk`` records by construction. Only the first record of a range looks
    outside it, so a second window holds one record per range. No task gets a whole hot key.
    """
    group = ["topic", "partition", key]
    inside = Window.partitionBy(*group, "_chunk").orderBy("offset")
    whole = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cut = (
        df.withColumn("_chunk", F.floor(F.col("offset") / F.lit(chunk)))
        .withColumn("_first", F.row_number().over(inside) == 1)
        .withColumn("_before", F.lag(value).over(inside))
        .withColumn("_last", F.last(value).over(whole))
    )
    across = Window.partitionBy(*group, "_place").orderBy("_chunk")
    return (
        cut.withColumn("_place", F.when(~F.col("_first"), F.col("_chunk")))
        .withColumn("_carried", F.lag("_last").over(across))
        .withColumn("previous", F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_before")))
        .select(*df.columns, "previous")
    )


def forbidden_transitions(moves: DataFrame, previous: str, status: str) -> DataFrame:
    """Rows whose (previous, status) pair is a change outside the allowed life cycle."""
    allowed = F.lit(False)
    for before, after in rules.ALLOWED_TRANSITIONS:
        allowed = allowed | ((F.col(previous) == before) & (F.col(status) == after))
    return moves.filter(
        F.col(previous).isNotNull() & (F.col(previous) != F.col(status)) & ~allowed
    )


def transition_audit(bronze: DataFrame, previous: str = "image") -> DataFrame:
    """Order updates that break the status life cycle.

    ``previous="image"`` compares the two images of each update: no shuffle beyond the removal
    of re-delivered records. ``"log"`` looks up the preceding record of the order, for logs
    without before images.
    """
    kept = ["order_id", "topic", "partition", "offset", "ts_ms"]
    seen = accepted(bronze, schemas.ORDERS).filter(upserts()).dropDuplicates(list(IDENTITY))
    if previous == "image":
        moves = seen.withColumn("previous", F.get_json_object("before", "$.status"))
    elif previous == "log":
        moves = previous_in_log(seen.select(*kept, "status"), "order_id", "status")
    else:
        raise ValueError(f"previous must be 'image' or 'log', not {previous!r}")
    return forbidden_transitions(moves, "previous", "status").select(*kept, "previous", "status")
