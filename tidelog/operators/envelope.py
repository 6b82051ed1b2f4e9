"""Topic records to Bronze rows, and the split of records that cannot be used."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog import rules, schemas
from tidelog.functions.columns import record_id, run_time

IDENTITY = ("topic", "partition", "offset")


def topic_values(records: DataFrame) -> DataFrame:
    """Record values as text; record identity is kept when the input has it."""
    identity = [c for c in IDENTITY if c in records.columns]
    return records.select(F.col("value").cast("string").alias("raw_json"), *identity)


def filled(raw: DataFrame) -> DataFrame:
    """Records that have a value."""
    return raw.filter(F.col("raw_json").isNotNull() & (F.col("raw_json") != ""))


def parse_envelope(
    raw: DataFrame, run_ts: str | None = None, commit_time: str = "envelope"
) -> DataFrame:
    """Bronze rows from a ``raw_json`` column; NULL and empty values are dropped.

    The nine contract columns come first, then topic, partition and offset if given.
    ``commit_time="source"`` prefers the commit time of the source database in ``ts_ms``.
    """
    identity = [c for c in IDENTITY if c in raw.columns]
    cdc_id = record_id(*map(F.col, IDENTITY)) if len(identity) == len(IDENTITY) else F.expr("uuid()")
    source_ts = F.col("_source_ts") if commit_time == "source" else F.lit(None)
    # One generator per JSON level reads each text once; filters above it cannot repeat the parse.
    opened = filled(raw).select(
        *identity,
        F.json_tuple("raw_json", "op", "ts_ms", "before", "after", "source").alias(
            "op", "_ts", "before", "after", "_source"
        ),
    )
    return opened.select(
        *opened.columns,
        F.json_tuple("_source", "db", "table", "txId", "ts_ms").alias(
            "source_db", "source_table", "_txn", "_source_ts"
        ),
    ).select(
        cdc_id.alias("cdc_id"),
        "op",
        F.coalesce(source_ts, F.col("_ts")).try_cast("bigint").alias("ts_ms"),
        "source_db",
        "source_table",
        F.col("_txn").try_cast("bigint").alias("txn_id"),
        "before",
        "after",
        run_time(run_ts).alias("ingested_at"),
        *identity,
    )


def image_texts(df: DataFrame, image: Column, entity: schemas.Entity) -> DataFrame:
    """``df`` plus one text column ``_<field>`` per image field, each image read once."""
    names = [name for name, _ in entity.fields]
    return df.withColumn("_image", image).select(
        *df.columns, F.json_tuple("_image", *names).alias(*[f"_{n}" for n in names])
    )


def bronze_events(records: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Whole records of the generic events lane; the payload stays text."""
    return records.select(
        record_id(F.col("topic"), F.col("partition"), F.col("offset")).alias("event_id"),
        "topic",
        F.col("partition").cast("int").alias("partition"),
        "offset",
        F.col("timestamp").alias("event_ts"),
        run_time(run_ts).alias("ingested_at"),
        F.col("key").cast("string").alias("msg_key"),
        F.col("value").cast("string").alias("payload"),
    )


def typed_fields(entity: schemas.Entity) -> tuple[dict[str, Column], Column]:
    """Typed columns from the ``_<field>`` texts, and the first reason why an image is unusable."""
    texts = {name: F.col(f"_{name}") for name, _ in entity.fields}
    typed = {name: texts[name].try_cast(kind) for name, kind in entity.fields}
    error = F.when(texts[entity.key].isNull(), F.lit("missing key"))
    for name, kind in entity.fields:
        if kind != "string":
            error = error.when(texts[name].isNotNull() & typed[name].isNull(), F.lit(f"bad {name}"))
    return typed, error


def decode(bronze: DataFrame, entity: schemas.Entity) -> DataFrame:
    """Bronze rows plus the typed image fields and ``_error``, the first reason to reject a row.

    The image of a delete is the before image, of every other change the after image. A delete
    counts when its op, commit time and key can be read; an upsert needs every field.
    """
    delete = F.col("op") == rules.DELETE_OP
    typed, unusable = typed_fields(entity)
    error = (
        F.when(F.col("op").isNull(), F.lit("unreadable envelope"))
        .when(~F.col("op").isin(*rules.ALL_OPS), F.lit("unknown op"))
        .when(F.col("ts_ms").isNull(), F.lit("bad ts_ms"))
        .when(~delete & F.col("after").isNull(), F.lit("missing after"))
        .when(F.col(f"_{entity.key}").isNull(), F.lit("missing key"))
        .when(~delete, unusable)
    )
    image = F.when(delete, F.col("before")).otherwise(F.col("after"))
    return image_texts(bronze, image, entity).select(
        *bronze.columns, *[typed[n].alias(n) for n in typed], error.alias("_error")
    )


def accepted(bronze: DataFrame, entity: schemas.Entity) -> DataFrame:
    return decode(bronze, entity).filter(F.col("_error").isNull()).drop("_error")


def quarantined(bronze: DataFrame, entity: schemas.Entity) -> DataFrame:
    """Rows for the dead-letter lane, with the reason and the images as they came."""
    return decode(bronze, entity).filter(F.col("_error").isNotNull()).select(
        *bronze.columns, F.col("_error").alias("reason")
    )


def drop_redelivered(rows: DataFrame, *extra: str) -> DataFrame:
    """One row per record identity; on a stream the memory is bounded by the watermark."""
    keys = [*IDENTITY, *extra]
    if rows.isStreaming:
        return rows.dropDuplicatesWithinWatermark(keys)
    return rows.dropDuplicates(keys)


def upserts(op: Column | str = "op") -> Column:
    column = F.col(op) if isinstance(op, str) else op
    return column.isin(*rules.UPSERT_OPS)
