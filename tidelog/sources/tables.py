"""Parquet tables: partition layouts, writes with row counts, creation and publication."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidelog import schemas
from tidelog.session import setting

RAW_FILE_BYTES = 128 << 20
GOLD_FILE_BYTES = 64 << 20


@dataclass(frozen=True)
class Transform:
    """A partition column derived from a table column: days, months, bucket or identity."""

    kind: str
    column: str
    buckets: int = 0

    @property
    def name(self) -> str:
        if self.kind == "bucket":
            # The number is part of the name, so tables with other buckets cannot be mixed up.
            return f"{self.column}_bucket_{self.buckets}"
        suffix = {"days": "day", "months": "month"}.get(self.kind)
        return f"{self.column}_{suffix}" if suffix else self.column

    def value(self) -> Column:
        if self.kind == "days":
            return F.to_date(self.column)
        if self.kind == "months":
            return F.trunc(F.to_date(self.column), "month")
        if self.kind == "bucket":
            return F.pmod(F.hash(self.column), F.lit(self.buckets))
        return F.col(self.column)


def days(column: str) -> Transform:
    return Transform("days", column)


def months(column: str) -> Transform:
    return Transform("months", column)


def bucket(buckets: int, column: str) -> Transform:
    return Transform("bucket", column, buckets)


def identity(column: str) -> Transform:
    return Transform("identity", column)


@dataclass(frozen=True)
class TableSpec:
    """Name, schema, partition layout and file size of a table.

    ``mixed``: the rows of one write belong to many partitions, in any order.
    """

    name: str
    schema: StructType
    layout: tuple[Transform, ...] = ()
    file_bytes: int = RAW_FILE_BYTES
    mixed: bool = True


TABLES = (
    TableSpec("raw.cdc_orders", schemas.BRONZE_CDC, (days("ingested_at"),), mixed=False),
    TableSpec("raw.cdc_customers", schemas.BRONZE_CDC, (days("ingested_at"),), mixed=False),
    TableSpec("raw.cdc_order_items", schemas.BRONZE_CDC, (days("ingested_at"),), mixed=False),
    TableSpec("raw.kafka_events", schemas.BRONZE_EVENTS, (days("event_ts"), identity("topic"))),
    TableSpec("silver.orders", schemas.SILVER_ORDERS, (days("created_at"),)),
    TableSpec("silver.customers", schemas.SILVER_CUSTOMERS, (days("created_at"),)),
    TableSpec(
        "silver.order_items",
        schemas.SILVER_ORDER_ITEMS,
        (days("order_created_at"), bucket(16, "order_id")),
    ),
    TableSpec(
        "gold.daily_revenue", schemas.GOLD_DAILY_REVENUE, (months("report_date"),), GOLD_FILE_BYTES
    ),
    TableSpec(
        "gold.customer_metrics",
        schemas.GOLD_CUSTOMER_METRICS,
        (bucket(32, "customer_id"),),
        GOLD_FILE_BYTES,
    ),
)


def spec(name: str) -> TableSpec:
    return next(t for t in TABLES if t.name == name)


def with_layout(df: DataFrame, layout: Sequence[Transform]) -> DataFrame:
    return df.withColumns({t.name: t.value() for t in layout if t.kind != "identity"})


def counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Run a write and return its row count, taken from the write itself.

    The count must sit on top of the plan: adaptive execution drops everything below a shuffle
    that turns out empty, and the count with it.
    """
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return int(seen.get["rows"])


def write_table(
    df: DataFrame,
    path: str,
    layout: Sequence[Transform] = (),
    mode: str = "append",
    file_bytes: int = RAW_FILE_BYTES,
    rebalance: bool = True,
) -> int:
    """Write Snappy Parquet and return the number of rows.

    ``mode``: ``append``, ``overwrite`` (whole table) or ``partitions`` (only the partitions
    that occur in ``df``). ``rebalance`` gathers rows by partition first: small partitions share
    a task, a large one is split over several, and files come out near ``file_bytes``. Leave it
    out where the rows of a task belong together already.
    """
    spark = df.sparkSession
    names = [t.name for t in layout]
    laid = with_layout(df, layout)
    if rebalance:
        laid = laid.hint("rebalance", *names)

    def save(rows: DataFrame) -> None:
        writer = rows.write.mode("append" if mode == "append" else "overwrite")
        writer = writer.option("compression", "snappy").option(
            "partitionOverwriteMode", "dynamic" if mode == "partitions" else "static"
        )
        with setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", str(file_bytes)):
            (writer.partitionBy(*names) if names else writer).parquet(path)

    return counted(laid, save)


def existing(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame | None:
    """The table at a path, or None where nothing was written yet. With a schema, no file is opened to find it."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        # A write of no rows leaves no file to take the schema from.
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Table by path or catalog name; with a schema, its columns without layout columns.

    A path with a schema may also be a table that was written without any row.
    """
    if "/" not in path:
        df = spark.table(path)
        return df.select(*schema.fieldNames()) if schema else df
    if schema is None:
        return spark.read.parquet(path)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def bucket_upsert(
    spark: SparkSession,
    changes: DataFrame,
    path: str,
    key: str,
    order: Sequence[str],
    buckets: int = 16,
) -> int:
    """Merge a batch of changes into a state table and rewrite only the touched buckets.

    The list of touched buckets is at most ``buckets`` numbers. Buckets are read through
    partition pruning and replaced by dynamic partition overwrite. A table keeps the number of
    buckets it was first written with; another number is refused. Hand in landed changes: they are
    read twice.
    """
    from tidelog.operators.changelog import latest_per_key, upsert

    layout = (bucket(buckets, key),)
    name = layout[0].name
    state = existing(spark, path)
    if state is not None and name not in state.columns:
        raise ValueError(f"the table at {path} has another layout than {buckets} buckets of {key}")
    changes = latest_per_key(changes, key, order)
    touched = [row[0] for row in with_layout(changes, layout).select(name).distinct().collect()]
    if not touched:
        return 0
    current = changes.limit(0) if state is None else state.filter(F.col(name).isin(touched)).drop(name)
    return write_table(upsert(current, changes, key, order), path, layout, "partitions")


def create_tables(spark: SparkSession, location: str | None = None) -> list[str]:
    """Create the databases and tables that do not exist yet, and list all of them.

    Layout columns are part of the table because a Parquet table has no hidden partitioning.
    """
    for database in sorted({t.name.split(".")[0] for t in TABLES}):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table in TABLES:
        derived = ", ".join(
            f"`{t.name}` {'int' if t.kind == 'bucket' else 'date'}"
            for t in table.layout
            if t.kind != "identity"
        )
        columns = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" + ("" if f.nullable else " NOT NULL")
            for f in table.schema.fields
        )
        partitions = ", ".join(f"`{t.name}`" for t in table.layout)
        where = f" LOCATION '{location}/{table.name.replace('.', '/')}'" if location else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table.name} ({columns}{', ' + derived if derived else ''}) "
            f"USING parquet OPTIONS (compression 'snappy') PARTITIONED BY ({partitions}){where}"
        )
    return [
        f"{row.namespace}.{row.tableName}"
        for database in sorted({t.name.split(".")[0] for t in TABLES})
        for row in spark.sql(f"SHOW TABLES IN {database}").collect()
    ]


def publish(spark: SparkSession, view: str, path: str) -> None:
    """Point a view at a finished table folder: one metadata step, no copy of the data."""
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM parquet.`{path}`")
