"""The batch chain: topics to Bronze, Silver, Gold, the gate, and publication when it is green."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import UTC, datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from tidelog.operators.contracts import check_compatible
from tidelog.operators.envelope import (
    bronze_events,
    filled,
    parse_envelope,
    quarantined,
    topic_values,
)
from tidelog.operators.gold import customer_metrics, daily_revenue
from tidelog.operators.silver import silver_customers, silver_order_items, silver_orders
from tidelog.plans.incremental import Views
from tidelog.quality.gate import is_green, run_gate
from tidelog.quality.suites import LAYERS
from tidelog.schemas import BRONZE_CDC, CUSTOMERS, ORDER_ITEMS, ORDERS
from tidelog.sources.ledger import Ledger
from tidelog.sources.manifest import Manifest
from tidelog.sources.tables import existing, publish, read_table, spec, write_table
from tidelog.sources.topics import Topic, read_records

CDC_TABLES = {
    "orders": "raw.cdc_orders",
    "customers": "raw.cdc_customers",
    "order_items": "raw.cdc_order_items",
}


# Landed Bronze rows: the contract columns and the identity of the record.
BRONZE_LANDED = StructType(
    [
        *BRONZE_CDC.fields,
        StructField("topic", StringType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
    ]
)


@dataclass(frozen=True)
class Outcome:
    """Rows written per table, whether the gate passed, and the folder of its results."""

    rows: dict[str, int]
    green: bool
    results: str


def table_path(root: str, name: str) -> str:
    return f"{root}/{name.replace('.', '/')}"


def _contract(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Contract columns of a table; a table that was never written counts as empty."""
    df = existing(spark, path)
    if df is None:
        return spark.createDataFrame([], spec(name).schema)
    return df.select(*spec(name).schema.fieldNames())


def published(spark: SparkSession, root: str) -> Manifest:
    """The manifest of the green versions; it reads several tables of one version together."""
    return Manifest(spark, f"{root}/published")


def contract_tables(spark: SparkSession, root: str, run_id: str) -> dict[str, DataFrame]:
    """The landed Bronze tables and one version of Silver and Gold, as the suites see them."""
    version = f"{root}/versions/{run_id}"
    return {
        name: _contract(spark, name, table_path(root if layer == "bronze" else version, name))
        for layer, names in LAYERS.items()
        for name in names
    }


def ledger_of(spark: SparkSession, path: str) -> Ledger:
    """The ledger that stands beside a landed table."""
    return Ledger(spark, f"{path}-offsets")


def _landed_by(landed: DataFrame, run: str) -> DataFrame:
    """Rows that a run appended, told by its run time; its day prunes the partitions where they are by day."""
    at = F.lit(run).cast("timestamp")
    rows = landed.where(F.col("ingested_at") == at)
    return rows.where(F.col("ingested_at_day") == F.to_date(at)) if "ingested_at_day" in landed.columns else rows


def append_new(
    records: DataFrame,
    table: str,
    path: str,
    run_ts: str | None = None,
    parse: Callable[[DataFrame], DataFrame] | None = None,
    repeats: bool = False,
) -> int:
    """Append the Bronze rows whose records are not landed yet and return their number.

    The ledger beside the table says what is landed; it is noted after the append, from the rows that this
    run left in the table. ``run_ts`` becomes their run time. A table without a ledger gets one first.
    ``parse`` makes Bronze rows of records (with topic, partition and offset); without it they are such rows. It sees new
    records alone, and the longer rows are never moved. ``repeats``: records may come more than once.
    """
    spark, target = records.sparkSession, spec(table)
    parse = parse or (lambda kept: kept)
    rows = parse(records)
    run = run_ts or datetime.now(UTC).strftime("%Y-%m-%d %H:%M:%S.%f")
    ledger, landed = ledger_of(spark, path), existing(spark, path)
    if landed is not None:
        derived = {t.name for t in target.layout} - set(rows.columns)
        check_compatible(StructType([f for f in landed.schema if f.name not in derived]), rows.schema)
        if not ledger.generation():
            ledger.begin(run)
            ledger.end(run, landed)
        for broken in ledger.unfinished():
            ledger.end(broken, _landed_by(landed, broken))
    new = parse(ledger.missing(records, repeats)).withColumn("ingested_at", F.lit(run).cast("timestamp")).select(rows.columns)
    ledger.begin(run)
    written = write_table(new, path, target.layout, rebalance=target.mixed)
    landed = existing(spark, path)
    ledger.end(run, rows.limit(0) if landed is None else _landed_by(landed, run))
    return written


def ingest_bronze(
    spark: SparkSession,
    topics: Mapping[str, Topic],
    root: str,
    run_ts: str | None = None,
) -> dict[str, int]:
    """Land every topic: change envelopes for the three entities, whole records for ``events``.

    Records that the ledger of a table has are left out, and a run that broke off is made up for by the
    next one. An empty topic lands nothing.
    """
    written = {}
    for entity, topic in topics.items():
        records = read_records(spark, topic)
        if entity == "events":
            table, parse = "raw.kafka_events", bronze_events
        else:
            table, parse, records = CDC_TABLES[entity], parse_envelope, filled(topic_values(records))
        # Files may overlap; offsets of a broker never repeat.
        written[table] = append_new(records, table, table_path(root, table), run_ts, partial(parse, run_ts=run_ts), not topic.ordered)
    return written


def run_batch(
    spark: SparkSession,
    topics: Mapping[str, Topic],
    root: str,
    run_id: str,
    as_of: str,
    run_ts: str | None = None,
    deletes: str = "apply",
    publish_as: Mapping[str, str] | None = None,
) -> Outcome:
    """Build one version of Silver and Gold from all landed changes and gate it.

    Every stage writes its table and the next one reads it back, so a lost executor never means
    starting over. A version lives in a folder of its own, and is published only when green: the manifest moves to all
    its tables at once, and after it the views one by one, for readers of a single table.
    Records that cannot be used go to the version's quarantine tables with the reason.
    """
    rows = ingest_bronze(spark, topics, root, run_ts)
    version = f"{root}/versions/{run_id}"

    def bronze(entity: str) -> DataFrame:
        return read_table(spark, table_path(root, CDC_TABLES[entity]), BRONZE_LANDED)

    def build(name: str, df: DataFrame) -> None:
        table = spec(name)
        rows[name] = write_table(
            df, table_path(version, name), table.layout, "overwrite", table.file_bytes
        )

    def built(name: str) -> DataFrame:
        return read_table(spark, table_path(version, name), spec(name).schema)

    for entity in (ORDERS, CUSTOMERS, ORDER_ITEMS):
        name = f"quarantine.{entity.name}"
        broken = quarantined(bronze(entity.name), entity)
        rows[name] = write_table(broken, table_path(version, name), mode="overwrite", rebalance=False)

    build("silver.orders", silver_orders(bronze("orders"), deletes))
    build("silver.customers", silver_customers(bronze("customers"), deletes))
    build(
        "silver.order_items",
        silver_order_items(bronze("order_items"), built("silver.orders"), deletes),
    )
    build(
        "gold.daily_revenue",
        daily_revenue(built("silver.orders"), built("silver.order_items"), run_ts),
    )
    build(
        "gold.customer_metrics",
        customer_metrics(built("silver.orders"), built("silver.customers"), as_of, run_ts),
    )

    results = f"{version}/quality"
    gate = run_gate(contract_tables(spark, root, run_id))
    gate = gate.withColumn("checked_at", F.current_timestamp())
    gate.write.mode("overwrite").parquet(results)
    green = is_green(spark.read.parquet(results))
    if green:
        tables = {name: table_path(version, name) for layer in ("silver", "gold") for name in LAYERS[layer]}
        manifest = published(spark, root)
        manifest.publish(tables, manifest.version())
        for name, view in (publish_as or {}).items():
            publish(spark, view, table_path(version, name))
    return Outcome(rows, green, results)


def _landed_after(landed: DataFrame, last: str | None, upto: str) -> DataFrame:
    """Rows of the runs after one and up to another; their days prune the partitions."""
    end = F.lit(upto).cast("timestamp")
    rows = landed.where((F.col("ingested_at") <= end) & (F.col("ingested_at_day") <= F.to_date(end)))
    if last is None:
        return rows
    start = F.lit(last).cast("timestamp")
    return rows.where((F.col("ingested_at") > start) & (F.col("ingested_at_day") >= F.to_date(start)))


def run_refresh(
    spark: SparkSession, topics: Mapping[str, Topic], root: str, run_ts: str | None = None
) -> tuple[Views, dict[str, int]]:
    """Land what is new and bring the standing Silver and Gold views up to date with it; the rows landed per table.

    Only the Bronze rows of the runs since the last refresh are read. Run times must grow. A refresh that broke off is
    finished first, with the rows it began with. Records that cannot be used go to quarantine by run.
    """
    run = run_ts or datetime.now(UTC).strftime("%Y-%m-%d %H:%M:%S.%f")
    rows = ingest_bronze(spark, topics, root, run)
    views = Views(spark, f"{root}/views")
    done = views.version()
    last = views.facts.directory(done).run
    begun = {table.directory().run for table in views.tables() if table.version() > done}
    for upto in sorted(begun | {run}):
        if last is not None and upto <= last:
            continue
        batch = {}
        for entity in (ORDERS, CUSTOMERS, ORDER_ITEMS):
            landed = existing(spark, table_path(root, CDC_TABLES[entity.name]))
            if landed is not None:
                batch[entity.name] = _landed_after(landed, last, upto)
                path = f"{table_path(root, f'quarantine.{entity.name}')}/run={upto.replace(' ', 'T').replace(':', '')}"
                quarantined(batch[entity.name], entity).write.mode("overwrite").parquet(path)
        views.refresh(batch, upto)
        last = upto
    return views, rows
