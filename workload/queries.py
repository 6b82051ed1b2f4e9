"""Every query by name: a function of the session and the table folder."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog import schemas
from tidelog.functions.columns import money, record_id
from tidelog.operators import changelog, contracts, envelope, gold, history, metrics, rates, serving, silver
from tidelog.plans.incremental import Views
from tidelog.plans.medallion import append_new, ledger_of
from tidelog.quality import gate
from tidelog.quality.difference import difference
from tidelog.quality.expectations import evaluate, evaluate_lookup
from tidelog.quality.states import SuiteState
from tidelog.quality.suites import LAYERS, SUITES
from tidelog.session import SCRATCH, configure, new_folder
from tidelog.sources.ledger import intervals
from tidelog.sources.tables import bucket_upsert, days, identity, months, spec, write_table
from tidelog.sources.topics import Topic, read_records, to_messages
from tidelog.streaming.windows import order_revenue
from workload import domain, logs, streams

Query = Callable[[SparkSession, str], DataFrame]

# 1998-06-15 00:00:30 UTC, in the middle of the changes of one day's orders.
AS_OF_MS = 897868830000
# Bounds of three batches by commit time: 1995-01-01 and the middle of a day's changes.
BATCH_BOUNDS = (788918400000, AS_OF_MS)

# The date of the second producer in the comparison of Gold tables.
PARITY_AS_OF = "1998-12-01"

REGISTRY: dict[str, Query] = {}


def plain_timestamps(df: DataFrame) -> DataFrame:
    """Instants as UTC wall-clock values, the type that the given tables use."""
    zoned = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain_timestamps(fn(configure(spark), sf_dir))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    REGISTRY[fn.__name__] = run
    return fn


def without_run_columns(df: DataFrame) -> DataFrame:
    """Results leave out run timestamps, which no two engines share."""
    return df.drop("computed_at", "ingested_at", "_ingested_at")


# Gold and its parts, over the domain tables


@query
def revenue_orders(spark, sf):
    return gold.revenue_orders(domain.silver_orders(spark, sf)).select(
        "order_id", "customer_id", "status", "total_amount", "created_at"
    )


@query
def line_total(spark, sf):
    return domain.priced_items(spark, sf).select("item_id", "quantity", "unit_price", "line_total")


@query
def order_item_rollup(spark, sf):
    return gold.item_rollup(domain.priced_items(spark, sf))


@query
def new_customers_per_day(spark, sf):
    return gold.new_customers_per_day(gold.revenue_orders(domain.silver_orders(spark, sf)))


@query
def gold_daily_revenue(spark, sf):
    return without_run_columns(domain.gold_daily_revenue(spark, sf))


@query
def gold_customer_metrics(spark, sf):
    return without_run_columns(domain.gold_customer_metrics(spark, sf))


@query
def recency_churn(spark, sf):
    return gold.order_stats(domain.silver_orders(spark, sf), domain.AS_OF).select(
        "customer_id", "last_order_date", "days_since_last_order", "is_churned"
    )


# Change logs


@query
def latest_per_key(spark, sf):
    return changelog.latest_per_key(
        domain.table(spark, sf, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"
        ),
        ["l_orderkey", "l_linenumber"],
        ["l_shipdate", "l_partkey", "l_suppkey"],
    )


@query
def cdc_envelope_parse(spark, sf):
    return without_run_columns(logs.bronze_orders(spark, sf))


@query
def cdc_quarantine(spark, sf):
    return envelope.quarantined(logs.bronze_orders(spark, sf), schemas.ORDERS).select(
        "partition", "offset", "op", "ts_ms", "reason"
    )


@query
def bronze_redelivery_dedup(spark, sf):
    return envelope.drop_redelivered(logs.bronze_orders(spark, sf)).select(
        "partition", "offset", "op", "ts_ms"
    )


@query
def changelog_unfold(spark, sf):
    return changelog.unfold(logs.bronze_orders(spark, sf), schemas.ORDERS).select(
        "partition",
        "offset",
        "op",
        "sign",
        "order_id",
        "customer_id",
        "status",
        "total_amount",
        "updated_at",
    )


@query
def silver_orders(spark, sf):
    return without_run_columns(silver.silver_orders(logs.bronze_orders(spark, sf)))


@query
def silver_orders_ignore_deletes(spark, sf):
    return without_run_columns(silver.silver_orders(logs.bronze_orders(spark, sf), "ignore"))


@query
def silver_orders_as_of(spark, sf):
    return without_run_columns(
        silver.silver_orders(logs.bronze_orders(spark, sf), as_of_ms=AS_OF_MS)
    )


@query
def silver_customers(spark, sf):
    return without_run_columns(silver.silver_customers(logs.bronze_customers(spark, sf)))


@query
def silver_order_items(spark, sf):
    orders = silver.silver_orders(logs.bronze_orders(spark, sf))
    return without_run_columns(
        silver.silver_order_items(logs.bronze_order_items(spark, sf), orders)
    )


@query
def silver_upsert(spark, sf):
    """State up to a time written as a bucketed table, then the later changes merged into it."""
    landed = new_folder(spark, "changes")
    envelope.accepted(logs.bronze_orders(spark, sf), schemas.ORDERS).select(
        "order_id",
        "customer_id",
        "status",
        "total_amount",
        "created_at",
        "updated_at",
        "op",
        *changelog.VERSION_ORDER,
    ).write.parquet(landed)
    changes = spark.read.parquet(landed)
    path = new_folder(spark, "state")
    early = F.col("ts_ms") <= AS_OF_MS
    for batch in (changes.filter(early), changes.filter(~early)):
        bucket_upsert(spark, batch, path, "order_id", changelog.VERSION_ORDER)
    return (
        spark.read.parquet(path)
        .filter(envelope.upserts())
        .select("order_id", "customer_id", "status", "total_amount", "updated_at", "op")
    )


@query
def silver_orders_history(spark, sf):
    """Orders as of three commit times, from one pass over their valid intervals."""
    versions = history.accepted_versions(logs.bronze_orders(spark, sf), schemas.ORDERS)
    states = history.states_at(history.history(versions, "order_id"), (*BATCH_BOUNDS, 4102444800000))
    return states.select("as_of", "order_id", "customer_id", "status", "total_amount", "updated_at")


@query
def items_with_order_status(spark, sf):
    """Line items with the status that their order had when they were shipped; none after its removal."""
    versions = history.accepted_versions(logs.bronze_orders(spark, sf), schemas.ORDERS)
    items = domain.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("shipped_ms"),
    )
    joined = history.as_of_join(items, versions, "order_id", "shipped_ms")
    live = F.col("version.op") != "d"
    return joined.select("order_id", "line", "shipped_ms", F.when(live, F.col("version.status")).alias("status"))


def _batches(rows: DataFrame) -> list[DataFrame]:
    """Landed Bronze rows in three batches; the second repeats rows of the first, the third brings some of it late."""
    path = new_folder(rows.sparkSession, "bronze")
    # Record ids are digests of the identity, a third of the bytes on disk, so they are made again on reading.
    rows.drop("cdc_id").write.options(**SCRATCH).parquet(path)
    cdc_id = record_id(*map(F.col, envelope.IDENTITY)).alias("cdc_id")
    landed = rows.sparkSession.read.parquet(path)
    rows, ts = landed.select(*[cdc_id if c == "cdc_id" else c for c in rows.columns]), F.coalesce("ts_ms", F.lit(0))
    first, second = (ts <= bound for bound in BATCH_BOUNDS)
    late, again = F.pmod("offset", F.lit(11)) == 0, F.pmod("offset", F.lit(7)) == 0
    return [rows.where(first & ~late), rows.where((second & ~first) | (first & again)), rows.where(~second | (first & late))]


@query
def silver_incremental(spark, sf):
    """Orders kept up to date over three batches, in buckets that split as the table grows."""
    views = Views(spark, new_folder(spark, "views"), rows=20_000)
    for n, rows in enumerate(_batches(logs.bronze_orders(spark, sf)), 1):
        views.refresh_silver(schemas.ORDERS, rows, n)
    return without_run_columns(views.silver_table(schemas.ORDERS, 3))


def _refreshed(spark, sf) -> Views:
    sources = {"orders": logs.bronze_orders, "customers": logs.bronze_customers, "order_items": logs.bronze_order_items}
    batches = {name: _batches(build(spark, sf)) for name, build in sources.items()}
    views = Views(spark, new_folder(spark, "views"), rows=100_000)
    views.refresh({name: first for name, (first, _, _) in batches.items()})
    views.refresh({name: second.unionByName(third) for name, (_, second, third) in batches.items()})
    return views


@query
def gold_daily_incremental(spark, sf):
    """Daily revenue kept by signed changes over two batches of Bronze rows, the second with late and repeated ones."""
    return without_run_columns(_refreshed(spark, sf).daily_revenue(domain.RUN_TS))


@query
def gold_customers_incremental(spark, sf):
    """Customer metrics kept by signed changes over two batches of Bronze rows, the second with late and repeated ones."""
    return without_run_columns(_refreshed(spark, sf).customer_metrics(domain.AS_OF, domain.RUN_TS))


def _audit(spark, sf, previous):
    return changelog.transition_audit(logs.bronze_orders(spark, sf), previous).drop("topic")


@query
def status_transition_audit(spark, sf):
    return _audit(spark, sf, "log")


@query
def status_transition_audit_images(spark, sf):
    return _audit(spark, sf, "image")


@query
def gold_daily_revenue_from_log(spark, sf):
    """Bronze to Silver to Gold from the change logs, deletes applied; Silver orders land once."""
    path = new_folder(spark, "silver-orders")
    silver.silver_orders(logs.bronze_orders(spark, sf)).write.parquet(path)
    orders = spark.read.parquet(path)
    items = silver.silver_order_items(logs.bronze_order_items(spark, sf))
    return without_run_columns(gold.daily_revenue(orders, items, domain.RUN_TS))


@query
def gold_customer_metrics_from_log(spark, sf):
    return without_run_columns(
        gold.customer_metrics(
            silver.silver_orders(logs.bronze_orders(spark, sf)),
            silver.silver_customers(logs.bronze_customers(spark, sf)),
            domain.AS_OF,
            domain.RUN_TS,
        )
    )


# Events lane, layout, rates


@query
def bronze_kafka_events(spark, sf):
    records = streams.landed_records(spark, logs.event_records(spark, sf), "raw.events")
    return without_run_columns(envelope.bronze_events(records, domain.RUN_TS))


@query
def stream_bronze_append(spark, sf):
    return without_run_columns(streams.stream_bronze_events(spark, sf))


@query
def stream_bronze_cdc(spark, sf):
    return streams.stream_bronze_orders(spark, sf).select(
        "cdc_id", "op", "ts_ms", "txn_id", "partition", "offset"
    )


def _appended(records: DataFrame, landed: str, run: str) -> None:
    raw = envelope.filled(envelope.topic_values(records))
    append_new(raw, "raw.cdc_orders", landed, run, lambda new: envelope.parse_envelope(new, run), repeats=True)


@query
def bronze_ingest_resume(spark, sf):
    """Order records landed by a run that broke off, with holes, and made up for by the next run."""
    root = new_folder(spark, "resume")
    topic = Topic("cdc.orders", path=f"{root}/topic")
    landed = f"{root}/bronze"
    logs.order_records(spark, sf).write.parquet(topic.path)
    broken_off = read_records(spark, topic).where("pmod(offset, 8) in (0, 3, 7) and pmod(offset div 8, 4) <> 1")
    raw = envelope.filled(envelope.topic_values(broken_off)).dropDuplicates(list(envelope.IDENTITY))
    ledger_of(spark, landed).begin(domain.RUN_TS)
    write_table(envelope.parse_envelope(raw, domain.RUN_TS), landed, spec("raw.cdc_orders").layout, rebalance=False)
    for _ in range(2):
        _appended(read_records(spark, topic), landed, domain.RUN_TS)
    return spark.read.parquet(landed).select("op", "ts_ms", "txn_id", "partition", "offset")


def _three_runs(spark, sf) -> str:
    """Order records landed by three runs: parts with holes that overlap, and all of them again."""
    landed, path = new_folder(spark, "ledger"), new_folder(spark, "records")
    logs.order_records(spark, sf).write.parquet(path)
    records = spark.read.parquet(path)
    half = F.expr("offset div 8") % 1000 < 600
    _appended(records.where(half & (F.col("offset") % 3 != 0)), landed, "2024-06-01 01:00:00")
    _appended(records.where(~half | (F.col("offset") % 5 != 0)), landed, "2024-06-01 02:00:00")
    _appended(records.unionByName(records.where(half)), landed, "2024-06-02 00:00:00")
    return landed


@query
def bronze_ledger(spark, sf):
    """What is landed after three runs that overlap: every record once."""
    return spark.read.parquet(_three_runs(spark, sf)).select("op", "ts_ms", "txn_id", "partition", "offset")


@query
def bronze_ledger_intervals(spark, sf):
    """The landed offsets of each topic partition as longest intervals, from the ledger alone."""
    return intervals(ledger_of(spark, _three_runs(spark, sf)).state()).drop("topic")


@query
def partition_layout(spark, sf):
    """Events written by day, month and topic, read back and counted per partition."""
    path = new_folder(spark, "layout")
    rows = envelope.bronze_events(logs.event_records(spark, sf), domain.RUN_TS)
    layout = (months("event_ts"), days("event_ts"), identity("topic"))
    write_table(rows, path, layout)
    return (
        spark.read.parquet(path)
        .groupBy(
            F.col("event_ts_month").cast("date").alias("event_month"),
            F.col("event_ts_day").cast("date").alias("event_day"),
            "topic",
        )
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


@query
def fx_rates_to_events(spark, sf):
    events = rates.rates_to_events(logs.rate_payloads(spark, sf), fetched_at=domain.RUN_TS)
    return rates.sorted_events(events)


@query
def fx_messages(spark, sf):
    events = rates.rates_to_events(logs.rate_payloads(spark, sf), fetched_at=domain.RUN_TS)
    return to_messages(events, "currency", "raw.events")


# Serving


@query
def serving_daily_trend(spark, sf):
    return serving.daily_trend(domain.gold_daily_revenue(spark, sf))


@query
def serving_top_customers(spark, sf):
    return serving.top_customers(domain.gold_customer_metrics(spark, sf))


@query
def serving_totals(spark, sf):
    return serving.totals(domain.gold_daily_revenue(spark, sf))


@query
def serving_churn_rate(spark, sf):
    return serving.churn_rate(domain.gold_customer_metrics(spark, sf))


@query
def serving_recent_windows(spark, sf):
    return serving.recent_windows(streams.event_windows(spark, sf))


@query
def serving_latest_window(spark, sf):
    return serving.latest_window(streams.event_windows(spark, sf))


@query
def latest_window_emission(spark, sf):
    """Each event as one emission of its window; the last one per window counts."""
    emissions = domain.table(spark, sf, "events").select(
        F.date_trunc("minute", F.col("ts").cast("timestamp")).alias("window_start"),
        F.col("event_id").alias("offset"),
        money(F.col("value"), 14).alias("total_revenue"),
    )
    return serving.latest_emissions(emissions)


# Quality


def _contract(df: DataFrame, schema) -> DataFrame:
    return df.select(*schema.fieldNames())


QUALITY_TABLES: dict[str, Query] = {
    "raw.kafka_events": lambda spark, sf: envelope.bronze_events(
        logs.event_records(spark, sf), domain.RUN_TS
    ),
    "raw.cdc_orders": lambda spark, sf: _contract(
        logs.bronze_orders(spark, sf), schemas.BRONZE_CDC
    ),
    "raw.cdc_customers": lambda spark, sf: _contract(
        logs.bronze_customers(spark, sf), schemas.BRONZE_CDC
    ),
    "raw.cdc_order_items": lambda spark, sf: _contract(
        logs.bronze_order_items(spark, sf), schemas.BRONZE_CDC
    ),
    "silver.orders": domain.silver_orders,
    "silver.customers": domain.silver_customers,
    "silver.order_items": domain.silver_order_items,
    "gold.daily_revenue": domain.gold_daily_revenue,
    "gold.customer_metrics": domain.gold_customer_metrics,
}


def quality_tables(spark, sf, layers=tuple(LAYERS)) -> dict[str, DataFrame]:
    """Each table built once and landed, as the batch chain does before its gate; the writes run side by side.

    A suite scans its table once for the row rules and once for each unique key.
    """

    def land(name: str) -> DataFrame:
        path = new_folder(spark, "gated")
        QUALITY_TABLES[name](spark, sf).write.options(**SCRATCH).parquet(path)
        return spark.read.parquet(path)

    names = [n for layer in layers for n in LAYERS[layer]]
    with ThreadPoolExecutor(len(names)) as pool:
        return dict(zip(names, pool.map(land, names)))


#: Tables that only look up columns of another, so that their suites need no join of all rows.
LOOKUPS = {"silver.order_items": domain.order_items_lookup}


def _suite_query(name: str) -> Query:
    def run(spark, sf):
        if name in LOOKUPS:
            return evaluate_lookup(LOOKUPS[name](spark, sf), name, SUITES[name])
        return evaluate(QUALITY_TABLES[name](spark, sf), name, SUITES[name])

    run.__name__ = "dq_suite_" + name.replace("raw.", "bronze_").replace(".", "_")
    return query(run)


for _name in SUITES:
    _suite_query(_name)


@query
def dq_suite_incremental(spark, sf):
    """The suite of the order change log, kept by parts of which only the new one is scanned."""
    path = new_folder(spark, "suite-parts")
    rows = QUALITY_TABLES["raw.cdc_orders"](spark, sf)
    rows.withColumn("_part", F.pmod(F.monotonically_increasing_id(), F.lit(3))).write.parquet(path)
    table = spark.read.parquet(path)
    state = SuiteState(spark, new_folder(spark, "suite"), "raw.cdc_orders", tuple(SUITES["raw.cdc_orders"]), rows=100_000)
    for n in range(3):
        state.append(table.where(F.col("_part") == n).drop("_part"), n)
    return state.results()


@query
def dq_gate_summary(spark, sf):
    return gate.gate_summary(gate.run_gate(quality_tables(spark, sf)))


@query
def dq_suite_summary(spark, sf):
    layers = ("silver", "gold")
    results = gate.run_gate(quality_tables(spark, sf, layers), layers)
    return gate.suite_summary(results).withColumn("failures", F.concat_ws("; ", "failures"))


@query
def dq_unique_grain(spark, sf):
    return gate.duplicate_grain(
        domain.table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber"
    )


@query
def dq_relationships(spark, sf):
    customers = silver.silver_customers(logs.bronze_customers(spark, sf))
    return gate.orphans(domain.silver_orders(spark, sf), customers, "customer_id")


@query
def dq_churn_consistency(spark, sf):
    """Flags set by a limit of 120 days: everyone between the two limits is a violation."""
    late = F.coalesce(F.col("days_since_last_order") > 120, F.lit(False))
    return gate.churn_violations(
        domain.gold_customer_metrics(spark, sf).withColumn("is_churned", late)
    )


@query
def dq_model_tests(spark, sf):
    return gate.model_tests(
        domain.gold_daily_revenue(spark, sf),
        domain.gold_customer_metrics(spark, sf),
        domain.silver_customers(spark, sf),
    )


@query
def gold_parity(spark, sf):
    """Customer metrics as of two dates, each without some customers, compared column by column."""
    tables = []
    for as_of, number, rest in ((domain.AS_OF, 50, 7), (PARITY_AS_OF, 70, 3)):
        metrics = gold.customer_metrics(domain.silver_orders(spark, sf), domain.silver_customers(spark, sf), as_of, domain.RUN_TS)
        path = new_folder(spark, "parity")
        without_run_columns(metrics).where(F.col("customer_id").cast("bigint") % number != rest).write.parquet(path)
        tables.append(spark.read.parquet(path))
    return difference(*tables, ["customer_id"])


@query
def smoke_checks(spark, sf):
    return gate.smoke_checks(
        {
            "gold.daily_revenue": domain.gold_daily_revenue(spark, sf),
            "gold.customer_metrics": domain.gold_customer_metrics(spark, sf),
        }
    )


@query
def contract_orders(spark, sf):
    images = envelope.drop_redelivered(logs.bronze_orders(spark, sf)).select(
        "partition", "offset", "after"
    )
    return contracts.violations(images, "after", contracts.ORDER_CONTRACT)


@query
def contract_customers(spark, sf):
    images = logs.bronze_customers(spark, sf).select("partition", "offset", "after")
    return contracts.violations(images, "after", contracts.CUSTOMER_CONTRACT)


@query
def contract_order_items(spark, sf):
    """Broken rules per field: the derived item ids are texts where the contract asks integers."""
    images = logs.bronze_order_items(spark, sf).select("after")
    broken = contracts.violations(images, "after", contracts.ORDER_ITEM_CONTRACT)
    return broken.groupBy("field", "rule").agg(F.count(F.lit(1)).alias("images"))


@query
def schema_evolution(spark, sf):
    return contracts.observed_evolution(
        logs.bronze_customers(spark, sf).select("after"), "after", contracts.CUSTOMER_CONTRACT
    )


@query
def freshness(spark, sf):
    """Delay of a window in seconds: the largest value measured in it."""
    events = domain.table(spark, sf, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), money(F.col("value")).alias("value")
    )
    windows = events.groupBy(F.window("ts", "1 minute").alias("w")).agg(F.max("value").alias("s"))
    emitted = F.timestamp_micros(
        F.unix_micros("w.end") + (F.col("s") * 1_000_000).cast("bigint")
    )
    return contracts.freshness(
        windows.select(F.col("w.end").alias("window_end"), emitted.alias("emitted_at"))
    )


# Windows over streams and logs


@query
def stream_tumbling_1m(spark, sf):
    return streams.stream_tumbling(spark, sf)


@query
def batch_order_revenue_1m(spark, sf):
    return order_revenue(logs.bronze_orders(spark, sf))


@query
def stream_order_revenue_1m(spark, sf):
    return streams.stream_order_revenue(spark, sf)


@query
def stream_order_revenue_late(spark, sf):
    return streams.stream_order_revenue_late(spark, sf)


# Metrics: one series per event type, the value as counter or gauge


def samples(spark, sf) -> DataFrame:
    return domain.table(spark, sf, "events").select(
        F.col("event_type").alias("series"),
        F.col("user_id").alias("member"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").alias("sample_id"),
        money(F.col("value")).alias("value"),
    )


def minute_samples(spark, sf) -> DataFrame:
    """Samples on whole minutes, so that many of a series share their time."""
    return samples(spark, sf).withColumn("ts", F.date_trunc("minute", "ts"))


def hourly_increase(spark, sf) -> DataFrame:
    return metrics.increase(minute_samples(spark, sf), ["series"], 3600, "sample_id")


@query
def metric_rate(spark, sf):
    grown = hourly_increase(spark, sf)
    return grown.withColumn("increase", money(F.col("increase")))


@query
def metric_increase_above(spark, sf):
    grown = metrics.increase_above(hourly_increase(spark, sf), 250)
    return grown.select("series", "window_start", money(F.col("increase")).alias("increase"))


@query
def metric_sum_by(spark, sf):
    """Daily growth per (series, member), summed without the member."""
    grown = metrics.increase(samples(spark, sf), ["series", "member"], 86400, "sample_id")
    total = metrics.sum_by(grown, ["series", "window_start"], "increase")
    return total.withColumn("increase", money(F.col("increase")))


@query
def metric_sustained_alert(spark, sf):
    return metrics.sustained(minute_samples(spark, sf), ["series"], F.col("value") > 30, 3600, "sample_id")


@query
def metric_absent(spark, sf):
    return metrics.absent(
        samples(spark, sf), ["series"], "2024-01-01 00:00:00", "2024-01-31 00:00:00", 3600
    )


@query
def metric_topk(spark, sf):
    grown = metrics.increase(samples(spark, sf), ["series", "member"], 3600, "sample_id")
    return metrics.top_series(grown, ["series", "member"], 10).withColumn(
        "increase", money(F.col("increase"))
    )


def _hourly_sum(spark, sf, series: str) -> DataFrame:
    rows = samples(spark, sf).filter(F.col("series") == series)
    return metrics.sum_by(
        rows.withColumn("window_start", F.date_trunc("hour", "ts")), ["window_start"], "value"
    )


@query
def metric_ratio(spark, sf):
    low = metrics.ratio_below(
        _hourly_sum(spark, sf, "purchase"), _hourly_sum(spark, sf, "view"), ["window_start"], "value", 0.1
    )
    return low.select(
        "window_start",
        money(F.col("numerator")).alias("numerator"),
        money(F.col("denominator")).alias("denominator"),
        "ratio",
    )


@query
def metric_staleness(spark, sf):
    return metrics.staleness(samples(spark, sf), ["series", "member"], "2024-01-31 00:00:00")


def _alerts(spark, sf) -> tuple[DataFrame, DataFrame]:
    grown = hourly_increase(spark, sf)
    busy = grown.filter(F.col("samples") >= 5).select("series", "window_start")
    rising = metrics.increase_above(grown, 250).select("series", "window_start")
    return busy, rising


@query
def metric_both(spark, sf):
    busy, rising = _alerts(spark, sf)
    return metrics.both(busy, rising, ["series", "window_start"])


@query
def metric_either(spark, sf):
    busy, rising = _alerts(spark, sf)
    return metrics.either(busy, rising, ["series", "window_start"])
