"""Declared schemas of topics, tables and change images."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _schema(required: tuple[str, ...] = (), **columns: str) -> T.StructType:
    schema = T.StructType()
    for name, kind in columns.items():
        schema.add(name, kind, nullable=name not in required)
    return schema


TOPIC_RECORD = _schema(
    key="binary",
    value="binary",
    topic="string",
    partition="integer",
    offset="long",
    timestamp="timestamp",
)

BRONZE_CDC = _schema(
    cdc_id="string",
    op="string",
    ts_ms="long",
    source_db="string",
    source_table="string",
    txn_id="long",
    before="string",
    after="string",
    ingested_at="timestamp",
)

BRONZE_EVENTS = _schema(
    event_id="string",
    topic="string",
    partition="integer",
    offset="long",
    event_ts="timestamp",
    ingested_at="timestamp",
    msg_key="string",
    payload="string",
)

SILVER_ORDERS = _schema(
    required=("order_id", "customer_id"),
    order_id="string",
    customer_id="string",
    status="string",
    total_amount="decimal(18,2)",
    currency="string",
    created_at="timestamp",
    updated_at="timestamp",
    _source_op="string",
    _ingested_at="timestamp",
)

SILVER_CUSTOMERS = _schema(
    required=("customer_id",),
    customer_id="string",
    name="string",
    email="string",
    created_at="timestamp",
    updated_at="timestamp",
    _source_op="string",
    _ingested_at="timestamp",
)

SILVER_ORDER_ITEMS = _schema(
    required=("item_id", "order_id", "product_id"),
    item_id="string",
    order_id="string",
    product_id="string",
    quantity="integer",
    unit_price="decimal(18,2)",
    line_total="decimal(18,2)",
    order_created_at="timestamp",
    _ingested_at="timestamp",
)

GOLD_DAILY_REVENUE = _schema(
    required=("report_date", "currency"),
    report_date="date",
    currency="string",
    order_count="long",
    item_count="long",
    gross_revenue="decimal(18,2)",
    net_revenue="decimal(18,2)",
    avg_order_value="decimal(18,2)",
    new_customers="long",
    computed_at="timestamp",
)

GOLD_CUSTOMER_METRICS = _schema(
    required=("customer_id",),
    customer_id="string",
    country_code="string",
    segment="string",
    first_order_date="date",
    last_order_date="date",
    total_orders="long",
    total_revenue="decimal(18,2)",
    avg_order_value="decimal(18,2)",
    days_since_last_order="integer",
    is_churned="boolean",
    computed_at="timestamp",
)

REVENUE_WINDOW = _schema(
    window_start="timestamp",
    window_end="timestamp",
    order_count="long",
    total_revenue="decimal(14,2)",
    avg_order_value="decimal(12,2)",
)

RATES_PAYLOAD = "base string, date string, rates map<string, double>"

RATE_EVENT = _schema(
    event_type="string",
    base="string",
    currency="string",
    rate="double",
    rate_date="string",
    fetched_at="string",
)


@dataclass(frozen=True)
class Entity:
    """A source table as it appears in change images: its key and the type of each field."""

    name: str
    key: str
    fields: tuple[tuple[str, str], ...]


ORDERS = Entity(
    "orders",
    "order_id",
    (
        ("order_id", "string"),
        ("customer_id", "string"),
        ("status", "string"),
        ("total_amount", "decimal(18,2)"),
        ("created_at", "timestamp"),
        ("updated_at", "timestamp"),
    ),
)

CUSTOMERS = Entity(
    "customers",
    "customer_id",
    (
        ("customer_id", "string"),
        ("name", "string"),
        ("email", "string"),
        ("created_at", "timestamp"),
        ("updated_at", "timestamp"),
    ),
)

ORDER_ITEMS = Entity(
    "order_items",
    "item_id",
    (
        ("item_id", "string"),
        ("order_id", "string"),
        ("product_id", "string"),
        ("quantity", "int"),
        ("unit_price", "decimal(18,2)"),
    ),
)


def with_column(schema: T.StructType, name: str, kind: str) -> T.StructType:
    return T.StructType([*schema.fields]).add(name, kind)


def image_schema(entity: Entity) -> T.StructType:
    """Rows of a state table: the image, and which change it comes from."""
    fields = {name: "integer" if kind == "int" else kind for name, kind in entity.fields}
    return _schema(**fields, op="string", ingested_at="timestamp", ts_ms="long", txn_id="long", offset="long")


# Sums that are kept between batches: per order, per day, per customer, and first days.

ITEM_SUMS = _schema(items="long", priced="long", items_total="decimal(38,2)")

ORDER_IMAGE = _schema(
    customer_id="string",
    status="string",
    total_amount="decimal(18,2)",
    created_at="timestamp",
    _source_op="string",
)

ORDER_FACTS = T.StructType([*_schema(order_id="string"), *ORDER_IMAGE, *ITEM_SUMS])

DAY_SUMS = _schema(report_date="date", currency="string", orders="long", items="long", revenue="decimal(38,2)")

BUYER_DAYS = _schema(customer_id="string", orders="long", revenue="decimal(38,2)").add(
    "days", T.ArrayType(_schema(day="date", n="long"))
)

NEWCOMERS = _schema(report_date="date", customers="long")

WINDOW_SUMS = _schema(window_start="timestamp", orders="long", revenue="decimal(38,2)")

# State of suites: how often each value occurs, by two hashes, and what follows for uniqueness.

VALUE_COUNTS = _schema(first="long", second="long", n="long")

KEY_NUMBERS = _schema(seen="long", repeated="long", distinct="long")
