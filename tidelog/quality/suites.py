"""The expectation suites of the nine tables, and the tables of each layer."""

from __future__ import annotations

from tidelog import rules, schemas
from tidelog.quality.expectations import (
    Expectation,
    at_least,
    between,
    columns,
    compound_unique,
    in_set,
    length_between,
    matches,
    max_between,
    not_null,
    row_count,
    unique,
    unique_share,
)

# Fixed patterns, bounds and value lists.
UUID = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
TOPIC_NAME = "^[a-zA-Z0-9._-]+$"
CURRENCY = "^[A-Z]{3}$"
COUNTRY = "^[A-Z]{2}$"
EMAIL = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
FRESH_SINCE = "2024-01-01T00:00:00"
EPOCH_MS = 1_000_000_000_000
SEGMENTS = ("consumer", "business", "vip")

KAFKA_EVENTS = (
    row_count(1),
    columns(*schemas.BRONZE_EVENTS.fieldNames()),
    not_null("event_id"),
    unique("event_id"),
    matches("event_id", UUID),
    not_null("topic"),
    matches("topic", TOPIC_NAME),
    not_null("partition"),
    between("partition", 0),
    not_null("offset"),
    between("offset", 0),
    not_null("event_ts"),
    max_between("event_ts", FRESH_SINCE),
    not_null("ingested_at"),
    not_null("payload"),
    length_between("payload", 2),
)

CDC = (
    row_count(1),
    columns(*schemas.BRONZE_CDC.fieldNames()),
    not_null("cdc_id"),
    unique("cdc_id"),
    matches("cdc_id", UUID),
    not_null("op"),
    in_set("op", rules.ALL_OPS),
    not_null("ts_ms"),
    between("ts_ms", EPOCH_MS),
    not_null("source_db"),
    not_null("source_table"),
    not_null("after", mostly=0.9),
    not_null("ingested_at"),
)

ORDERS = (
    row_count(1),
    columns(*schemas.SILVER_ORDERS.fieldNames()),
    not_null("order_id"),
    unique("order_id"),
    length_between("order_id", 1, 128),
    not_null("customer_id"),
    length_between("customer_id", 1, 128),
    in_set("status", rules.ORDER_STATUSES, mostly=0.999),
    between("total_amount", 0, mostly=0.999),
    matches("currency", CURRENCY, mostly=0.999),
    not_null("created_at"),
    max_between("created_at", FRESH_SINCE),
    at_least("updated_at", "created_at", mostly=0.999),
    in_set("_source_op", rules.UPSERT_OPS),
    not_null("_ingested_at"),
)

CUSTOMERS = (
    row_count(1),
    columns(*schemas.SILVER_CUSTOMERS.fieldNames()),
    not_null("customer_id"),
    unique("customer_id"),
    length_between("name", 1, 200, mostly=0.99),
    matches("email", EMAIL, mostly=0.99),
    length_between("email", 5, 320),
    not_null("created_at"),
    at_least("updated_at", "created_at", mostly=0.999),
    in_set("_source_op", rules.UPSERT_OPS),
    not_null("_ingested_at"),
)

ORDER_ITEMS = (
    row_count(1),
    columns(*schemas.SILVER_ORDER_ITEMS.fieldNames()),
    not_null("item_id"),
    unique("item_id"),
    not_null("order_id"),
    not_null("product_id"),
    not_null("quantity"),
    between("quantity", 1, 10000),
    not_null("unit_price"),
    between("unit_price", 0, mostly=0.999),
    not_null("line_total"),
    between("line_total", 0, mostly=0.999),
    not_null("order_created_at", mostly=0.99),
    not_null("_ingested_at"),
)

DAILY_REVENUE = (
    row_count(1),
    columns(*schemas.GOLD_DAILY_REVENUE.fieldNames()),
    not_null("report_date"),
    max_between("report_date", "2024-01-01"),
    not_null("currency"),
    matches("currency", CURRENCY),
    compound_unique("report_date", "currency"),
    not_null("order_count"),
    between("order_count", 0),
    between("item_count", 0),
    not_null("gross_revenue"),
    between("gross_revenue", 0),
    not_null("net_revenue"),
    between("net_revenue", 0),
    at_least("gross_revenue", "net_revenue", mostly=0.999),
    between("avg_order_value", 0),
    between("new_customers", 0),
    not_null("computed_at"),
)

CUSTOMER_METRICS = (
    row_count(1),
    columns(*schemas.GOLD_CUSTOMER_METRICS.fieldNames()),
    not_null("customer_id"),
    unique("customer_id"),
    matches("country_code", COUNTRY, mostly=0.999),
    in_set("segment", SEGMENTS, mostly=0.999),
    at_least("last_order_date", "first_order_date", mostly=0.999),
    not_null("total_orders"),
    between("total_orders", 0),
    not_null("total_revenue"),
    between("total_revenue", 0),
    between("avg_order_value", 0),
    between("days_since_last_order", 0, 36500),
    in_set("is_churned", (True, False)),
    not_null("computed_at"),
)

SUITES: dict[str, tuple[Expectation, ...]] = {
    "raw.kafka_events": KAFKA_EVENTS,
    "raw.cdc_orders": (*CDC, unique_share("cdc_id", 1.0, 1.0)),
    "raw.cdc_customers": CDC,
    "raw.cdc_order_items": CDC,
    "silver.orders": ORDERS,
    "silver.customers": CUSTOMERS,
    "silver.order_items": ORDER_ITEMS,
    "gold.daily_revenue": DAILY_REVENUE,
    "gold.customer_metrics": CUSTOMER_METRICS,
}

LAYERS: dict[str, tuple[str, ...]] = {
    "bronze": ("raw.kafka_events", "raw.cdc_orders", "raw.cdc_customers", "raw.cdc_order_items"),
    "silver": ("silver.orders", "silver.customers", "silver.order_items"),
    "gold": ("gold.daily_revenue", "gold.customer_metrics"),
}
