from __future__ import annotations

import random
from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from tidelog import rules, schemas
from tidelog.operators import gold
from tidelog.operators.silver import line_total, silver_order_items

ORDER = (
    "order_id string, customer_id string, status string, total_amount decimal(18,2), "
    "currency string, created_at timestamp, _source_op string"
)


def _orders(spark, rows):
    texts = spark.createDataFrame(
        rows, "order_id string, customer_id string, status string, total_amount string, currency string, created_at string"
    )
    return texts.select(
        "order_id",
        "customer_id",
        "status",
        F.col("total_amount").cast("decimal(18,2)").alias("total_amount"),
        "currency",
        F.col("created_at").cast("timestamp").alias("created_at"),
        F.lit("c").alias("_source_op"),
    )


def _items(spark, rows):
    return spark.createDataFrame(rows, "order_id string, line_total decimal(18,2)")


def test_line_totals_are_exact(spark):
    rng = random.Random(4)
    rows = [(rng.choice((None, rng.randint(0, 500))), rng.choice((None, Decimal(rng.randint(0, 10**9)) / 100))) for _ in range(200)]
    df = spark.createDataFrame(rows, "quantity int, unit_price decimal(18,2)").coalesce(1)
    wanted = [None if q is None or p is None else q * p for q, p in rows]
    assert [r.line_total for r in df.select(line_total()).collect()] == wanted


def test_recency_around_the_limit(spark):
    """One customer for each age of 0 to 200 days: the age is exact and churn starts past the limit."""
    day = date(2023, 11, 5)
    rows = [(str(n), f"c{n}", "completed", "1.00", None, f"{day - timedelta(days=n)} 12:00:00") for n in range(201)]
    stats = {r.customer_id: r for r in gold.order_stats(_orders(spark, rows), day.isoformat()).collect()}
    for n in range(201):
        row = stats[f"c{n}"]
        assert (row.days_since_last_order, row.is_churned) == (n, n > rules.CHURN_AFTER_DAYS)


def test_customer_without_revenue_orders_has_no_recency(spark):
    orders = _orders(spark, [("1", "a", "pending", "5.00", None, "2023-01-01 00:00:00")])
    customers = spark.createDataFrame([("a", "c"), ("b", "u"), ("gone", "d")], "customer_id string, _source_op string")
    rows = {r.customer_id: r for r in gold.customer_metrics(orders, customers, "2023-06-01").collect()}
    assert set(rows) == {"a", "b"}
    assert all(r.days_since_last_order is None and r.is_churned is False and r.total_orders == 0 for r in rows.values())


def test_revenue_statuses():
    assert {"pending", "cancelled"}.isdisjoint(rules.REVENUE_STATUSES)
    assert "completed" in rules.REVENUE_STATUSES


def test_daily_revenue_by_currency(spark):
    orders = _orders(
        spark,
        [
            ("1", "a", "confirmed", "10.00", None, "2024-05-01 23:59:59"),
            ("2", "a", "shipped", "20.00", "EUR", "2024-05-01 08:00:00"),
            ("3", "b", "pending", "99.00", None, "2024-05-01 08:00:00"),
            ("4", "b", "completed", "7.00", None, "2024-05-02 00:00:00"),
            ("5", "c", "completed", "0.01", None, "2024-05-02 00:00:00"),
            ("6", "c", "completed", "0.00", None, "2024-05-02 00:00:00"),
        ],
    )
    items = _items(spark, [("1", Decimal("4.00")), ("1", Decimal("5.00")), ("3", Decimal("1.00"))])
    out = gold.daily_revenue(orders, items, "2024-06-01 00:00:00")
    assert out.columns == schemas.GOLD_DAILY_REVENUE.fieldNames()
    got = sorted(
        (str(r.report_date), r.currency, r.order_count, r.item_count, str(r.gross_revenue), str(r.avg_order_value), r.new_customers)
        for r in out.collect()
    )
    # New customers belong to the day, so both currencies of the first day show the same one.
    assert got == [
        ("2024-05-01", "EUR", 1, 0, "20.00", "20.00", 1),
        ("2024-05-01", "USD", 1, 2, "9.00", "9.00", 1),
        ("2024-05-02", "USD", 3, 0, "7.01", "2.34", 2),
    ]
    assert all(r.gross_revenue == r.net_revenue for r in out.collect())


def test_average_rounds_the_exact_quotient_once(spark):
    from tidelog.functions.columns import average

    df = spark.createDataFrame([(Decimal("0.05"), 10), (Decimal("0.04"), 9)], "t decimal(38,2), n bigint")
    got = [str(r[0]) for r in df.select(average(F.col("t"), F.col("n"))).collect()]
    assert got == ["0.01", "0.00"]


def test_customers_without_orders_stay(spark):
    orders = _orders(spark, [("1", "a", "confirmed", "10.00", None, "2024-05-01 00:00:00")])
    customers = spark.createDataFrame(
        [("a", "c"), ("b", "u"), ("gone", "d")], "customer_id string, _source_op string"
    )
    out = gold.customer_metrics(orders, customers, "2024-08-01", "2024-06-01 00:00:00")
    assert out.columns == schemas.GOLD_CUSTOMER_METRICS.fieldNames()
    rows = {r.customer_id: r for r in out.collect()}
    assert set(rows) == {"a", "b"}
    assert (rows["a"].days_since_last_order, rows["a"].is_churned) == (92, True)
    assert (rows["b"].total_orders, rows["b"].total_revenue, rows["b"].is_churned) == (0, Decimal("0.00"), False)


def test_item_of_an_unknown_order_has_no_creation_time(spark):
    from changes import bronze, change

    rows = bronze(
        spark,
        [change("c", after={"item_id": 1, "order_id": 5, "product_id": 2, "quantity": 3, "unit_price": "1.50"})],
    )
    none = spark.createDataFrame([], "order_id string, created_at timestamp")
    row = silver_order_items(rows, none).first()
    assert (row.order_created_at, row.line_total) == (None, Decimal("4.50"))
    late = spark.createDataFrame([("5",)], "order_id string").withColumn("created_at", F.lit("2024-05-01").cast("timestamp"))
    assert silver_order_items(rows, late).first().order_created_at is not None
