"""Queries behind a revenue dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelog.operators.changelog import latest_per_key


def daily_trend(daily: DataFrame) -> DataFrame:
    return daily.select(
        "report_date", "order_count", "net_revenue", "avg_order_value", "new_customers"
    ).orderBy("report_date")


def top_customers(metrics: DataFrame, n: int = 10) -> DataFrame:
    """Highest revenue first; the customer id breaks ties."""
    return (
        metrics.select(
            "customer_id",
            "total_orders",
            "total_revenue",
            "avg_order_value",
            "days_since_last_order",
            "is_churned",
        )
        .orderBy(F.desc("total_revenue"), "customer_id")
        .limit(n)
    )


def totals(daily: DataFrame) -> DataFrame:
    return daily.agg(
        F.sum("net_revenue").cast("decimal(18,2)").alias("total_revenue"),
        F.sum("order_count").cast("bigint").alias("total_orders"),
    )


def churn_rate(metrics: DataFrame) -> DataFrame:
    return metrics.agg(F.avg(F.when(F.col("is_churned"), 1.0).otherwise(0.0)).alias("rate"))


def latest_emissions(emissions: DataFrame, order: str = "offset") -> DataFrame:
    """Last emitted row per window."""
    return latest_per_key(emissions, "window_start", order)


def recent_windows(windows: DataFrame, hours: int = 6, n: int = 60) -> DataFrame:
    """The last ``n`` windows that start within ``hours`` of the newest one."""
    # The newest window is among the last n, so these n rows tell which of them are recent.
    last = windows.orderBy(F.desc("window_start")).limit(n)
    newest = F.max("window_start").over(Window.partitionBy())
    recent = last.withColumn("_newest", newest).filter(
        F.col("window_start") >= F.col("_newest") - F.expr(f"INTERVAL {int(hours)} HOURS")
    )
    return recent.drop("_newest").orderBy(F.desc("window_start"))


def latest_window(windows: DataFrame) -> DataFrame:
    return windows.orderBy(F.desc("window_start")).limit(1)
