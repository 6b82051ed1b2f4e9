"""Silver and Gold tables as views over the order, customer and line-item tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.columns import money, typed_null
from tidelog.operators.gold import customer_metrics, daily_revenue
from tidelog.operators.silver import line_total
from tidelog.quality.expectations import Lookup

RUN_TS = "2024-06-01 00:00:00"
AS_OF = "2001-08-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_status(code: Column) -> Column:
    return (
        F.when(code == "F", "delivered").when(code == "O", "confirmed").otherwise("pending")
    )


def silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    created = F.col("o_orderdate").cast("timestamp")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        order_status(F.col("o_orderstatus")).alias("status"),
        money(F.col("o_totalprice")).alias("total_amount"),
        typed_null("string").alias("currency"),
        created.alias("created_at"),
        created.alias("updated_at"),
        F.lit("c").alias("_source_op"),
        F.lit(RUN_TS).cast("timestamp").alias("_ingested_at"),
    )


def email_of(name: Column) -> Column:
    return F.concat(F.lower(F.replace(name, F.lit("#"), F.lit("."))), F.lit("@example.com"))


def silver_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    created = F.timestamp_seconds(F.lit(788918400) + F.col("c_custkey") * 60)
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("name"),
        email_of(F.col("c_name")).alias("email"),
        created.alias("created_at"),
        created.alias("updated_at"),
        F.lit("c").alias("_source_op"),
        F.lit(RUN_TS).cast("timestamp").alias("_ingested_at"),
    )


def item_id() -> Column:
    return F.concat_ws(
        "-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    )


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        item_id().alias("item_id"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        money(F.col("l_extendedprice")).alias("unit_price"),
    )


def order_items_lookup(spark: SparkSession, sf_dir: str) -> Lookup:
    """Silver items as rows that look up when their order was created."""
    created = silver_orders(spark, sf_dir).select(
        "order_id", F.col("created_at").alias("order_created_at")
    )
    items = raw_items(spark, sf_dir).select(
        "*", line_total(), F.lit(RUN_TS).cast("timestamp").alias("_ingested_at")
    )
    names = (
        "item_id",
        "order_id",
        "product_id",
        "quantity",
        "unit_price",
        "line_total",
        "order_created_at",
        "_ingested_at",
    )
    return Lookup(items, created, "order_id", names)


def silver_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_items_lookup(spark, sf_dir).table()


def priced_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items without the order columns, for queries that need no join."""
    return raw_items(spark, sf_dir).select("*", line_total())


def gold_daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_revenue(silver_orders(spark, sf_dir), priced_items(spark, sf_dir), RUN_TS)


def gold_customer_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_metrics(
        silver_orders(spark, sf_dir), silver_customers(spark, sf_dir), AS_OF, RUN_TS
    )
