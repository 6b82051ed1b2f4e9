"""Physical plans: what reaches the scan, what is shuffled, and how hot keys are split."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

from tidelog import schemas
from tidelog.operators import envelope, gold, serving
from tidelog.operators.changelog import transition_audit
from tidelog.operators.metrics import sustained
from tidelog.operators.silver import silver_order_items
from tidelog.session import new_folder
from workload import domain, logs

SMALL = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no tables")

def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def saved(df, name):
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_revenue_filters_and_columns_reach_the_scan(spark):
    orders = saved(domain.silver_orders(spark, SMALL), "orders")
    text = gold.daily_revenue(orders, domain.priced_items(spark, SMALL))._jdf.queryExecution().toString()
    assert "In(status, [completed,confirmed,delivered,shipped])" in text
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", text)
    assert any("order_id" in s for s in scans) and not any("updated_at" in s for s in scans)


def test_silver_filters_reach_a_landed_bronze_table(spark):
    from tidelog.operators.silver import silver_orders

    bronze = saved(logs.bronze_orders(spark, SMALL), "bronze")
    text = silver_orders(bronze, "ignore", 1000)._jdf.queryExecution().toString()
    assert "LessThanOrEqual(ts_ms,1000)" in text and "In(op, [c,r,u])" in text
    read = re.search(r"FileScan parquet \[([^\]]*)\]", text).group(1)
    assert "after" in read and "cdc_id" not in read and "source_db" not in read


def test_each_json_level_is_read_once(spark):
    bronze = saved(logs.bronze_orders(spark, SMALL), "bronze")
    text = plan(envelope.accepted(bronze, schemas.ORDERS))
    assert text.count("Generate json_tuple") == 1 and "from_json" not in text
    raw = saved(logs.order_records(spark, SMALL), "records")
    text = plan(logs.bronze(raw))
    assert text.count("Generate json_tuple") == 2


def test_top_customers_sort_no_more_than_the_result(spark):
    assert "TakeOrderedAndProject" in plan(serving.top_customers(domain.gold_customer_metrics(spark, SMALL)))


def test_ordered_scans_shuffle_twice_and_never_join(spark):
    samples = saved(
        domain.table(spark, SMALL, "events").select(
            F.col("event_type").alias("series"), F.col("ts").cast("timestamp").alias("ts"), "event_id", "value"
        ),
        "samples",
    )
    text = plan(sustained(samples, ["series"], F.col("value") > 30, 60, "event_id"))
    assert text.count("Exchange hashpartitioning") == 2 and "Join" not in text
    bronze = saved(logs.bronze_orders(spark, SMALL), "bronze")
    text = plan(transition_audit(bronze, "log"))
    assert text.count("Exchange hashpartitioning") == 3 and "Join" not in text
    assert plan(transition_audit(bronze, "image")).count("Exchange hashpartitioning") == 1


def test_items_of_a_hot_order_are_split_over_tasks(spark, no_broadcast):
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        n = 60_000
        order = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
        image = F.struct(
            F.col("id").alias("item_id"),
            order.alias("order_id"),
            F.lit(1).alias("product_id"),
            F.lit(2).alias("quantity"),
            F.lit("1.50").alias("unit_price"),
        )
        bronze = spark.range(0, n, 1, 8).select(
            F.lit("c").alias("op"),
            F.lit(1).cast("bigint").alias("ts_ms"),
            F.lit(None).cast("string").alias("before"),
            F.to_json(image).alias("after"),
            F.current_timestamp().alias("ingested_at"),
        )
        orders = spark.range(n).select(
            F.col("id").cast("string").alias("order_id"), F.current_timestamp().alias("created_at")
        )
        out = silver_order_items(saved(bronze, "items"), saved(orders, "orders"))
        rows = out.collect()
        assert len(rows) == n and all(r.order_created_at is not None for r in rows)
        assert "skew=true" in plan(out)
    finally:
        for name in small:
            spark.conf.unset(name)
