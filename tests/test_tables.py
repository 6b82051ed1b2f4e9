from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidelog import schemas
from tidelog.quality.suites import SUITES
from tidelog.session import configure, new_folder, scratch_root
from tidelog.sources import tables as t
from tidelog.sources.topics import Topic, from_messages, read_records, to_messages, write_messages


def _days(spark, rows):
    return spark.createDataFrame(rows, "k string, d string").select(
        "k", F.col("d").cast("timestamp").alias("at")
    )


def test_writes_count_their_rows_and_lay_out_partitions(spark):
    path = new_folder(spark, "write")
    df = _days(spark, [("a", "2024-01-01 05:00:00"), ("b", "2024-01-01 06:00:00"), ("c", "2024-02-01 00:00:00")])
    layout = (t.days("at"), t.months("at"), t.bucket(4, "k"))
    assert t.write_table(df, path, layout) == 3
    assert t.write_table(df.limit(0), path, layout) == 0
    back = spark.read.parquet(path)
    assert back.count() == 3
    assert {str(r[0]) for r in back.select("at_month").collect()} == {"2024-01-01", "2024-02-01"}
    assert all(0 <= r[0] < 4 for r in back.select("k_bucket_4").collect())
    assert t.read_table(spark, path).filter("at_day = DATE'2024-01-01'").count() == 2


def test_partition_filters_prune_files(spark):
    path = new_folder(spark, "prune")
    t.write_table(_days(spark, [("a", "2024-01-01"), ("b", "2024-01-02")]), path, (t.days("at"),))
    plan = spark.read.parquet(path).filter("at_day = DATE'2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(at_day" in plan


def test_partition_overwrite_leaves_other_days_and_full_refresh_does_not(spark):
    path = new_folder(spark, "overwrite")
    layout = (t.days("at"),)
    t.write_table(_days(spark, [("a", "2024-01-01"), ("b", "2024-01-02")]), path, layout)
    t.write_table(_days(spark, [("c", "2024-01-02")]), path, layout, "partitions")
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == ["a", "c"]
    t.write_table(_days(spark, [("d", "2024-01-02")]), path, layout, "overwrite")
    assert [r.k for r in spark.read.parquet(path).collect()] == ["d"]


def test_row_that_moves_to_another_partition_needs_a_full_refresh(spark):
    path = new_folder(spark, "moved")
    early = _days(spark, [("a", None)])
    late = _days(spark, [("a", "2024-01-01")])
    layout = (t.days("at"),)
    t.write_table(early, path, layout)
    t.write_table(late, path, layout, "partitions")
    assert spark.read.parquet(path).count() == 2
    t.write_table(late, path, layout, "overwrite")
    assert spark.read.parquet(path).count() == 1


def test_bucket_upsert_rewrites_only_touched_buckets(spark):
    path = new_folder(spark, "upsert")
    schema = "k string, v string, op string, ts_ms bigint"
    state = spark.range(200).select(
        F.col("id").cast("string").alias("k"), F.lit("old").alias("v"), F.lit("c").alias("op"), F.lit(1).cast("bigint").alias("ts_ms")
    )
    assert t.bucket_upsert(spark, state, path, "k", ["ts_ms"], 8) == 200
    files = set(spark.read.parquet(path).inputFiles())
    change = spark.createDataFrame([("7", "new", "u", 2)], schema)
    rewritten = t.bucket_upsert(spark, change, path, "k", ["ts_ms"], 8)
    assert 1 <= rewritten < 200
    after = spark.read.parquet(path)
    assert after.count() == 200 and after.filter("k = '7'").first().v == "new"
    assert len(files & set(after.inputFiles())) == len(files) - 1
    assert t.bucket_upsert(spark, change.limit(0), path, "k", ["ts_ms"], 8) == 0
    with pytest.raises(ValueError):
        t.bucket_upsert(spark, change, path, "k", ["ts_ms"], 5)


def test_tables_are_created_once_and_listed(spark):
    for _ in range(2):
        names = t.create_tables(spark)
    assert sorted(names) == sorted(SUITES)
    columns = spark.table("gold.daily_revenue").columns
    assert columns[: len(schemas.GOLD_DAILY_REVENUE)] == schemas.GOLD_DAILY_REVENUE.fieldNames()
    assert "report_date_month" in columns


def test_published_view_moves_in_one_step(spark):
    one, two = new_folder(spark, "v1"), new_folder(spark, "v2")
    spark.range(1).write.parquet(one)
    spark.range(2).write.parquet(two)
    spark.sql("CREATE DATABASE IF NOT EXISTS served")
    counts = []
    for path in (one, two):
        t.publish(spark, "served.numbers", path)
        counts.append(spark.table("served.numbers").count())
    assert counts == [1, 2]


def test_messages_round_trip_through_a_topic(spark):
    topic = Topic("gold.windows", path=new_folder(spark, "topic"))
    rows = spark.createDataFrame([("a", 1.5), ("b", None)], "currency string, rate double")
    messages = to_messages(rows, "currency", topic.name)
    stamped = messages.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        "topic",
        F.lit(0).alias("partition"),
        F.lit(1).cast("bigint").alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )
    write_messages(stamped, topic)
    back = from_messages(read_records(spark, topic), rows.schema)
    assert sorted((r.currency, r.rate, r.offset) for r in back.collect()) == [("a", 1.5, 1), ("b", None, 1)]
    assert read_records(spark, Topic("other", path=topic.path)).count() == 0


def test_topic_is_kafka_or_folder():
    with pytest.raises(ValueError):
        Topic("x")
    with pytest.raises(ValueError):
        Topic("x", "broker:9092", "/data")
    options = Topic("x", "broker:9092").kafka_options()
    assert options["startingOffsets"] == "earliest" and options["failOnDataLoss"] == "true"
    assert Topic("x", "broker:9092", data_loss="ignore").kafka_options()["failOnDataLoss"] == "false"
    with pytest.raises(ValueError):
        Topic("x", "broker:9092", data_loss="maybe")


def test_settings_and_scratch(spark):
    configure(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert new_folder(spark, "x").startswith(scratch_root(spark))
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
