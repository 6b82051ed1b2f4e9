from __future__ import annotations

import datetime
import json

import pytest
from changes import RECORD_COLUMNS, change, order

from tidelog import schemas
from tidelog.plans.medallion import published, run_batch, table_path
from tidelog.session import new_folder
from tidelog.sources.ledger import Ledger
from tidelog.sources.topics import Topic

AT = "2024-05-01T10:00:00Z"
TS = datetime.datetime(2024, 5, 1, 10)


class Shop:
    """Topic folders of a small shop."""

    def __init__(self, spark):
        self.spark, self.root = spark, new_folder(spark, "shop")
        names = {"orders": "cdc.orders", "customers": "cdc.customers", "order_items": "cdc.order_items", "events": "raw.events"}
        self.topics = {k: Topic(n, path=f"{self.root}/topics/{n}") for k, n in names.items()}
        self.offsets = dict.fromkeys(names, 0)

    def send(self, entity, *values):
        rows = []
        for value in values:
            rows.append((b"{}", value.encode(), self.topics[entity].name, 0, self.offsets[entity], TS))
            self.offsets[entity] += 1
        self.spark.createDataFrame(rows, RECORD_COLUMNS).write.mode("append").parquet(self.topics[entity].path)

    def run(self, run_id, **more):
        return run_batch(self.spark, self.topics, f"{self.root}/lake", run_id, "2024-06-01", "2024-06-01 00:00:00", **more)

    def read(self, run_id, name):
        return self.spark.read.parquet(table_path(f"{self.root}/lake/versions/{run_id}", name))


@pytest.fixture
def shop(spark):
    shop = Shop(spark)
    customer = {"customer_id": 7, "name": "Ada", "email": "ada@example.com", "created_at": AT, "updated_at": AT}
    item = {"item_id": 1, "order_id": 1, "product_id": 3, "quantity": 2, "unit_price": "4.50", "created_at": AT}
    shop.send("customers", change("c", after=customer))
    shop.send(
        "orders",
        change("c", after=order(1, "pending", "0.00"), ts_ms=1_714_557_600_000),
        change("u", order(1, "pending", "0.00"), order(1, "confirmed", "9.00"), ts_ms=1_714_557_600_000),
        change("c", after=order(2, "shipped", "5.00"), ts_ms=1_714_557_600_001),
    )
    shop.send("order_items", change("c", after=item))
    shop.send("events", json.dumps({"k": 1}))
    return shop


def test_green_batch_builds_and_publishes_every_layer(shop, spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    done = shop.run("one", publish_as={"gold.daily_revenue": "shop.daily"})
    failed = spark.read.parquet(done.results).filter("not success")
    assert done.green, [tuple(r) for r in failed.collect()]
    assert done.rows["raw.cdc_orders"] == 3 and done.rows["silver.orders"] == 2
    day = spark.table("shop.daily").first()
    assert (day.order_count, day.item_count, str(day.gross_revenue), day.new_customers) == (2, 1, "14.00", 1)
    metrics = shop.read("one", "gold.customer_metrics").first()
    assert (metrics.customer_id, metrics.total_orders, str(metrics.total_revenue)) == ("7", 2, "14.00")
    assert spark.read.parquet(done.results).count() == 130


def test_second_run_lands_only_new_records(shop, spark):
    shop.run("one")
    shop.send(
        "orders",
        change("d", before=order(2, "shipped", "5.00"), ts_ms=1_714_557_700_000),
        change("u", order(1, "confirmed", "9.00"), order(1, "confirmed", "nine"), ts_ms=1_714_557_700_000),
    )
    done = shop.run("two")
    assert done.rows["raw.cdc_orders"] == 2 and done.rows["raw.cdc_customers"] == 0
    assert done.rows["quarantine.orders"] == 1 and done.rows["quarantine.customers"] == 0
    assert [r.reason for r in shop.read("two", "quarantine.orders").collect()] == ["bad total_amount"]
    assert [r.order_id for r in shop.read("two", "silver.orders").collect()] == ["1"]
    assert shop.read("one", "silver.orders").count() == 2


def test_holes_of_a_broken_run_are_filled(shop, spark, monkeypatch):
    shop.send("orders", *[change("c", after=order(n, "shipped", "1.00"), ts_ms=1_714_557_700_000) for n in range(3, 12)])
    path = table_path(f"{shop.root}/lake", "raw.cdc_orders")

    def dies(self, run, landed):
        raise RuntimeError("the driver is gone")

    with monkeypatch.context() as patch, pytest.raises(RuntimeError, match="is gone"):
        patch.setattr(Ledger, "end", dies)
        shop.run("one")
    landed = spark.read.parquet(path)
    keep = landed.filter("offset in (1, 5)").cache()
    assert keep.count() == 2
    keep.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("ingested_at_day").parquet(path)
    assert shop.run("two").rows["raw.cdc_orders"] == 10
    assert sorted(r.offset for r in spark.read.parquet(path).collect()) == list(range(12))


def test_empty_topic_lands_nothing(shop, spark):
    spark.createDataFrame([], RECORD_COLUMNS).write.mode("overwrite").parquet(shop.topics["order_items"].path)
    done = shop.run("one")
    assert done.rows["raw.cdc_order_items"] == 0 and done.rows["silver.order_items"] == 0
    assert done.rows["silver.orders"] == 2 and not done.green
    assert shop.run("two").rows["raw.cdc_orders"] == 0


def test_red_batch_publishes_nothing(shop, spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    shop.run("one", publish_as={"gold.daily_revenue": "shop.guarded"})
    shop.send("orders", change("c", after=order(3, "confirmed", "-50.00"), ts_ms=1_714_557_800_000))
    done = shop.run("two", publish_as={"gold.daily_revenue": "shop.guarded"})
    assert not done.green
    assert spark.table("shop.guarded").first().order_count == 2
    manifest = published(spark, f"{shop.root}/lake")
    tables = manifest.read("silver.orders", "gold.daily_revenue")
    assert manifest.version() == 1 and tables["silver.orders"].count() == 2 and tables["gold.daily_revenue"].first().order_count == 2
    red = {(r.suite, r.expectation) for r in spark.read.parquet(done.results).filter("not success").collect()}
    assert ("silver.orders", "between") in red


def test_command_line_runs_the_batch_the_gate_and_the_smoke_checks(shop, spark, capsys, monkeypatch):
    import tidelog.__main__ as cli

    monkeypatch.setattr(cli, "build_session", lambda name: spark)
    lake = f"{shop.root}/cli"
    topics = ["--topics", f"{shop.root}/topics"]
    assert cli.main(["batch", *topics, "--root", lake, "--run-id", "r1", "--as-of", "2024-06-01"]) == 0
    assert cli.main(["gate", "--root", lake, "--run-id", "r1", "--layer", "silver"]) == 0
    assert cli.main(["smoke", "--root", lake, "--run-id", "r1"]) == 0
    assert cli.main(["smoke", "--root", lake, "--run-id", "none"]) == 1
    out = capsys.readouterr().out
    assert "gate green" in out and "PASS gold.daily_revenue is non-empty (value=1)" in out
    once = ["--checkpoint", f"{shop.root}/ckpt", "--once"]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert cli.main(["stream", *topics, *once, "--state-partitions", "3"]) == 0
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert cli.main(["bronze", *topics, "--path", f"{shop.root}/b", "--checkpoint", f"{shop.root}/bc", "--once"]) == 0
    assert spark.read.parquet(f"{shop.root}/b").count() == 3


def test_refreshes_equal_a_batch_over_everything(shop, spark, capsys, monkeypatch):
    import tidelog.__main__ as cli
    from tidelog.plans.incremental import Views
    from tidelog.plans.medallion import run_refresh

    lake = f"{shop.root}/standing"
    run_refresh(spark, shop.topics, lake, "2024-06-01 00:00:00")
    shop.send(
        "orders",
        change("d", before=order(2, "shipped", "5.00"), ts_ms=1_714_557_700_000),
        change("u", order(1, "confirmed", "9.00"), order(1, "confirmed", "nine"), ts_ms=1_714_557_700_000),
    )
    refresh, calls = Views.refresh, []

    def dies(self, batch, run):
        calls.append({name: rows.count() for name, rows in batch.items()})
        self.refresh_silver(schemas.ORDERS, batch["orders"], 2, run)
        raise RuntimeError("gone")

    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(Views, "refresh", dies)
        run_refresh(spark, shop.topics, lake, "2024-06-02 00:00:00")
    assert calls == [{"orders": 2, "customers": 0, "order_items": 0}]
    shop.send("orders", change("c", after=order(3, "shipped", "2.00"), ts_ms=1_714_557_900_000))
    monkeypatch.setattr(cli, "build_session", lambda name: spark)
    assert cli.main(["refresh", "--topics", f"{shop.root}/topics", "--root", lake]) == 0
    out = capsys.readouterr().out
    assert "raw.cdc_orders: 1 rows" in out and "views at version 3" in out
    views = Views(spark, f"{lake}/views")
    assert sorted((r.order_id, r.status) for r in views.silver_table(schemas.ORDERS).collect()) == [("1", "confirmed"), ("3", "shipped")]
    day = views.daily_revenue().collect()
    assert [(r.order_count, r.item_count, str(r.gross_revenue), r.new_customers) for r in day] == [(2, 1, "11.00", 1)]
    assert [r.reason for r in spark.read.parquet(table_path(lake, "quarantine.orders")).collect()] == ["bad total_amount"]


def test_command_line_publishes_only_green_versions(shop, spark, monkeypatch):
    import tidelog.__main__ as cli

    monkeypatch.setattr(cli, "build_session", lambda name: spark)
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    batch = ["batch", "--topics", f"{shop.root}/topics", "--root", f"{shop.root}/pub", "--as-of", "2024-06-01", "--publish", "gold.daily_revenue=shop.cli"]
    assert cli.main([*batch, "--run-id", "r1"]) == 0
    assert spark.table("shop.cli").first().order_count == 2
    shop.send("orders", change("c", after=order(3, "confirmed", "-50.00"), ts_ms=1_714_557_800_000))
    assert cli.main([*batch, "--run-id", "r2"]) == 1
    assert spark.table("shop.cli").first().order_count == 2


def test_rates_command(shop, spark, capsys, monkeypatch, tmp_path):
    import tidelog.__main__ as cli

    monkeypatch.setattr(cli, "build_session", lambda name: spark)
    payload = {"base": "EUR", "date": "2026-07-07", "rates": {"USD": 1.1, "SEK": 11.2}}
    (tmp_path / "one.json").write_text(json.dumps(payload))
    topics = ["--topics", str(tmp_path / "topics"), "--payloads", str(tmp_path / "one.json")]
    assert cli.main(["rates", *topics, "--dry-run", "--currencies", "usd"]) == 0
    assert "USD" in capsys.readouterr().out
    assert cli.main(["rates", *topics, "--currencies", "XXX"]) == 1
    assert cli.main(["rates", *topics, "--currencies", ""]) == 0
    sent = spark.read.parquet(str(tmp_path / "topics" / "raw.events"))
    assert sorted(r.key for r in sent.collect()) == ["SEK", "USD"]
