"""Silver and Gold kept by batches against the same tables rebuilt from all records."""

from __future__ import annotations

import random

import pytest
from changes import bronze, change, order, records
from pyspark.sql import functions as F

from tidelog import schemas
from tidelog.operators import gold, silver
from tidelog.operators.envelope import parse_envelope, topic_values
from tidelog.plans.incremental import Views
from tidelog.sources.hashed import HashedTable

AS_OF = "2024-08-01"
RUN = "2024-06-01 00:00:00"


def order_at(rng, n):
    day = f"2024-05-{rng.randint(1, 6):02d}T10:00:00Z"
    return order(n, rng.choice(["pending", "confirmed", "shipped", "cancelled"]), rng.choice(["10.00", "3.50", None, "0.01"]), customer_id=n % 4, created_at=day)


def item(rng, n):
    return {"item_id": n, "order_id": rng.randint(1, 12), "product_id": 3, "quantity": rng.choice([1, 2, None]), "unit_price": rng.choice(["4.50", "0.10"])}


def customer(n):
    return {"customer_id": n, "name": "Ada", "email": "a@example.com", "created_at": "2024-05-01T10:00:00Z", "updated_at": "2024-05-01T10:00:00Z"}


def random_log(seed):
    """Messages of orders and items with moves, deletes and broken images, and their entity names."""
    rng = random.Random(seed)
    logs = {"orders": [], "order_items": [], "customers": [change("c", after=customer(n)) for n in range(3)]}
    for t in range(60):
        image = order_at(rng, rng.randint(1, 12))
        op = rng.choice("cuuud")
        if rng.random() < 0.1:
            image["total_amount"] = "abc"
        logs["orders"].append(change(op, before=image, after=None if op == "d" else image, ts_ms=1000 + t, txn=t))
        image = item(rng, rng.randint(1, 15))
        op = rng.choice("cuud")
        logs["order_items"].append(change(op, before=image, after=None if op == "d" else image, ts_ms=1000 + t, txn=t))
    return logs


def all_bronze(spark, logs):
    return {name: parse_envelope(topic_values(records(spark, values, f"cdc.{name}")), RUN) for name, values in logs.items()}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def check(views, seen):
    orders = silver.silver_orders(seen["orders"])
    customers = silver.silver_customers(seen["customers"])
    items = silver.silver_order_items(seen["order_items"])
    assert rows(views.silver_table(schemas.ORDERS)) == rows(orders)
    assert rows(views.silver_table(schemas.CUSTOMERS)) == rows(customers)
    assert rows(views.silver_table(schemas.ORDER_ITEMS)) == rows(items)
    assert rows(views.daily_revenue(RUN)) == rows(gold.daily_revenue(orders, items, RUN))
    assert rows(views.customer_metrics(AS_OF, RUN)) == rows(gold.customer_metrics(orders, customers, AS_OF, RUN))


def test_batches_equal_a_rebuild(spark, tmp_path):
    views, full = Views(spark, str(tmp_path), rows=4), all_bronze(spark, random_log(1))
    # The third batch brings old records again, the fourth is late: it is older than the third.
    cuts = {1: "offset < 20", 2: "offset between 20 and 35", 3: "offset between 30 and 40 or offset >= 50", 4: "offset between 41 and 49"}
    seen = {name: df.where("false") for name, df in full.items()}
    for n, cut in cuts.items():
        batch = {name: df.where(cut) for name, df in full.items()}
        assert views.refresh(batch, f"run {n}") == n
        seen = {name: df.unionByName(batch[name]) for name, df in seen.items()}
        if n == 4:
            check(views, seen)


def test_the_first_day_moves_when_its_order_goes(spark, tmp_path):
    views = Views(spark, str(tmp_path))
    first, later = (order(n, "confirmed", "1.00", created_at=f"2024-05-0{n}T10:00:00Z") for n in (1, 2))
    views.refresh({"orders": bronze(spark, [change("c", after=first, ts_ms=1), change("c", after=later, ts_ms=1)])})
    days = lambda: {str(r.report_date): (r.order_count, r.new_customers) for r in views.daily_revenue(RUN).collect()}
    assert days() == {"2024-05-01": (1, 1), "2024-05-02": (1, 0)}
    views.refresh({"orders": bronze(spark, [change("d", before=first, ts_ms=2)], offsets=[2])})
    assert days() == {"2024-05-02": (1, 1)}
    assert [r.days for r in views.buyers.state().collect()][0][0].n == 1


def test_a_broken_batch_is_finished_under_its_name(spark, tmp_path, monkeypatch):
    views, full = Views(spark, str(tmp_path), rows=4), all_bronze(spark, random_log(5))
    one, two = ({name: df.where(cut) for name, df in full.items()} for cut in ("offset < 30", "offset >= 30"))
    views.refresh(one, "one")
    merge = HashedTable.merge

    def dies(self, *args):
        if self.path.endswith("day-sums"):
            raise RuntimeError("gone")
        return merge(self, *args)

    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(HashedTable, "merge", dies)
        views.refresh(two, "two")
    # Readers still see the first batch, in all tables.
    assert views.version() == 1
    check(views, one)
    with pytest.raises(ValueError, match="finish that one first"):
        views.refresh(two, "three")
    assert views.refresh(two, "two") == 2
    check(views, {name: df.where("true") for name, df in full.items()})


def test_a_small_batch_reads_few_buckets(spark, tmp_path):
    views = Views(spark, str(tmp_path), rows=10)
    many = [change("c", after=order(n, "confirmed", "1.00", customer_id=n, created_at=f"2024-05-{n % 28 + 1:02d}T10:00:00Z"), ts_ms=1) for n in range(200)]
    views.refresh({"orders": bronze(spark, many)})
    views.refresh({"orders": bronze(spark, [change("u", after=order(3, "cancelled", "1.00"), ts_ms=2)], offsets=[900])})
    for t in (views.silver(schemas.ORDERS), views.facts, views.buyers):
        d = t.directory()
        own = [b for b, (home, _) in d.homes.items() if home == 2]
        assert d.buckets >= 20 and 1 <= len(own) <= 4
    assert views.days.changes(2).where(F.col("sign") == 1).count() == 1
