from __future__ import annotations

from decimal import Decimal

import pytest
from changes import change, order, records

from tidelog import schemas
from tidelog.operators.envelope import parse_envelope, topic_values
from tidelog.session import ROCKSDB, new_folder
from tidelog.sources.topics import Topic, from_messages
from tidelog.streaming.jobs import start_bronze, start_order_revenue
from tidelog.streaming.windows import order_revenue


class Run:
    """A topic folder, and a stream that is restarted for every batch of records."""

    def __init__(self, spark):
        root = new_folder(spark, "stream")
        self.spark, self.root = spark, root
        self.source = Topic("cdc.orders", path=f"{root}/in")
        self.sink = Topic("gold.windows", path=f"{root}/out")
        self.dropped = 0

    def feed(self, values, first_offset):
        offsets = list(range(first_offset, first_offset + len(values)))
        records(self.spark, values, offsets=offsets).write.mode("append").parquet(self.source.path)
        return self

    def windows(self):
        query = start_order_revenue(self.spark, self.source, self.sink, f"{self.root}/ckpt")
        query.awaitTermination()
        for progress in query.recentProgress:
            for state in progress["stateOperators"]:
                self.dropped += state["numRowsDroppedByWatermark"]
        rows = from_messages(self.spark.read.parquet(self.sink.path), schemas.REVENUE_WINDOW)
        return sorted((r.window_start.minute, r.order_count, r.total_revenue) for r in rows.collect())


@pytest.fixture
def run(spark):
    return Run(spark)


def _batch(spark, values):
    rows = parse_envelope(topic_values(records(spark, values)))
    out = order_revenue(rows).collect()
    return sorted((r.window_start.minute, r.order_count, r.total_revenue) for r in out)


def test_window_is_emitted_once_the_watermark_passes_its_end(run):
    values = [change("c", after=order(1)), change("c", after=order(2, amount="5.00"))]
    assert run.feed(values, 0).windows() == []
    assert run.feed([change("c", after=order(3, minute=2))], 2).windows() == [(0, 2, Decimal("15.00"))]
    assert run.feed([change("c", after=order(4, minute=9))], 3).windows() == [
        (0, 2, Decimal("15.00")),
        (2, 1, Decimal("10.00")),
    ]


def test_update_moves_an_order_to_the_window_of_its_last_change(run, spark):
    values = [
        change("c", after=order(1)),
        change("u", order(1), order(1, amount="20.00", minute=1)),
        change("c", after=order(2, minute=9)),
    ]
    # The first window ends empty and is left out.
    assert run.feed(values, 0).windows() == [(1, 1, Decimal("20.00"))]
    assert _batch(spark, values) == [(1, 1, Decimal("20.00")), (9, 1, Decimal("10.00"))]


def test_delete_takes_the_order_out(run):
    values = [
        change("c", after=order(1)),
        change("c", after=order(2, amount="1.00")),
        change("d", before=order(1)),
        change("c", after=order(3, minute=9)),
    ]
    assert run.feed(values, 0).windows() == [(0, 1, Decimal("1.00"))]


def test_redelivered_update_counts_once(run, spark):
    update = change("u", order(1), order(1, amount="20.00"))
    create = change("c", after=order(1))
    later = change("c", after=order(2, minute=9))
    run.feed([create, update], 0).feed([update], 1).feed([later], 2)
    assert run.windows() == [(0, 1, Decimal("20.00"))]


def test_retraction_for_a_closed_window_is_late_and_dropped(run, spark):
    create = change("c", after=order(1))
    assert run.feed([create, change("c", after=order(2, minute=5))], 0).windows() == [
        (0, 1, Decimal("10.00"))
    ]
    update = change("u", order(1), order(1, minute=6))
    out = run.feed([update, change("c", after=order(3, minute=9))], 2).windows()
    # The order is in its old window, which was final, and in the new one.
    assert out == [(0, 1, Decimal("10.00")), (5, 1, Decimal("10.00")), (6, 1, Decimal("10.00"))]
    assert run.dropped > 0


def test_rows_within_the_delay_still_count(run):
    values = [change("c", after=order(1, updated_at="2024-05-01T10:01:03Z"))]
    late = [change("c", after=order(2, updated_at="2024-05-01T10:00:59Z")), change("c", after=order(3, minute=9))]
    run.feed(values, 0).windows()
    assert run.feed(late, 1).windows() == [(0, 1, Decimal("10.00")), (1, 1, Decimal("10.00"))]


def test_state_lives_in_rocksdb(run, spark):
    run.feed([change("c", after=order(1))], 0).windows()
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == ROCKSDB


def test_restarted_bronze_stream_appends_only_new_records(spark):
    root = new_folder(spark, "bronze")
    topic = Topic("cdc.orders", path=f"{root}/in")
    for first, values in ((0, [change("c", after=order(1)), None]), (2, [change("d", before=order(1))]), (3, [])):
        numbers = list(range(first, first + len(values)))
        records(spark, values, offsets=numbers).write.mode("append").parquet(topic.path)
        start_bronze(spark, topic, f"{root}/out", f"{root}/ckpt").awaitTermination()
    landed = spark.read.parquet(f"{root}/out")
    assert sorted(r.offset for r in landed.collect()) == [0, 2]
    assert landed.columns[:9] == schemas.BRONZE_CDC.fieldNames()


def test_batch_average_has_two_decimals(spark):
    rows = parse_envelope(
        topic_values(records(spark, [change("c", after=order(n, amount=a)) for n, a in enumerate(("0.01", "0.01", "0.03"))]))
    )
    out = order_revenue(rows)
    assert out.schema == schemas.REVENUE_WINDOW or out.columns == schemas.REVENUE_WINDOW.fieldNames()
    assert out.first().avg_order_value == Decimal("0.02")
