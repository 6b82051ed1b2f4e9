"""The settled lane: late changes, rejected images, batches that come again."""

from __future__ import annotations

from decimal import Decimal

import pytest
from changes import bronze, change, order, records

from tidelog import schemas
from tidelog.operators import silver
from tidelog.session import new_folder
from tidelog.sources.hashed import HashedTable
from tidelog.sources.topics import Topic
from tidelog.streaming.batches import BatchLog
from tidelog.streaming.jobs import start_order_revenue
from tidelog.streaming.keyed import accepted_changes
from tidelog.streaming.settled import SettledWindows, start_settled_windows
from tidelog.streaming.windows import tumbling_revenue


class Lanes:
    """A topic with the quick lane and the settled one."""

    def __init__(self, spark):
        self.spark, self.root = spark, new_folder(spark, "lanes")
        self.source, self.sink = Topic("cdc.orders", path=f"{self.root}/in"), Topic("w", path=f"{self.root}/out")
        self.lane = SettledWindows(spark, f"{self.root}/lane", rows=2)
        self.offset = self.dropped = 0

    def feed(self, *values, quick=False):
        offsets = range(self.offset, self.offset + len(values))
        self.offset += len(values)
        records(self.spark, values, offsets=offsets).write.mode("append").parquet(self.source.path)
        start_settled_windows(self.spark, self.source, self.lane, f"{self.root}/settled").awaitTermination()
        if quick:
            query = start_order_revenue(self.spark, self.source, self.sink, f"{self.root}/quick")
            query.awaitTermination()
            self.dropped += sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
        return self

    def settled(self):
        return {r.window_start.minute: (r.order_count, r.total_revenue) for r in self.lane.settled().collect()}


@pytest.fixture
def lanes(spark):
    return Lanes(spark)


def test_late_rows_correct_windows_that_are_out(lanes, spark):
    first, second = order(1, amount="10.00"), order(2, amount="5.00")
    lanes.feed(change("c", after=first, ts_ms=1), change("c", after=second, ts_ms=1), quick=True)
    assert lanes.settled() == {}
    lanes.feed(change("c", after=order(3, minute=9), ts_ms=9), quick=True)
    assert lanes.settled() == {0: (2, Decimal("15.00"))}
    # Both come behind the watermark: a new order of the first minute, and the end of an old one.
    lanes.feed(change("c", after=order(4, amount="1.00"), ts_ms=1), change("d", before=first, ts_ms=20), quick=True)
    assert lanes.dropped > 0
    assert lanes.settled() == {0: (2, Decimal("6.00"))}
    lanes.feed(change("d", before=second, ts_ms=21), change("d", before=order(4), ts_ms=22))
    assert lanes.settled() == {}
    revisions = sorted((r.window_start.minute, r.revision, r.order_count) for r in lanes.lane.emissions().collect())
    assert revisions == [(0, 2, 2), (0, 3, 2), (0, 4, 0)]


def test_a_rejected_update_leaves_the_accepted_image_as_in_silver(lanes, spark):
    good, broken = order(1, "confirmed", "9.00"), order(1, "confirmed", "nine", minute=1)
    log = [change("c", after=good, ts_ms=1), change("u", good, broken, ts_ms=2), change("c", after=order(2, minute=30), ts_ms=3), change("u", broken, order(1, "shipped", "4.00", minute=2), ts_ms=4)]
    state = lambda n: silver.silver_orders(bronze(spark, log[:n]))
    for n, value in enumerate(log, 1):
        lanes.feed(value)
        windows = {r.window_start.minute: (r.order_count, r.total_revenue) for r in tumbling_revenue(state(n)).collect()}
        assert {m: w for m, w in windows.items() if m < 29 and n > 2} == {m: w for m, w in lanes.settled().items()}
    assert lanes.settled() == {2: (1, Decimal("4.00"))}


def test_old_and_repeated_changes_give_nothing(spark):
    one, two = order(1, "confirmed", "9.00"), order(1, "confirmed", "8.00")
    rows = bronze(spark, [change("u", one, two, ts_ms=2), change("c", after=one, ts_ms=1), change("u", one, two, ts_ms=2)], offsets=[1, 0, 1])
    got = [(r.sign, str(r.total_amount)) for r in accepted_changes(rows, schemas.ORDERS).collect()]
    assert got == [(1, "8.00")]


def test_a_batch_that_died_is_finished_once(lanes, spark, monkeypatch):
    lanes.feed(change("c", after=order(1), ts_ms=1), change("c", after=order(2, minute=5), ts_ms=1))
    assert lanes.settled() == {0: (1, Decimal("10.00"))}
    for at in (HashedTable, BatchLog):
        name = "merge" if at is HashedTable else "commit"
        real = getattr(at, name)

        def dies(self, *args, real=real):
            real(self, *args)
            raise RuntimeError("gone")

        with monkeypatch.context() as patch, pytest.raises(Exception, match="gone"):
            patch.setattr(at, name, dies)
            lanes.feed(change("c", after=order(10 + lanes.offset, amount="1.00"), ts_ms=2))
        lanes.feed(change("c", after=order(20 + lanes.offset, minute=40), ts_ms=2))
    assert lanes.settled()[0] == (3, Decimal("12.00"))


def test_batches_are_written_once_and_read_whole(spark, tmp_path):
    log = BatchLog(spark, str(tmp_path / "b"))
    rows = spark.range(3)
    assert log.read(rows.schema).count() == 0 and log.note() is None
    log.take(rows, 0)
    log.write(spark.range(7), 1)  # killed between write and commit
    assert log.read(rows.schema).count() == 3
    log.take(spark.range(4), 1)
    log.take(spark.range(99), 1)
    assert log.read(rows.schema).count() == 7 and log.committed(1) and not log.committed(2)
