"""Valid intervals and point-in-time joins against plain loops, over several ranges."""

from __future__ import annotations

import random

import pytest
from changes import bronze, change, order

from tidelog import schemas
from tidelog.operators import history, silver
from tidelog.operators.history import accepted_versions, as_of_join, states_at

SCHEMA = "k string, ts_ms long, txn_id long, offset long, op string, v int"


@pytest.fixture
def rows():
    """A hot key with most of the versions, ties in time, and keys of one version."""
    rng = random.Random(4)
    found = []
    for i in range(240):
        key = "hot" if rng.random() < 0.6 else f"k{rng.randrange(12)}"
        found.append((key, rng.randrange(60), rng.choice([None, 1, 2]), i, rng.choice("cuud"), i))
    return found


def order_of(r):
    return (r[1], (r[2] is not None, r[2] or 0), r[3])


def test_intervals_and_states(spark, rows, monkeypatch):
    monkeypatch.setattr(history, "RANGE", 20)
    got = history.history(spark.createDataFrame(rows, SCHEMA).repartition(3), "k").collect()
    expected = {}
    for key in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == key), key=order_of)
        expected |= {r[3]: (r[1], n[1] if n else None) for r, n in zip(mine, [*mine[1:], None], strict=True)}
    assert {r.offset: (r.valid_from, r.valid_to) for r in got} == expected
    times = [-1, 0, 17, 30, 59, 99]
    states = states_at(history.history(spark.createDataFrame(rows, SCHEMA), "k"), times).collect()
    wanted = []
    for t in times:
        for key in {r[0] for r in rows}:
            last = max((r for r in rows if r[0] == key and r[1] <= t), key=order_of, default=None)
            if last and last[4] != "d":
                wanted.append((t, key, last[5]))
    assert sorted((r.as_of, r.k, r.v) for r in states) == sorted(wanted)


def test_point_in_time_join(spark, rows, monkeypatch):
    monkeypatch.setattr(history, "RANGE", 15)
    rng = random.Random(5)
    facts = [(rng.choice(["hot", "k1", "k2", "none", None]), rng.choice([*range(-2, 62), None]), i) for i in range(150)]
    facts += [("hot", 70, 1000 + i) for i in range(60)]  # ranges without any version
    joined = as_of_join(spark.createDataFrame(facts, "k string, at long, n int"), spark.createDataFrame(rows, SCHEMA), "k", "at")
    got = {r.n: r.version and r.version.v for r in joined.collect()}
    expected = {}
    for key, at, n in facts:
        last = max((r for r in rows if r[0] == key and at is not None and r[1] <= at), key=order_of, default=None)
        expected[n] = last and last[5]
    assert got == expected


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert history.history(none, "k").collect() == []
    joined = as_of_join(spark.createDataFrame([("a", 1)], "k string, at long"), none, "k", "at").collect()
    assert [(r.k, r.version) for r in joined] == [("a", None)]


def test_states_equal_silver_as_of(spark):
    log = [change("c", after=order(n, "pending"), ts_ms=10 * n) for n in range(5)] + [change("u", order(n), order(n, "shipped", minute=n), ts_ms=10 * n + 5) for n in range(5)]
    log += [change("d", before=order(1), ts_ms=30), change("u", order(2), order(2, amount="abc"), ts_ms=31)]
    rows = bronze(spark, log)
    times = [0, 14, 29, 30, 99]
    states = states_at(history.history(accepted_versions(rows, schemas.ORDERS), "order_id"), times).collect()
    for t in times:
        state = silver.silver_orders(rows, as_of_ms=t).collect()
        assert sorted((r.order_id, r.status) for r in states if r.as_of == t) == sorted((r.order_id, r.status) for r in state)
