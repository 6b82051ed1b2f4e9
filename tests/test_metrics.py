from __future__ import annotations

import datetime
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidelog.operators import metrics as m

BASE = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)


def _samples(spark, rows):
    """Rows of (series, second, value); several may share their second, ids tell their order.

    The table is shuffled, so that nothing hangs on the order of its rows.
    """
    numbered = [(*row, i) for i, row in enumerate(rows)]
    random.Random(9).shuffle(numbered)
    return spark.createDataFrame(numbered, "series string, second int, value int, id int").select(
        "series",
        "id",
        F.timestamp_seconds(F.lit(int(BASE.timestamp())) + F.col("second")).alias("ts"),
        "value",
    )


def _second(column="ts"):
    return (F.unix_seconds(column) - int(BASE.timestamp())).alias("s")


def _random_rows(seed):
    rng = random.Random(seed)
    rows = []
    for series, n in (("hot", 300), ("a", 40), ("b", 1)):
        rows += [(series, s, rng.randint(0, 9)) for s in sorted(rng.choices(range(7200 if n < 300 else 400), k=n))]
    return rows


@pytest.mark.parametrize("chunk", [60, 600, 3600])
def test_increase_equals_a_plain_scan(spark, chunk):
    rows = _random_rows(1)
    expected, last = defaultdict(int), {}
    for series, second, value in rows:
        slot = (series, second // 3600 * 3600)
        if series in last:
            expected[slot] += value - last[series] if value >= last[series] else value
        else:
            expected[slot] += 0
        last[series] = value
    out = m.increase(_samples(spark, rows), ["series"], 3600, "id", chunk)
    got = {(r.series, r.s): r.increase for r in out.select("series", _second("window_start"), "increase").collect()}
    assert got == dict(expected)


def test_counter_reset_counts_from_zero_and_rate_is_per_second(spark):
    out = m.increase(_samples(spark, [("a", 0, 10), ("a", 10, 15), ("a", 20, 3)]), ["series"], 60, "id")
    row = out.first()
    assert (row.samples, row.increase) == (3, 8)
    assert row.rate == pytest.approx(8 / 60)
    with pytest.raises(ValueError):
        m.increase(_samples(spark, []), ["series"], 90, "id", 60)


@pytest.mark.parametrize("chunk", [1, 7, 60, 1000])
def test_sustained_equals_a_plain_scan(spark, chunk):
    rows = _random_rows(2)
    expected, run = [], None
    for series, second, value in [*rows, ("end", 0, 0)]:
        on = value > 3
        if run and (run[0] != series or not on):
            expected.append(tuple(run))
            run = None
        if on:
            run = run or [series, second, second, 0]
            run[2], run[3] = second, run[3] + 1
    expected = sorted(e for e in expected if e[2] - e[1] >= 30)
    out = m.sustained(_samples(spark, rows), ["series"], F.col("value") > 3, 30, "id", chunk)
    start, end = _second("started_at").alias("a"), _second("ended_at").alias("b")
    assert sorted(tuple(r) for r in out.select("series", start, end, "samples").collect()) == expected
    assert len(expected) > 3


def test_absent_lists_the_empty_slots_of_each_series(spark):
    df = _samples(spark, [("a", 0, 1), ("a", 3600 * 30, 1), ("b", 3600 * 2, 1)])
    out = m.absent(df, ["series"], "2024-01-01 01:00:00", "2024-01-02 07:00:00", 3600)
    got = {(r.series, r.s // 3600) for r in out.select("series", _second("window_start")).collect()}
    assert got == {("a", h) for h in range(1, 30)} | {("b", h) for h in range(1, 31) if h != 2}


def test_sums_top_and_ratio(spark):
    grown = spark.createDataFrame([("x", "p", 5), ("x", "q", 7), ("y", "p", 7)], "s string, l string, increase int")
    assert {tuple(r) for r in m.sum_by(grown, ["l"], "increase").collect()} == {("p", 12), ("q", 7)}
    assert [tuple(r) for r in m.top_series(grown, ["s", "l"], 2).collect()] == [("x", "q", 7), ("y", "p", 7)]
    assert m.increase_above(grown, 5).count() == 2
    left = spark.createDataFrame([("a", 1), ("b", 9), ("c", 1)], "k string, v int")
    right = spark.createDataFrame([("a", 10), ("b", 10), ("c", 0)], "k string, v int")
    assert [r.k for r in m.ratio_below(left, right, ["k"], "v", 0.5).collect()] == ["a"]


def test_staleness_and_combined_alerts(spark):
    df = _samples(spark, [("a", 0, 1), ("a", 50, 1)])
    assert m.staleness(df, ["series"], "2024-01-01 00:01:00").first().idle_us == 10_000_000
    one = spark.createDataFrame([("a",), ("b",)], "k string")
    two = spark.createDataFrame([("b",), ("c",)], "k string")
    assert [r.k for r in m.both(one, two, ["k"]).collect()] == ["b"]
    assert sorted(r.k for r in m.either(one, two, ["k"]).collect()) == ["a", "b", "c"]
