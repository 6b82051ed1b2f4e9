"""The offset ledger against plain sets of offsets."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from changes import bronze, change, order
from tidelog.plans.medallion import append_new, ledger_of
from tidelog.sources import ledger as ledgers
from tidelog.sources.ledger import CHUNK, Ledger, intervals, marked, merged, not_covered


def rows_of(spark, offsets, partition=0, topic="t"):
    if isinstance(offsets, range):
        found = spark.range(offsets.start, offsets.stop).select(F.col("id").alias("offset"))
    else:
        found = spark.createDataFrame([(o,) for o in offsets], "offset long")
    return found.select(F.lit(topic).alias("topic"), F.lit(partition).alias("partition"), "offset", F.lit(1).alias("n"))


def islands(offsets):
    found = []
    for o in sorted(offsets):
        if found and found[-1][1] == o - 1:
            found[-1][1] = o
        else:
            found.append([o, o])
    return [tuple(f) for f in found]


def held(state, partition=0):
    return sorted((r.first_offset, r.last_offset) for r in intervals(state).where(F.col("partition") == partition).collect())


def test_intervals_join_over_chunks_and_runs(spark, tmp_path):
    ledger, seen = Ledger(spark, str(tmp_path / "l")), set()
    rng = random.Random(4)
    batches = [
        range(5, CHUNK + 10), range(CHUNK * 3, CHUNK * 5), [*range(5), CHUNK * 7], range(CHUNK + 10, CHUNK * 3 - 1),
        [rng.randrange(CHUNK * 8) for _ in range(300)], [CHUNK * 3 - 1],
    ]
    for n, batch in enumerate(batches):
        rows = rows_of(spark, batch)
        assert {r.offset for r in ledger.missing(rows).collect()} == set(batch) - seen
        ledger.begin(str(n))
        ledger.end(str(n), rows)
        seen |= set(batch)
        assert held(ledger.state()) == islands(seen)
        if n == 3:
            ledger.compact()
            assert held(ledger.state()) == islands(seen)
    whole = ledger.state().where("bits is null").collect()
    assert [(r.first, r.last) for r in whole] == [(0, 4)]


def test_partitions_and_topics_are_apart_and_a_new_partition_is_all_missing(spark):
    state = merged(marked(rows_of(spark, [1, 2]).unionByName(rows_of(spark, [7], 1)).unionByName(rows_of(spark, [9], 0, "u"))))
    asked = rows_of(spark, [1, 7, 9]).unionByName(rows_of(spark, [1, 7, 9], 1)).unionByName(rows_of(spark, [1, 9], 0, "u")).unionByName(rows_of(spark, [1], 2))
    left = {(r.topic, r.partition, r.offset) for r in not_covered(asked, state).collect()}
    assert left == {("t", 0, 7), ("t", 0, 9), ("t", 1, 1), ("t", 1, 9), ("u", 0, 1), ("t", 2, 1)}


def test_generations_count_only_when_sealed(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "l"))
    assert ledger.generation() == 0 and ledger.missing(rows_of(spark, [1])).count() == 1
    ledger.begin("a")
    ledger.end("a", rows_of(spark, [1, 2]))
    # A compaction that died half-way.
    ledger._append(marked(rows_of(spark, [50])).withColumns({"run": F.lit(None).cast("string"), "state": F.lit(None).cast("string")}), 2)
    assert ledger.generation() == 1 and held(ledger.state()) == [(1, 2)]
    ledger.begin("b")
    assert ledger.unfinished() == ["b"]
    ledger.compact()
    assert ledger.generation() == 3 and held(ledger.state()) == [(1, 2)] and ledger.unfinished() == ["b"]


def test_many_runs_are_compacted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledgers, "RUNS", 3)
    ledger = Ledger(spark, str(tmp_path / "l"))
    for n in range(4):
        ledger.begin(str(n))
        ledger.end(str(n), rows_of(spark, [n]))
    assert ledger.generation() == 2 and held(ledger.state()) == [(0, 3)] and ledger.unfinished() == []


@pytest.fixture
def changes(spark):
    return bronze(spark, [change("c", after=order(n, "shipped")) for n in range(20)])


def test_a_run_that_broke_off_is_made_up_for(spark, tmp_path, changes, monkeypatch):
    path = str(tmp_path / "raw")
    assert append_new(changes.where("offset < 5"), "raw.cdc_orders", path, "2024-06-01 00:00:00") == 5
    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(Ledger, "end", lambda *_: (_ for _ in ()).throw(RuntimeError("gone")))
        append_new(changes.where("offset < 9"), "raw.cdc_orders", path, "2024-06-02 00:00:00")
    assert append_new(changes, "raw.cdc_orders", path, "2024-06-03 00:00:00") == 11
    assert append_new(changes, "raw.cdc_orders", path) == 0
    landed = spark.read.parquet(path)
    assert sorted(r.offset for r in landed.collect()) == list(range(20))
    assert held(ledger_of(spark, path).state()) == [(0, 19)]


def test_a_table_without_ledger_gets_one(spark, tmp_path, changes):
    path = str(tmp_path / "raw")
    changes.where("offset in (1, 4)").withColumn("ingested_at_day", F.to_date("ingested_at")).write.partitionBy("ingested_at_day").parquet(path)
    assert append_new(changes, "raw.cdc_orders", path) == 18


def test_looking_up_never_reads_the_landed_table(spark, tmp_path, changes):
    path = str(tmp_path / "raw")
    append_new(changes, "raw.cdc_orders", path)
    files = ledger_of(spark, path).missing(changes).inputFiles()
    assert files and all(f"{path}-offsets/" in f for f in files)
