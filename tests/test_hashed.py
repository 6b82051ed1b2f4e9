"""Hashed tables against plain dictionaries: growth, merges, versions and changes."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidelog.session import setting
from tidelog.sources.hashed import Directory, HashedTable, bucket_of, source_of

SCHEMA = StructType().add("k", "string").add("at", "long").add("v", "long")


def table(spark, tmp_path, rows=50):
    return HashedTable(spark, str(tmp_path / "t"), SCHEMA, ("k",), rows)


def put(t, rows, run=None):
    df = t.spark.createDataFrame([(k, at, v) for k, (at, v) in rows.items()], SCHEMA)
    return t.merge(df, t.newest(["at"]), run)


def state(t, version=None):
    return {r.k: (r["at"], r.v) for r in t.state(version).collect()}


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 13])
def test_buckets_split_off_from_one_other(spark, n):
    keys = spark.range(500).select(F.col("id").cast("string").alias("k"))
    rows = keys.select(bucket_of(["k"], n).alias("a"), *[bucket_of(["k"], n + m).alias(f"b{m}") for m in (1, 2, 7)]).collect()
    assert all(0 <= r.a < n for r in rows) and len({r.a for r in rows}) == n
    for m in (1, 2, 7):
        assert all(source_of(r[f"b{m}"], n) == r.a for r in rows)


def test_merges_equal_a_dictionary_and_the_table_grows(spark, tmp_path):
    t, expected, versions = table(spark, tmp_path), {}, [{}]
    rng = random.Random(6)
    for batch in range(5):
        rows = {str(rng.randrange(400)): (rng.randrange(batch + 3), rng.randrange(9)) for _ in range(120)}
        if batch == 3:
            rows = {None: (1, 1), "7": (99, 1)}
        assert put(t, rows) == batch + 1
        before = dict(expected)
        for k, (at, v) in rows.items():
            if k not in expected or at > expected[k][0]:
                expected[k] = (at, v)
        assert state(t) == expected
        versions.append(dict(expected))
        signed = sorted(((r.sign, r.k, r["at"], r.v) for r in t.changes(batch + 1).collect()), key=repr)
        moved = {k for k in expected if before.get(k) != expected[k]}
        assert signed == sorted([(1, k, *expected[k]) for k in moved] + [(-1, k, *before[k]) for k in moved if k in before], key=repr)
    d = t.directory()
    assert d.buckets == -(-d.rows // 50) or d.buckets >= d.rows / 50
    assert d.rows == len(expected) and max(r for _, r in d.homes.values()) < 200
    assert all(state(t, v) == versions[v] for v in range(6))


def test_untouched_buckets_are_neither_read_nor_written(spark, tmp_path):
    t = table(spark, tmp_path, rows=20)
    put(t, {str(k): (1, k) for k in range(400)})
    first = t.directory()
    assert first.buckets == 20
    put(t, {"3": (2, 0)})
    second = t.directory()
    own = [b for b, (home, _) in second.homes.items() if home == 2]
    # One row more may make the table split once; two buckets are written then, besides that of the key.
    assert 1 <= len(own) <= 3
    assert {b: h for b, h in second.homes.items() if b not in own} == {b: h for b, h in first.homes.items() if b not in own}
    plan = t._read(first, own[:1])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1][:200]
    files = t._read(first, own[:1]).select("_metadata.file_path").distinct().collect()
    assert {f"bucket={b}" for b in own[:1]} == {f.file_path.split("/")[-2] for f in files}


def test_a_merge_that_died_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path)
    put(t, {"a": (1, 1)})
    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        real = HashedTable._write

        def dies(self, *args):
            real(self, *args)
            raise RuntimeError("gone")

        patch.setattr(HashedTable, "_write", dies)
        put(t, {"a": (2, 2), "b": (2, 2)})
    assert state(t) == {"a": (1, 1)} and t.version() == 1
    put(t, {"c": (1, 1)})
    assert state(t) == {"a": (1, 1), "c": (1, 1)}


def test_empty_tables_and_merges(spark, tmp_path):
    t = table(spark, tmp_path)
    assert state(t) == {} and t.directory() == Directory()
    assert put(t, {}) == 1 and state(t) == {} and t.changes(1).collect() == []
    put(t, {"a": (1, 1)}, "second")
    put(t, {})
    assert state(t) == {"a": (1, 1)} and t.changes(3).collect() == [] and t.directory(2).run == "second"
    with pytest.raises(ValueError, match="no version"):
        t.state(9)


def test_a_merge_shuffles_each_side_once(spark, tmp_path):
    t = table(spark, tmp_path, rows=20)
    put(t, {str(k): (1, k) for k in range(400)})
    with setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"):
        changes = spark.createDataFrame([("1", 5, 5)], SCHEMA)
        rows = t._rebuilt(t.directory(), 2, [3, 4], changes, t.newest(["at"]), 20, 2)
        plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "FullOuter" in plan


@pytest.mark.parametrize("many", [1, 9], ids=["few", "hot"])
def test_the_last_of_several_changes_of_a_key_counts(spark, tmp_path, many):
    t, rng, expected = table(spark, tmp_path, rows=20), random.Random(8), {}
    for _ in range(2):
        rows = [(str(n), rng.randrange(50), n) for n in range(100)] + [("7", 100 + rng.randrange(900), 0) for _ in range(100 * many)] + [(None, 3, 3), (None, 2, 2)]
        rows += [(k, at - 1, -1) for k, at, _ in rows[:40]]
        t.merge(spark.createDataFrame(rows, SCHEMA), t.newest(["at"]), None, ["at"])
        for k, at, v in rows:
            if k not in expected or at > expected[k][0]:
                expected[k] = (at, v)
        assert state(t) == expected and t.directory().rows == 101


def test_few_changes_of_a_key_are_moved_once_and_many_are_cut_first(spark, tmp_path, monkeypatch):
    plans = []
    write = HashedTable._write

    def seen(self, rows, version):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        write(self, rows, version)

    monkeypatch.setattr(HashedTable, "_write", seen)
    t, path = table(spark, tmp_path, rows=20), str(tmp_path / "changes")
    for n, hot in enumerate((0, 2000)):
        spark.range(500).selectExpr("string(id) k", "id at", "id v").union(spark.range(hot).selectExpr("'1' k", "id + 600 at", "id v")).write.parquet(f"{path}{n}")
        t.merge(spark.read.parquet(f"{path}{n}"), t.newest(["at"]), None, ["at"])
    assert [plan.count("REPARTITION_BY_NUM") for plan in plans] == [2, 2]
    assert [plan.count("ENSURE_REQUIREMENTS") for plan in plans] == [0, 1]


def test_versions_are_packed(spark, tmp_path):
    import pyarrow.parquet as pq

    t = table(spark, tmp_path)
    put(t, {"a": (1, 1)})
    files = list((tmp_path / "t" / "data").rglob("*.parquet"))
    assert files and all(pq.ParquetFile(f).metadata.row_group(0).column(0).compression == "ZSTD" for f in files)
