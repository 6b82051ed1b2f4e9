"""Tables published together, comparison of tables, and suites kept by parts."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidelog.quality import difference as tree
from tidelog.quality.difference import difference, unequal_nodes
from tidelog.quality.expectations import between, columns, compound_unique, evaluate, max_between, not_null, row_count, unique, unique_share
from tidelog.quality.states import SuiteState
from tidelog.sources.manifest import Conflict, Manifest


def test_readers_see_all_tables_of_a_version(spark, tmp_path):
    manifest = Manifest(spark, str(tmp_path / "m"))
    assert manifest.version() == 0 and manifest.tables() == {}
    for name in ("a1", "b1", "b2"):
        spark.range(int(name[1])).write.parquet(f"{tmp_path}/{name}")
    assert manifest.publish({"a": f"{tmp_path}/a1", "b": f"{tmp_path}/b1"}, 0) == 1
    assert manifest.publish({"b": f"{tmp_path}/b2"}, 1) == 2
    assert {n: df.count() for n, df in manifest.read("a", "b").items()} == {"a": 1, "b": 2}
    assert {n: df.count() for n, df in manifest.read(version=1).items()} == {"a": 1, "b": 1}
    with pytest.raises(Conflict, match="version 2 is there"):
        manifest.publish({"a": "x"}, 1)
    with pytest.raises(KeyError, match="c"):
        manifest.read("a", "c")


def test_of_two_publishers_one_wins_for_all(spark, tmp_path, monkeypatch):
    manifest = Manifest(spark, str(tmp_path / "m"))
    first = Manifest.version
    other = [(1, "0" * 32, "t", "theirs")]

    def raced(self):
        seen = first(self)
        if not seen and other:
            spark.createDataFrame([other.pop()], "version long, token string, name string, path string").write.mode("append").parquet(self.path)
        return seen

    monkeypatch.setattr(Manifest, "version", raced)
    with pytest.raises(Conflict, match="another publisher"):
        manifest.publish({"t": "ours"}, 0)
    assert manifest.tables() == {"t": "theirs"}


def test_difference_counts_columns_and_missing_keys(spark, monkeypatch):
    monkeypatch.setattr(tree, "FANOUT", 4)
    a = {i: (i % 7, f"v{i}", None if i % 5 else 1.0) for i in range(300)}
    b = {i: v for i, v in a.items() if i % 50} | {1000: (1, "x", None), 5: (9, "v5", 1.0), 7: (0, "z", 2.0), None: (0, "n", None)}
    table = lambda rows: spark.createDataFrame([(k, *v) for k, v in rows.items()], "id long, x int, y string, z double")
    got = {r["column"]: r["rows"] for r in difference(table(a), table(b), ["id"]).collect()}
    shared = a.keys() & b.keys()
    expected = {"only in first": len(a.keys() - b.keys()), "only in second": len(b.keys() - a.keys())}
    expected |= {name: sum(a[k][i] != b[k][i] for k in shared) for i, name in enumerate("xyz")}
    assert got == expected
    assert unequal_nodes(table(a), table(a).orderBy(F.desc("id")), ["id"], ["id", "x", "y", "z"]) == []
    one = unequal_nodes(table(a), table(a).where("id <> 11"), ["id"], ["id", "x", "y", "z"])
    assert len(one) == 1


def test_a_suite_kept_by_parts_equals_the_whole_suite(spark, tmp_path):
    rng = random.Random(2)
    schema = "k string, n int, at timestamp"
    rows = [(rng.choice([None, f"k{rng.randrange(90)}"]), rng.choice([None, *range(9)]), None) for _ in range(150)]
    table = spark.createDataFrame(rows, schema).withColumn("at", F.timestamp_seconds(F.lit(1_700_000_000) + F.coalesce("n", F.lit(0))))
    table.withColumn("part", F.pmod(F.monotonically_increasing_id(), F.lit(3))).write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    rules = (
        row_count(1), columns("k", "n", "at"), not_null("k", mostly=0.2), unique("k"), unique_share("k", 0.1, 0.9), between("n", 0, 5),
        max_between("at", "2023-01-01T00:00:00"), compound_unique("k", "n"),
    )
    state = SuiteState(spark, f"{tmp_path}/s", "t", rules, rows=20)
    for n in range(3):
        state.append(table.where(F.col("part") == n).drop("part"), n)
        if n == 1:
            state.append(table.where(F.col("part") == n).drop("part"), n)  # comes again
    expected = evaluate(table.drop("part"), "t", rules).collect()
    assert sorted(map(tuple, state.results().collect())) == sorted(map(tuple, expected))
