from __future__ import annotations

import os
import re

import pytest

import __spark_entry__ as entry_points
from workload.check import compare, connect
from workload.oracle import ORACLE
from workload.queries import REGISTRY

SMALL = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_a_twin():
    assert set(REGISTRY) == set(ORACLE)
    assert set(REGISTRY) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry_gives_rows(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_its_sql_twin_and_plans_cleanly(spark, duck, name):
    df = REGISTRY[name](spark, SMALL)
    same, note = compare(df, duck, ORACLE[name])
    assert same, note
    text = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|NestedLoopJoin|EvalPython|MapInPandas", text)
    windows = [line for line in text.splitlines() if re.search(r"[+-] Window \[", line)]
    assert not any(", [], " in line for line in windows)
