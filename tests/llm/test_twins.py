"""Registered queries against their SQL twins."""

from __future__ import annotations

import os

import pytest

from tidelog.llm.queries import ORACLE, REGISTRY
from workload.check import compare, connect

SMALL = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no tables")
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_twin(spark, name):
    same, note = compare(REGISTRY[name](spark, SMALL), connect(SMALL), ORACLE[name])
    assert same, note
