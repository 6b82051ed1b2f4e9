from __future__ import annotations

import datetime
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidelog.quality import gate
from tidelog.quality import expectations as x
from tidelog.quality.suites import LAYERS, SUITES

# One good and one bad table per expectation type, over columns a (int), b (int), s (text), t (date).
D = datetime.date
GOOD = [(1, 1, "ABC", D(2024, 2, 1)), (2, 1, "DEF", D(2024, 1, 1)), (3, 2, "GHI", D(2023, 1, 1))]
CASES = [
    (x.row_count(3), [], 0),
    (x.not_null("a"), [(None, 1, "ABC", D(2024, 2, 1))], 1),
    (x.unique("a"), [(1, 1, "ABC", D(2024, 2, 1))], 2),
    (x.matches("s", "^[A-Z]{3}$"), [(9, 1, "abc", D(2024, 2, 1))], 1),
    (x.in_set("b", (1, 2)), [(9, 3, "ABC", D(2024, 2, 1))], 1),
    (x.between("a", 1, 8), [(9, 1, "ABC", D(2024, 2, 1))], 1),
    (x.length_between("s", 1, 3), [(9, 1, "ABCD", D(2024, 2, 1))], 1),
    (x.unique_share("a", 1.0, 1.0), [(1, 1, "ABC", D(2024, 2, 1))], 1),
    (x.max_between("t", "2024-01-01", "2024-12-31"), [(9, 1, "ABC", D(2025, 2, 1))], 1),
    (x.compound_unique("b", "s"), [(9, 1, "ABC", D(2024, 2, 1))], 2),
    (x.at_least("a", "b"), [(9, 10, "ABC", D(2024, 2, 1))], 1),
]


def _table(spark, rows):
    return spark.createDataFrame(rows, "a int, b int, s string, t date")


@pytest.mark.parametrize("rule, extra, unexpected", CASES, ids=lambda v: getattr(v, "kind", ""))
def test_each_type_passes_on_good_rows_and_fails_on_a_bad_one(spark, rule, extra, unexpected):
    good = x.evaluate(_table(spark, GOOD), "t", [rule]).first()
    assert good.success and good.unexpected == 0
    bad_rows = GOOD + extra if extra else GOOD[:2]
    bad = x.evaluate(_table(spark, bad_rows), "t", [rule]).first()
    assert not bad.success
    assert bad.unexpected == (unexpected or 1)


def test_column_list_must_match_in_order(spark):
    df = _table(spark, GOOD)
    right, wrong = x.columns("a", "b", "s", "t"), x.columns("b", "a", "s", "t")
    assert [r.success for r in x.evaluate(df, "t", [right, wrong]).collect()] == [True, False]


def test_mostly_tolerates_a_share_of_bad_values(spark):
    df = _table(spark, GOOD + [(9, 1, "abc", D(2024, 2, 1))])
    loose, tight = x.matches("s", "^[A-Z]{3}$", 0.75), x.matches("s", "^[A-Z]{3}$", 0.76)
    assert [r.success for r in x.evaluate(df, "t", [loose, tight]).collect()] == [True, False]


def test_nulls_count_only_for_not_null(spark):
    df = _table(spark, [(None, None, None, None), (1, 1, "ABC", D(2024, 2, 1))])
    rules = [
        x.not_null("s"),
        x.unique("s"),
        x.matches("s", "^A"),
        x.in_set("s", ("ABC",)),
        x.between("a", 1),
        x.length_between("s", 3),
        x.at_least("a", "b"),
        x.compound_unique("a", "s"),
    ]
    rows = x.evaluate(df, "t", rules).sort("position").collect()
    assert [r.evaluated for r in rows] == [2, 1, 1, 1, 1, 1, 1, 1]
    assert [r.success for r in rows] == [False] + [True] * 7


def test_empty_tables_fail_only_where_something_must_exist(spark):
    rules = [x.row_count(1), x.not_null("a"), x.unique("a"), x.max_between("t", "2024-01-01"), x.unique_share("a", 1.0, 1.0)]
    rows = x.evaluate(_table(spark, []), "t", rules).sort("position").collect()
    assert [r.success for r in rows] == [False, True, True, False, False]


def test_suites_hold_all_expectations():
    assert {name: len(rules) for name, rules in SUITES.items()} == {
        "raw.kafka_events": 16,
        "raw.cdc_orders": 14,
        "raw.cdc_customers": 13,
        "raw.cdc_order_items": 13,
        "silver.orders": 15,
        "silver.customers": 11,
        "silver.order_items": 14,
        "gold.daily_revenue": 18,
        "gold.customer_metrics": 15,
    }
    assert sum(map(len, SUITES.values())) == 129
    assert sorted(n for names in LAYERS.values() for n in names) == sorted(SUITES)


def test_one_scan_serves_all_row_rules(spark):
    rules = [x.not_null("a"), x.between("b", 0), x.matches("s", "A"), x.max_between("t", "2020-01-01")]
    df = spark.read.schema("a int, b int, s string, t date").parquet(_saved(spark))
    plan = x.evaluate(df, "t", rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def _saved(spark):
    from tidelog.session import new_folder

    path = new_folder(spark, "quality")
    _table(spark, GOOD).write.parquet(path)
    return path


def _results(spark, outcomes):
    rows = [("gold", "gold.x", n, "not_null", f"c{n}", 1, 0, ok) for n, ok in enumerate(outcomes)]
    return spark.createDataFrame(
        rows,
        "layer string, suite string, position int, expectation string, column string, evaluated bigint, unexpected bigint, success boolean",
    )


def test_any_failure_turns_the_gate_red(spark):
    assert gate.is_green(_results(spark, [True, True]))
    assert not gate.is_green(_results(spark, [True, False]))
    assert not gate.is_green(_results(spark, []))
    summary = {r.layer: (r.evaluated, r.passed, r.failed, r.success) for r in gate.gate_summary(_results(spark, [True, False])).collect()}
    assert summary == {"gold": (2, 1, 1, False), "all": (2, 1, 1, False)}
    row = gate.suite_summary(_results(spark, [True, False])).first()
    assert row.failures == ["not_null c1"]


def test_an_error_while_checking_is_never_a_pass(spark):
    with pytest.raises(Exception):
        gate.is_green(gate.run_gate({}))


def _metrics(spark, rows):
    return spark.createDataFrame(rows, "customer_id string, days_since_last_order int, is_churned boolean, total_orders bigint")


def test_churn_violations(spark):
    rows = [("a", 91, False, 1), ("b", 90, False, 1), ("c", 200, True, 1), ("d", None, False, 0)]
    assert gate.churn_violations(_metrics(spark, rows)).first().violations == 1


def test_orphans_and_grain(spark):
    child = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    parent = spark.createDataFrame([("b",)], "id string")
    assert [tuple(r) for r in gate.orphans(child, parent, "k", "id").collect()] == [("a", 2)]
    assert [tuple(r) for r in gate.duplicate_grain(child, "k").collect()] == [("a", 2)]


def test_model_tests_report_each_defect(spark):
    daily = spark.createDataFrame(
        [(D(2024, 1, 1), "USD", 1, Decimal("1.00")), (D(2024, 1, 1), "USD", None, Decimal("1.00"))],
        "report_date date, currency string, order_count bigint, net_revenue decimal(18,2)",
    )
    metrics = _metrics(spark, [("a", 1, None, 1), ("a", 1, True, 1), ("z", 1, True, 1)])
    customers = spark.createDataFrame([("a",)], "customer_id string")
    rows = gate.model_tests(daily, metrics, customers).collect()
    assert len(rows) == 10
    failed = {(r.test, r.column): r.failures for r in rows if not r.success}
    assert failed == {
        ("not_null", "order_count"): 1,
        ("not_null", "is_churned"): 1,
        ("unique", "customer_id"): 1,
        ("relationships", "customer_id"): 1,
        ("unique_grain", "report_date,currency"): 1,
    }


def test_smoke_checks_need_rows(spark):
    empty = spark.createDataFrame([], "a int")
    rows = gate.smoke_checks({"x": empty, "y": spark.range(2).toDF("a")}).collect()
    assert {(r["check"], r.value, r.success) for r in rows} == {
        ("x is non-empty", 0, False),
        ("y is non-empty", 2, True),
    }


def test_hot_value_in_a_unique_column_is_counted_before_the_shuffle(spark):
    df = spark.range(0, 90_000, 1, 8).select(F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(0).alias("a"))
    row = x.evaluate(df, "t", [x.unique("a")]).first()
    assert (row.evaluated, row.unexpected, row.success) == (90_000, 30_000, False)


LOOKUP_RULES = [
    x.row_count(1),
    x.columns("k", "a", "t", "u"),
    x.columns("k", "t", "a", "u"),
    x.not_null("k"),
    x.not_null("t", mostly=0.5),
    x.between("a", 1, 3, mostly=0.6),
    x.unique("a"),
    x.unique("u"),
    x.unique_share("t", 0.2, 0.9),
    x.compound_unique("a", "u"),
    x.max_between("a", 1, 9),
    x.max_between("u", 1, 7),
    x.at_least("u", "a"),
]
# Keys without a match, with one and with several; NULL keys on both sides; equal values under several keys.
LOOKUP_ROWS = [("x", 1), ("x", 2), ("x", 2), ("y", 3), ("y", None), ("z", 4), ("z", 4), (None, 5), (None, 1), ("w", 9)]
LOOKUP_FOUND = [("x", 3, 1), ("y", 2, 5), ("y", 2, 5), ("y", None, 2), ("w", None, None), (None, 1, 8), (None, 1, 8), ("v", 7, 9)]


@pytest.mark.parametrize("rows", [LOOKUP_ROWS, []], ids=["rows", "none"])
@pytest.mark.parametrize("found", [LOOKUP_FOUND, LOOKUP_FOUND[:1], []], ids=["repeated", "once", "none"])
@pytest.mark.parametrize("size", ["10mb", "-1"], ids=["broadcast", "merge"])
def test_suite_of_a_lookup_equals_that_of_the_joined_table(spark, rows, found, size):
    from tidelog.session import setting

    table = x.Lookup(
        spark.createDataFrame(rows, "k string, a int"),
        spark.createDataFrame(found, "k string, t int, u int"),
        "k",
        ("k", "a", "t", "u"),
    )
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", size):
        joined = x.evaluate(table.table(), "t", LOOKUP_RULES).sort("position").collect()
        assert x.evaluate_lookup(table, "t", LOOKUP_RULES).sort("position").collect() == joined


def test_suite_of_items_moves_no_item_rows_for_its_join(spark, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    from tidelog.session import setting
    from workload.queries import REGISTRY

    plans = []

    def keep(df):
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        plans.append(df._jdf.queryExecution().explainString(mode))

    write = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: (keep(self._df), write(self, *a, **k))[1])
    # Orders of this size are too large to broadcast, as they are at scale.
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "10kb"):
        keep(REGISTRY["dq_suite_silver_order_items"](spark, "/root/testdata/sf0.01"))
    moved = re.findall(r"\) Exchange *\nInput \[\d+\]: \[(.*)\]", "\n".join(plans))
    assert moved
    names = {re.sub(r"#.*", "", column) for columns in moved for column in columns.split(", ")}
    assert not names & {"quantity", "unit_price", "line_total"}
    assert not any({"item_id", "order_id"} <= {re.sub(r"#.*", "", c) for c in columns.split(", ")} for columns in moved)


def test_gated_tables_are_packed(spark, monkeypatch):
    import pyarrow.parquet as pq

    from workload import queries

    names = LAYERS["gold"]
    monkeypatch.setattr(queries, "QUALITY_TABLES", {n: lambda spark, _: spark.range(0, 3, 1, 1).selectExpr("uuid() a") for n in names})
    tables = queries.quality_tables(spark, "", ("gold",))
    for name in names:
        assert tables[name].count() == 3
        files = [f.removeprefix("file:").replace("///", "/") for f in tables[name].inputFiles()]
        assert files and {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}
