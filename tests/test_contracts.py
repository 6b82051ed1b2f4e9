from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators import contracts as c

GOOD = {
    "order_id": 1,
    "customer_id": 2,
    "status": "pending",
    "total_amount": "10.50",
    "created_at": "2024-05-01T10:00:00Z",
    "updated_at": "2024-05-01T10:00:00.123+02:00",
}


def _broken(spark, image, contract=c.ORDER_CONTRACT):
    text = image if isinstance(image, str) or image is None else json.dumps(image)
    df = spark.createDataFrame([(1, text)], "n int, image string")
    return sorted((r.field, r.rule) for r in c.violations(df, "image", contract).collect())


def test_valid_image_has_no_violation(spark):
    assert _broken(spark, GOOD) == []
    assert _broken(spark, {**GOOD, "total_amount": 10.5}) == []
    assert _broken(spark, {**GOOD, "total_amount": 10}) == []
    assert _broken(spark, None) == []


@pytest.mark.parametrize(
    "change, expected",
    [
        ({"order_id": "1"}, ("order_id", "type")),
        ({"order_id": 1.5}, ("order_id", "type")),
        ({"customer_id": None}, ("customer_id", "type")),
        ({"status": "lost"}, ("status", "enum")),
        ({"status": 3}, ("status", "type")),
        ({"total_amount": "abc"}, ("total_amount", "type")),
        ({"total_amount": True}, ("total_amount", "type")),
        ({"created_at": "yesterday"}, ("created_at", "format")),
        ({"created_at": "2024-13-01T10:00:00Z"}, ("created_at", "format")),
        ({"coupon": "X"}, ("coupon", "unexpected")),
    ],
)
def test_each_rule_reports_its_field(spark, change, expected):
    assert _broken(spark, {**GOOD, **change}) == [expected]


def test_missing_field_and_text_that_is_no_object(spark):
    assert _broken(spark, {k: v for k, v in GOOD.items() if k != "status"}) == [("status", "required")]
    assert _broken(spark, "not json") == [("", "not an object")]
    assert _broken(spark, "[1]") == [("", "not an object")]


def test_customer_and_item_rules(spark):
    customer = {
        "customer_id": 1,
        "name": "n" * 256,
        "email": "no-at-sign",
        "created_at": "2024-05-01T10:00:00Z",
        "updated_at": "2024-05-01T10:00:00Z",
    }
    assert _broken(spark, customer, c.CUSTOMER_CONTRACT) == [("email", "format"), ("name", "max_length")]
    item = {
        "item_id": 1,
        "order_id": 1,
        "product_id": 1,
        "quantity": 0,
        "unit_price": 1.5,
        "created_at": "2024-05-01T10:00:00Z",
    }
    assert _broken(spark, item, c.ORDER_ITEM_CONTRACT) == [("quantity", "minimum")]


def test_observed_evolution_names_every_difference(spark):
    first = {k: v for k, v in GOOD.items() if k != "updated_at"}
    images = [json.dumps({**first, "coupon": "X"}), json.dumps({**first, "order_id": "1"})]
    df = spark.createDataFrame([(i,) for i in images], "image string")
    seen = {r.field: (r.records, r.change, r.compatible) for r in c.observed_evolution(df, "image", c.ORDER_CONTRACT).collect()}
    assert seen["updated_at"] == (0, "removed", False)
    assert seen["order_id"] == (2, "retyped", False)
    assert seen["coupon"] == (1, "added", True)
    assert seen["status"] == (2, "unchanged", True)


def test_schema_changes():
    old = T.StructType().add("a", "string").add("b", "long")
    assert c.schema_changes(old, old) == []
    assert c.schema_changes(old, T.StructType(list(old.fields)).add("n", "string")) == [("n", "added", True)]
    assert c.schema_changes(old, T.StructType().add("a", "string")) == [("b", "removed", False)]
    renamed = T.StructType().add("a", "string").add("bb", "long", False)
    assert c.schema_changes(old, renamed) == [("b", "removed", False), ("bb", "added", False)]
    with pytest.raises(ValueError, match="a retyped"):
        c.check_compatible(old, T.StructType().add("a", "long").add("b", "long"))


def test_freshness_counts_late_windows(spark):
    df = spark.createDataFrame(
        [("2024-01-01 00:01:00", "2024-01-01 00:02:59"), ("2024-01-01 00:02:00", "2024-01-01 00:04:00")],
        "e string, o string",
    ).select(F.col("e").cast("timestamp").alias("window_end"), F.col("o").cast("timestamp").alias("emitted_at"))
    assert tuple(c.freshness(df).first()) == (2, 1, 1, 120_000_000)
