"""Checkpoints per layer, the gate verdict, and the checks outside the suites."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog import rules
from tidelog.quality.expectations import evaluate
from tidelog.quality.suites import LAYERS, SUITES


def churn_violations(metrics: DataFrame) -> DataFrame:
    """Customers past the churn limit that are not flagged."""
    wrong = (F.col("days_since_last_order") > rules.CHURN_AFTER_DAYS) & ~F.col("is_churned")
    return metrics.agg(F.count_if(wrong).alias("violations"))


def _churn_check(metrics: DataFrame) -> DataFrame:
    return churn_violations(metrics).select(
        F.lit("gold.customer_metrics").alias("suite"),
        F.lit(len(SUITES["gold.customer_metrics"])).alias("position"),
        F.lit("churn_consistency").alias("expectation"),
        F.lit("days_since_last_order,is_churned").alias("column"),
        F.lit(1).cast("bigint").alias("evaluated"),
        F.when(F.col("violations") > 0, 1).otherwise(0).cast("bigint").alias("unexpected"),
        (F.col("violations") == 0).alias("success"),
    )


def checkpoint(layer: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Results of every suite of a layer, with the churn check in the gold layer."""
    results = [evaluate(tables[name], name, SUITES[name]) for name in LAYERS[layer]]
    if layer == "gold":
        results.append(_churn_check(tables["gold.customer_metrics"]))
    return reduce(DataFrame.unionByName, results).select(F.lit(layer).alias("layer"), "*")


def run_gate(tables: Mapping[str, DataFrame], layers: tuple[str, ...] = tuple(LAYERS)) -> DataFrame:
    return reduce(DataFrame.unionByName, [checkpoint(layer, tables) for layer in layers])


def _statistics() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("evaluated"),
        F.count_if("success").alias("passed"),
        F.count_if(~F.col("success")).alias("failed"),
        F.bool_and("success").alias("success"),
    ]


def gate_summary(results: DataFrame) -> DataFrame:
    """Counts and verdict per layer and, as layer ``all``, of the gate."""
    return results.rollup("layer").agg(*_statistics()).select(
        F.coalesce("layer", F.lit("all")).alias("layer"),
        "evaluated",
        "passed",
        "failed",
        "success",
    )


def suite_summary(results: DataFrame) -> DataFrame:
    """Counts and verdict per suite, with the failures as text."""
    failure = F.when(~F.col("success"), F.concat_ws(" ", "expectation", "column"))
    return results.groupBy("suite").agg(
        *_statistics(), F.array_sort(F.collect_list(failure)).alias("failures")
    )


def is_green(results: DataFrame) -> bool:
    """Verdict of the gate. An error while checking propagates, so it never counts as a pass."""
    return bool(results.agg(F.coalesce(F.bool_and("success"), F.lit(False))).first()[0])


def duplicate_grain(df: DataFrame, *keys: str) -> DataFrame:
    """Key combinations that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child keys without a parent, with their row counts. Counting first removes hot keys."""
    keys = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    known = parent.select(F.col(parent_key or key).alias(key))
    return keys.join(known, key, "left_anti")


def model_tests(daily: DataFrame, metrics: DataFrame, customers: DataFrame) -> DataFrame:
    """The ten tests of the two Gold models: keys, references and grain."""

    def result(model: str, test: str, column: str, failures: DataFrame) -> DataFrame:
        return failures.select(
            F.lit(model).alias("model"),
            F.lit(test).alias("test"),
            F.lit(column).alias("column"),
            F.col("failures").cast("bigint").alias("failures"),
            (F.col("failures") == 0).alias("success"),
        )

    def nulls(model: str, df: DataFrame, names: tuple[str, ...]) -> DataFrame:
        counts = df.agg(*[F.count_if(F.col(n).isNull()).alias(n) for n in names])
        rows = F.array(
            *[F.struct(F.lit(n).alias("column"), F.col(n).alias("failures")) for n in names]
        )
        return counts.select(F.inline(rows)).select(
            F.lit(model).alias("model"),
            F.lit("not_null").alias("test"),
            "column",
            "failures",
            (F.col("failures") == 0).alias("success"),
        )

    def count(df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("failures"))

    parts = [
        nulls("daily_revenue", daily, ("report_date", "currency", "order_count", "net_revenue")),
        nulls("customer_metrics", metrics, ("customer_id", "total_orders", "is_churned")),
        result(
            "customer_metrics",
            "unique",
            "customer_id",
            count(duplicate_grain(metrics, "customer_id")),
        ),
        result(
            "customer_metrics",
            "relationships",
            "customer_id",
            count(orphans(metrics, customers, "customer_id")),
        ),
        result(
            "daily_revenue",
            "unique_grain",
            "report_date,currency",
            count(duplicate_grain(daily, "report_date", "currency")),
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


def smoke_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each table and whether it has any."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("value")).select(
            F.lit(f"{name} is non-empty").alias("check"),
            "value",
            (F.col("value") > 0).alias("success"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)
