"""Event-time windows over a change stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog import rules, schemas
from tidelog.functions.columns import average, money
from tidelog.operators.changelog import unfold
from tidelog.operators.envelope import drop_redelivered


def tumbling_revenue(
    rows: DataFrame,
    time: str = "updated_at",
    amount: str = "total_amount",
    sign: str | None = None,
    size: str = rules.WINDOW_SIZE,
) -> DataFrame:
    """Count, sum and average per window; a signed row of -1 takes a row back out.

    Windows whose rows have all been taken back are left out.
    """
    unit = F.col(sign) if sign else F.lit(1)
    count, total = F.sum(unit), F.sum(unit * F.col(amount))
    return (
        rows.groupBy(F.window(time, size).alias("w"))
        .agg(count.cast("bigint").alias("order_count"), total.alias("_total"))
        .filter(F.col("order_count") > 0)
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "order_count",
            money(F.col("_total"), 14).alias("total_revenue"),
            average(F.col("_total"), F.col("order_count"), 12).alias("avg_order_value"),
        )
    )


def order_revenue(
    bronze: DataFrame, size: str = rules.WINDOW_SIZE, delay: str = rules.WATERMARK_DELAY
) -> DataFrame:
    """Revenue of live orders per window of their last update, for a stream or a table.

    On a stream a window is final once the watermark passes its end. Spark compares rows with
    the watermark of the batch before, so a retraction that arrives in the batch that closes its
    window still counts. A table has no lateness: every retraction applies.
    """
    signed = unfold(bronze, schemas.ORDERS).withWatermark("updated_at", delay)
    return tumbling_revenue(drop_redelivered(signed, "sign"), sign="sign", size=size)
