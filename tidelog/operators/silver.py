"""Typed current-state tables from Bronze change rows.

Each table is its schema filled from the state of its entity: a column of the same name, else the
column that bookkeeping names map to, else NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidelog import schemas
from tidelog.functions.columns import money
from tidelog.operators.changelog import current_state

BOOKKEEPING = {"_source_op": "op", "_ingested_at": "ingested_at"}


def shaped(rows: DataFrame, target: StructType) -> DataFrame:
    """The columns of a schema, in its order and types."""

    def filled(name: str):
        source = BOOKKEEPING.get(name, name)
        return F.col(source) if source in rows.columns else F.lit(None)

    return rows.select(*[filled(f.name).cast(f.dataType).alias(f.name) for f in target])


def silver_orders(
    bronze: DataFrame, deletes: str = "apply", as_of_ms: int | None = None
) -> DataFrame:
    return shaped(current_state(bronze, schemas.ORDERS, deletes, as_of_ms), schemas.SILVER_ORDERS)


def silver_customers(
    bronze: DataFrame, deletes: str = "apply", as_of_ms: int | None = None
) -> DataFrame:
    state = current_state(bronze, schemas.CUSTOMERS, deletes, as_of_ms)
    return shaped(state, schemas.SILVER_CUSTOMERS)


def line_total():
    """Quantity times unit price; NULL when either is NULL."""
    return money(F.col("quantity") * F.col("unit_price")).alias("line_total")


def silver_order_items(
    bronze: DataFrame,
    orders: DataFrame | None = None,
    deletes: str = "apply",
    as_of_ms: int | None = None,
) -> DataFrame:
    """Items with their line total and the creation time of the order (NULL until it arrives).

    Without ``orders`` there is no join and that time is NULL, for readers that do not need it.
    """
    state = current_state(bronze, schemas.ORDER_ITEMS, deletes, as_of_ms).select("*", line_total())
    if orders is not None:
        created = orders.select("order_id", F.col("created_at").alias("order_created_at"))
        state = state.join(created, "order_id", "left")
    return shaped(state, schemas.SILVER_ORDER_ITEMS)
