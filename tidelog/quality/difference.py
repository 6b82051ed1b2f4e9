"""Row-by-row comparison of two tables that should be equal, which looks closely only where they differ.

Keys hash into the nodes of a tree. The digests of a level are compared, and only nodes that differ are opened into
their children, so equal tables take one pass with a few numbers per task, and only rows of leaves that differ are
shuffled and compared column by column. Nodes hold a share of the keys, so a leaf is small at every table size that
``LEVELS`` allows for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Children of a node, and levels below the root.
FANOUT, LEVELS = 256, 2


def _node(key: Sequence[str], level: int) -> Column:
    """Number of a key's node; its parent's is that without the last ``FANOUT`` digit."""
    h = F.pmod(F.xxhash64(*key), F.lit(FANOUT**LEVELS))
    return F.floor(h / FANOUT ** (LEVELS - level)).cast("int")


def digests(df: DataFrame, key: Sequence[str], columns: Sequence[str], level: int) -> DataFrame:
    """``node``, rows and the sum of the row hashes, which does not depend on the order of rows."""
    hashed = F.xxhash64(*columns).cast("decimal(20,0)")
    return df.groupBy(_node(key, level).alias("node")).agg(F.count(F.lit(1)).alias("rows"), F.sum(hashed).alias("digest"))


def unequal_nodes(a: DataFrame, b: DataFrame, key: Sequence[str], columns: Sequence[str]) -> list[int]:
    """Leaves where two tables differ (``FANOUT ** LEVELS`` numbers at most); equal nodes are not opened."""
    nodes: list[int] = []
    for level in range(1, LEVELS + 1):
        sides = [digests(df if level == 1 else df.where(_node(key, level - 1).isin(nodes)), key, columns, level) for df in (a, b)]
        left, right = (side.select("node", F.struct("rows", "digest").alias(name)) for side, name in zip(sides, "ab", strict=True))
        both = left.join(right, "node", "full_outer")
        nodes = [r.node for r in both.where(~F.col("a").eqNullSafe(F.col("b"))).select("node").collect()]
        if not nodes:
            return []
    return nodes


def difference(a: DataFrame, b: DataFrame, key: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """``column`` and ``rows``: how many keys differ in each column, and in the first two rows how many one side lacks.

    Keys are unique in each table; NULL keys and values equal each other. ``columns`` are compared, by default all
    but the key; both tables have them.
    """
    columns = [c for c in (columns or a.columns) if c not in key]
    nodes = unequal_nodes(a, b, key, [*key, *columns])
    here = _node(key, LEVELS).isin(nodes) if nodes else F.lit(False)
    left, right = (df.where(here).select(*[F.col(k).alias(f"_{side}_{k}") for k in key], F.struct(*columns).alias(f"_{side}")) for df, side in ((a, "a"), (b, "b")))
    same = [F.col(f"_a_{k}").eqNullSafe(F.col(f"_b_{k}")) for k in key]
    on = same[0]
    for condition in same[1:]:
        on = on & condition
    joined = left.withColumn("_in_a", F.lit(True)).join(right.withColumn("_in_b", F.lit(True)), on, "full_outer")
    both = F.col("_in_a").isNotNull() & F.col("_in_b").isNotNull()
    counted = joined.agg(
        F.count_if(F.col("_in_b").isNull()).alias("only in first"),
        F.count_if(F.col("_in_a").isNull()).alias("only in second"),
        *[F.count_if(both & ~F.col("_a")[c].eqNullSafe(F.col("_b")[c])).alias(c) for c in columns],
    )
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("rows")) for c in counted.columns]
    return counted.select(F.inline(F.array(*rows)))
