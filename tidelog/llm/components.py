"""Connected components of a link table, and a key filter of fixed size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import landed, mixed

#: Bits of a key filter; its size is fixed, whatever it holds.
FILTER_BITS = 1 << 25


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) for every node of links ``a, b``.

    Each round takes the least label among the neighbours and then the label of that label, so paths
    shorten by half and a component of n nodes takes about log n rounds. A node with very many links
    is cut by partial minima. No links give an empty table.
    """
    both = landed(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = landed(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("component")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("least"))
        near = labels.join(near, F.col("node") == F.col("a")).select("node", "component", F.least("component", "least").alias("least"))
        root = labels.select(F.col("node").alias("root"), F.col("component").alias("root_component"))
        stepped = near.join(root, F.col("least") == F.col("root")).select(
            "node", F.least("least", "root_component").alias("component"), (F.least("least", "root_component") < F.col("component")).alias("changed")
        )
        stepped = landed(stepped, "labels")
        labels = stepped.drop("changed")
        if stepped.where("changed").isEmpty():
            return labels


def _slot(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys.astype(np.uint64)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)


def key_filter(keys: DataFrame, column: str) -> Broadcast:
    """A broadcast bitmap of ``FILTER_BITS`` bits (4 MB) with the hash slot of every key of a long column.

    It only spares other rows a shuffle: what passes is joined with the keys afterwards. When the keys
    outgrow it, more rows pass and nothing else changes.
    """

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = _slot(batch.column(0).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([pa.array(slot >> 6), pa.array(np.int64(1) << (slot & 63))], ["word", "bit"])

    words = keys.select(F.col(column).cast("long").alias("key")).where("key is not null").mapInArrow(slots, "word long, bit long")
    words = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()  # FILTER_BITS / 64 rows at most
    bitmap = np.zeros(FILTER_BITS >> 6, dtype=np.int64)
    bitmap[words["word"].to_numpy(dtype=np.int64)] = words["bits"].to_numpy(dtype=np.int64)
    return keys.sparkSession.sparkContext.broadcast(bitmap)


def passes(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key may be one of the filter's; never false for one that is."""
    slot = _slot(keys)
    return (bitmap[slot >> 6] >> (slot & 63)) & 1 == 1
