"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Results depend on UTC. Skew handling stays on even where it costs a shuffle. State stores do not count their rows,
# which would look up every key before it is put, and write the changes of a batch instead of whole files. HotSpot never
# compiles a method of over 8,000 bytes, so a stage that fuses into a longer one runs operator by operator, each compiled.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

#: How tables between stages are written: their JSON texts and ids take half the bytes that they take with Snappy.
SCRATCH = {"compression": "zstd"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings that the operators rely on."""
    for name, value in RUNTIME.items():
        spark.conf.set(name, value)
    return spark


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A runtime setting for the length of a block."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def build_session(app: str, **conf: str) -> SparkSession:
    """Session with the library's settings; master and sizes come from spark-submit or ``conf``."""
    builder = SparkSession.builder.appName(app)
    for name, value in {**RUNTIME, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder for tables between stages and for checkpoints, which every executor must reach.

    ``spark.checkpoint.dir``, else a folder below the warehouse, which a cluster shares as well.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (shared or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch").rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a fresh folder below the scratch root."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
