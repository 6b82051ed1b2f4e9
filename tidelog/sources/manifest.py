"""Publication of several tables at once: readers see all tables of one version, or all of the one before.

A version of the manifest is one file with the folder of every table, so it appears as a whole. A publisher names the
version that it has seen; if another one came first, it gets nothing and is told so. Of two that write at
the same moment the one with the smaller token has published, for readers and for both of them.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.sources.tables import existing

_SCHEMA = "version long, token string, name string, path string"


class Conflict(Exception):
    """Another publisher has made the version."""


@dataclass(frozen=True)
class Manifest:
    """The manifest at a path."""

    spark: SparkSession
    path: str

    def _entries(self) -> DataFrame:
        found = existing(self.spark, self.path, _SCHEMA)
        return self.spark.createDataFrame([], _SCHEMA) if found is None else found

    def version(self) -> int:
        """The last version, 0 before the first."""
        return self._entries().agg(F.max("version")).first()[0] or 0

    def tables(self, version: int | None = None) -> dict[str, str]:
        """Folder of every table in a version, the last one if none is named."""
        entries, version = self._entries(), self.version() if version is None else version
        rows = entries.where(F.col("version") == version).collect()  # a row per table
        winner = min((r.token for r in rows), default=None)
        return {r["name"]: r.path for r in rows if r.token == winner}

    def read(self, *names: str, version: int | None = None) -> dict[str, DataFrame]:
        """Tables of one version together."""
        paths = self.tables(version)
        missing = [n for n in names if n not in paths]
        if missing:
            raise KeyError(f"not published: {', '.join(missing)}")
        return {n: self.spark.read.parquet(paths[n]) for n in names or paths}

    def publish(self, tables: Mapping[str, str], seen: int) -> int:
        """Make the version after ``seen`` with these folders; tables that are not named keep theirs."""
        if self.version() != seen:
            raise Conflict(f"version {self.version()} is there, not {seen}")
        token = uuid.uuid4().hex
        rows = [(seen + 1, token, name, path) for name, path in {**self.tables(seen), **tables}.items()]
        self.spark.createDataFrame(rows, _SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
        first = self._entries().where(F.col("version") == seen + 1).agg(F.min("token")).first()[0]
        if first != token:
            raise Conflict(f"version {seen + 1} was made by another publisher")
        return seen + 1
