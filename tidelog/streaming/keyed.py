"""Signed changes of a change stream from the last accepted image of each entity, kept as keyed state."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidelog import rules, schemas
from tidelog.operators.changelog import VERSION_ORDER
from tidelog.operators.envelope import accepted


def _version(row: Row) -> tuple:
    """The place of a change in the history of its entity; NULLs come first."""
    return tuple((row[c] is not None, row[c] or 0) for c in VERSION_ORDER)


class LastAccepted(StatefulProcessor):
    """Takes back the image that an entity counts with and puts in its newest one.

    The state is the last accepted change, deletes included. Rejected changes never reach it, so an entity goes on
    counting with its last good image, as in Silver. Changes that are older than the state, and changes that
    come again, give nothing. Of several changes in one batch the newest counts: those between would cancel out.
    """

    def __init__(self, names: list[str], state: T.StructType, ttl_ms: int | None) -> None:
        self._names, self._schema, self._ttl = names, state, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._last = handle.getValueState("last", self._schema, self._ttl)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        newest = max(rows, key=_version)
        before = Row(*self._schema.names)(*self._last.get()) if self._last.exists() else None
        if before is not None and _version(before) >= _version(newest):
            return
        self._last.update(tuple(newest[n] for n in self._schema.names))
        for sign, row in ((-1, before), (1, newest)):
            if row is not None and row["op"] != rules.DELETE_OP:
                yield Row(sign=sign, **{n: row[n] for n in self._names})

    def close(self) -> None:
        pass


def accepted_changes(bronze: DataFrame, entity: schemas.Entity, ttl_days: int | None = None) -> DataFrame:
    """``sign`` and the image fields: -1 for the image an entity counted with, 1 for the one it counts with now.

    For a stream or a table. ``ttl_days`` forgets entities that have not changed for so long (in processing time);
    a later change of one counts as a new entity, so leave it out unless entities end.
    """
    fields = [name for name, _ in entity.fields]
    image = schemas.image_schema(entity)
    state = T.StructType([f for f in image if f.name != "ingested_at"])
    rows = accepted(bronze, entity).select(*state.names)
    output = T.StructType([T.StructField("sign", T.IntegerType()), *[image[n] for n in fields]])
    ttl_ms = None if ttl_days is None else ttl_days * 86_400_000
    return rows.groupBy(entity.key).transformWithState(
        LastAccepted(fields, state, ttl_ms), output, "Update", "None" if ttl_ms is None else "ProcessingTime"
    )
