"""A table's full read, then its change feed, as one stream.

The full read is taken at a position of the feed. Its rows are the initial state of a keyed
stream over the feed, and the first rows of the target; changes up to that position, which
the read has seen, are passed over, and each later one is applied once. As in the batch
form a null column keeps the old value, and after a delete nothing old comes back.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from tonearm.sources.keyed import DELETED, KeyedTable, exists


class TableRow(StatefulProcessor):
    """The row of one key as of the last change applied."""

    def __init__(self, key: str, schema: StructType, since: int):
        self.key, self.since = key, since
        self.columns = [f.name for f in schema if f.name != key]
        self.ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name != key)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.row = handle.getValueState("row", f"{self.ddl}, _position bigint, {DELETED} boolean, _applied bigint")

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self.row.update((*(initialState[c] for c in self.columns), self.since, False, 0))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        *held, at, gone, before = self.row.get() if self.row.exists() else (*[None] * len(self.columns), self.since, True, 0)
        applied = before
        for change in sorted(rows, key=lambda r: r["_position"]):
            if change["_position"] <= at:
                continue
            if change[DELETED]:
                held, gone = [None] * len(self.columns), True
            else:
                fresh = [change[c] for c in self.columns]
                held, gone = fresh if gone else [o if n is None else n for o, n in zip(held, fresh)], False
            at, applied = change["_position"], applied + 1
        if applied > before:
            self.row.update((*held, at, gone, applied))
            yield Row(**{self.key: key[0], **dict(zip(self.columns, held)), "applied": applied, DELETED: gone})

    def close(self) -> None:
        pass


def keyed_changes(changes: DataFrame, schema: StructType, key: str) -> DataFrame:
    """Change records as `(key, columns, _deleted, _position)`; those without a usable key are left out."""
    image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    cols = [image[f.name].try_cast(f.dataType).alias(f.name) for f in schema]
    return changes.select(*cols, (F.col("op") == "d").alias(DELETED), F.col("ts_ms").alias("_position")).where(
        F.col(key).isNotNull()
    )


def handover(snapshot: DataFrame, since: int, changes: DataFrame, key: str) -> DataFrame:
    """The rows that the feed changes after `since`, the position `snapshot` was read at, and how
    many changes each has had since. The snapshot is read in parallel into the state of the
    stream's first batch."""
    schema = snapshot.schema
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return keyed_changes(changes, schema, key).groupBy(key).transformWithState(
        statefulProcessor=TableRow(key, schema, since), outputStructType=f"{ddl}, applied bigint, {DELETED} boolean",
        outputMode="Update", timeMode="None", initialState=snapshot.groupBy(key),
    )


def target(path: str, snapshot: DataFrame, key: str) -> KeyedTable:
    """The table that changes go to, which first gets the snapshot, as if it were a batch before the first."""
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in snapshot.schema)
    table = KeyedTable(path, f"{ddl}, applied bigint", [key])
    if not exists(snapshot.sparkSession, f"{path}/rows/_SUCCESS"):
        table.upsert(snapshot.withColumn("applied", F.lit(0).cast("bigint")), -1)
    return table
