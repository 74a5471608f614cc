"""Dimension tables kept current by a change-feed stream, under a config that changes too.

A micro-batch is one ordered step: the config as it now is, what its changes do to the
tables, then the rows. The net effect of the batch on the keys it names is merged into the
table's buckets that hold these keys. The last action on every table is a keyed table, too;
one that starts a table anew gives it a new folder, so nothing has to be cleared.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tonearm.operators import changes as C
from tonearm.operators import dims as D
from tonearm.sources.keyed import DELETED, RESET, KeyedTable
from tonearm.sources.sinks import BatchSink, write_batch

#: `since` is the batch in which the table was last made anew.
ACTIONS = "sink_table string, action string, ts_ms bigint, pos bigint, since bigint"


@dataclass(frozen=True)
class DimTable:
    """Where a table lies, and its columns. The key is the config's `sink_row_key`."""

    root: str
    name: str
    schema: StructType
    key: str

    def stored(self, since: int) -> KeyedTable:
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in self.schema.fields)
        return KeyedTable(f"{self.root}/tables/{self.name}/since={since}", kinds, [self.key], patches=True)

    def put(self, effect: DataFrame, since: int, batch_id: int) -> None:
        """Merge what a batch does to the keys it names."""
        rows = effect.withColumns({RESET: F.col("_deleted"), DELETED: ~F.col("_alive")})
        self.stored(since).upsert(rows, batch_id)

    def current(self, spark: SparkSession) -> DataFrame:
        last = lifecycle(self.root).read(spark).where(F.col("sink_table") == self.name).first()
        if last is None or last["action"] == "drop":
            return spark.createDataFrame([], self.schema)
        return self.stored(last["since"]).read(spark)


def lifecycle(root: str) -> KeyedTable:
    """The last action on every table of the config, a row each."""
    return KeyedTable(f"{root}/lifecycle", ACTIONS, ["sink_table"], buckets=1)


def _take_actions(config_changes: DataFrame, root: str, batch_id: int) -> dict[str, int]:
    """Store the config changes that no batch before has taken; per table, where it now starts."""
    spark, table = config_changes.sparkSession, lifecycle(root)
    actions = C.lifecycle(config_changes).select("sink_table", "action", "ts_ms", "pos")
    known = table.read(spark)
    high = known.agg(F.max(F.struct("ts_ms", "pos")).alias("h")).first()["h"]
    if high is not None:
        actions = actions.where(
            (F.col("ts_ms") > high["ts_ms"]) | ((F.col("ts_ms") == high["ts_ms"]) & (F.col("pos") > high["pos"]))
        )
    fresh = actions.groupBy("sink_table").agg(
        F.max_by(F.struct("action", "ts_ms", "pos"), F.struct("ts_ms", "pos")).alias("last"),
        F.max(F.col("action") != "create").alias("anew"),
    )
    fresh = fresh.join(known.select("sink_table", "since"), "sink_table", "left").select(
        "sink_table", "last.*",
        F.when(F.col("anew") | F.col("since").isNull(), F.lit(batch_id)).otherwise(F.col("since")).cast("bigint").alias("since"),
    )
    table.upsert(fresh, batch_id)
    return {r["sink_table"]: r["since"] for r in table.read(spark).select("sink_table", "since").collect()}


def dim_sink(
    root: str, schemas: dict[str, StructType], load_config: Callable[[], DataFrame]
) -> BatchSink:
    """Route change rows by the config, which `load_config` reads anew for each batch as its
    whole change feed, into the tables named in `schemas`. Changes without a usable key are
    counted in `skipped`."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        feed = load_config()
        since = _take_actions(feed, root, batch_id)  # one row per configured table
        config = C.current_config(feed).where(F.col("sink_table").isin(list(schemas))).persist()
        routed = C.route(batch, config).persist()
        try:
            # One row per table that this sink keeps.
            keys = {r["sink_table"]: r["sink_row_key"] for r in config.select("sink_table", "sink_row_key").collect()}
            for name, schema in schemas.items():
                if name not in keys:
                    continue
                table = DimTable(root, name, schema, keys[name])
                mine = routed.where(F.col("sink_table") == name)
                table.put(D.net_effect(mine, schema, table.key), since[name], batch_id)
                write_batch(D.unkeyed(mine, schema, table.key), f"{root}/skipped/{name}", batch_id)
        finally:
            routed.unpersist()
            config.unpersist()

    return sink
