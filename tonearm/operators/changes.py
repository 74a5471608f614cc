"""Change-feed records: row image, routing by the dimension config, latest config."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def row_image() -> Column:
    """The row a change speaks of: what was there for a delete, else what is there now."""
    return F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))


def current_config(config_changes: DataFrame) -> DataFrame:
    """One row per source table from the config's own change feed.

    The last change wins; a deleted row stops routing. The change feed's position
    breaks ties of the time.
    """
    image = config_changes.select("op", "ts_ms", F.col("source.pos").alias("pos"), row_image().alias("row"))
    order = W.partitionBy("row.source_table").orderBy(F.desc("ts_ms"), F.desc("pos"))
    last = image.withColumn("turn", F.row_number().over(order)).where("turn = 1 AND op <> 'd'")
    return last.select("row.source_table", "row.sink_table", "row.sink_columns", "row.sink_family", "row.sink_row_key")


def lifecycle(config_changes: DataFrame) -> DataFrame:
    """What each config change does to its target table."""
    action = (
        F.when(F.col("op").isin("r", "c"), "create")
        .when(F.col("op") == "u", "recreate")
        .when(F.col("op") == "d", "drop")
    )
    return config_changes.select(
        "ts_ms",
        F.col("source.pos").alias("pos"),
        row_image().getField("sink_table").alias("sink_table"),
        action.alias("action"),
    ).where(F.col("action").isNotNull())


def route(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Change rows of configured tables, each with its target.

    The config has one row per source table of the database. It is left to Spark's
    own size check whether it is broadcast.
    """
    return changes.join(
        config.select("source_table", "sink_table", "sink_columns", "sink_row_key"),
        F.col("source.table") == F.col("source_table"),
        "inner",
    )


def row_key(prefix: Column, row_id: Column) -> Column:
    return F.concat(prefix, row_id.cast("string"))
