"""Dimension upkeep from a change feed.

A row is written column by column: a null in a change leaves the old value. A delete
ends the row; what was set before it does not come back when the key returns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tonearm.operators.changes import row_image


def net_effect(changes: DataFrame, schema: StructType, key: str) -> DataFrame:
    """One row per changed key: the values set after its last delete.

    `_deleted` says that older values are gone, `_alive` that the row exists after these
    changes, as far as they tell. One shuffle by key. If the changes were routed by a
    config that lists sink columns, only those are written.
    """
    put, image = F.col("op") != "d", row_image()
    cols = [f.name for f in schema.fields if f.name != key]
    rows = changes.select(
        image.getField(key).try_cast(schema[key].dataType).alias(key),
        F.col("ts_ms").alias("_ts"),
        F.col("source.pos").alias("_pos"),
        (~put).alias("_deleted"),
        put.alias("_alive"),
        *[
            F.when(put, _configured(changes, c, image.getField(c))).try_cast(schema[c].dataType).alias(c)
            for c in cols
        ],
    )
    return folded(rows.where(F.col(key).isNotNull()), cols, key, ["_ts", "_pos"])


def unkeyed(changes: DataFrame, schema: StructType, key: str) -> DataFrame:
    """How many changes cannot be applied because their key is missing or not of its type."""
    value = row_image().getField(key)
    reason = F.when(value.isNull(), "no key").otherwise("key of another type").alias("reason")
    bad = changes.where(value.try_cast(schema[key].dataType).isNull())
    return bad.groupBy(reason).agg(F.count("*").alias("changes"))


def folded(rows: DataFrame, cols: list[str], key: str, order: list[str]) -> DataFrame:
    """Rows `(key, _deleted, _alive, cols)` of one key, in their order, as one such row.

    A row first ends what was there if it is `_deleted`, then sets its columns that are
    not null. Rows since the last end make one life of the key."""
    by_key = W.partitionBy(key).orderBy(*order)
    upto_now = by_key.rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumns({
        "_life": F.sum(F.col("_deleted").cast("int")).over(upto_now), "_more": F.lead(F.lit(True)).over(by_key),
    })
    life = W.partitionBy(key, "_life").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.select(
        key, "_life", "_more",
        F.max("_alive").over(life).alias("_alive"),
        *[F.last(c, ignorenulls=True).over(life).alias(c) for c in cols],
    )
    return rows.where(F.col("_more").isNull()).select(key, *cols, (F.col("_life") > 0).alias("_deleted"), "_alive")


def _configured(changes: DataFrame, column: str, value: Column) -> Column:
    if "sink_columns" not in changes.columns:
        return value
    names = F.regexp_replace(F.coalesce("sink_columns", F.lit("")), r"\s", "")
    return F.when((names == "") | (F.find_in_set(F.lit(column), names) > 0), value)


def current_rows(changes: DataFrame, schema: StructType, key: str) -> DataFrame:
    """The dimension as the whole change feed leaves it."""
    return net_effect(changes, schema, key).where("_alive").drop("_deleted", "_alive")


def merge(current: DataFrame, effect: DataFrame, schema: StructType, key: str) -> DataFrame:
    """The dimension after one more batch of changes, given as its net effect."""
    cols = [f.name for f in schema.fields if f.name != key]
    old, new = current.alias("o"), effect.alias("n")
    both = old.join(new, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    untouched = F.col(f"n.{key}").isNull()
    gone = F.coalesce(F.col("n._deleted"), F.lit(False))
    kept = untouched | F.col("n._alive")
    return both.where(kept).select(
        F.coalesce(F.col(f"n.{key}"), F.col(f"o.{key}")).alias(key),
        *[
            F.coalesce(F.col(f"n.{c}"), F.when(~gone, F.col(f"o.{c}"))).alias(c)
            for c in cols
        ],
    )
