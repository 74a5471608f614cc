"""Change-feed sources: snapshot by JDBC, then changes as envelope JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonearm.functions.unroll import once
from tonearm.schemas import change_schema


def parse_changes(lines: DataFrame, row_fields: list[str] | None = None) -> DataFrame:
    """Envelope texts to change records. Without `row_fields` the row images stay
    maps, which is what a whole-database feed of many tables needs."""
    schema = change_schema(row_fields).simpleString()
    parsed = once(lines, {"r": f"from_json(value, '{schema}')", "value": "value"})
    return parsed.select("r.*", "value").where("op is not null")


def of_table(changes: DataFrame, db: str, table: str | None = None) -> DataFrame:
    """Changes of one table, or of the whole database."""
    mine = changes.where(F.col("source.db") == db)
    return mine if table is None else mine.where(F.col("source.table") == table)


def jdbc_snapshot(
    spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int,
    partitions: int, **options: str,
) -> DataFrame:
    """The first full read of a table, in parallel ranges of its key. Credentials and
    driver come in as options."""
    return (
        spark.read.format("jdbc")
        .options(
            url=url, dbtable=table, partitionColumn=key, lowerBound=str(lower),
            upperBound=str(upper), numPartitions=str(partitions), **options,
        )
        .load()
    )


def snapshot_as_changes(rows: DataFrame, db: str, table: str, ts_ms: int) -> DataFrame:
    """Snapshot rows as `r` records that sort before every later change."""
    image = F.struct(*[F.col(c).cast("string").alias(c) for c in rows.columns])
    return rows.select(
        F.lit("r").alias("op"),
        F.when(F.lit(False), image).alias("before"),
        image.alias("after"),
        F.struct(
            F.lit(db).alias("db"), F.lit(table).alias("table"), F.lit(0).cast("bigint").alias("pos")
        ).alias("source"),
        F.lit(ts_ms).cast("bigint").alias("ts_ms"),
    )


def snapshot_then_changes(rows: DataFrame, feed: DataFrame, db: str, table: str) -> DataFrame:
    """One source of a table: its full read, then its change feed."""
    snapshot = snapshot_as_changes(rows, db, table, ts_ms=0)
    return snapshot.unionByName(feed.select(*snapshot.columns))


def row_images_as(changes: DataFrame, fields: list[str]) -> DataFrame:
    """Map-typed row images to structs of the given fields."""

    def image(side: str):
        return F.when(
            F.col(side).isNotNull(),
            F.struct(*[F.col(side)[f].alias(f) for f in fields]),
        ).alias(side)

    kept = [c for c in ("value",) if c in changes.columns]
    return changes.select("op", image("before"), image("after"), "source", "ts_ms", *kept)
