"""Sinks: partitioned tables, replay-safe micro-batch tables, messages, OLAP stores."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BatchSink = Callable[[DataFrame, int], None]


def write_partitions(df: DataFrame, path: str, by: str = "dt") -> None:
    """Replace just the partitions that occur in `df`, so that a rerun does not
    duplicate. Rows are clustered by partition first, or every task would write a file
    into every partition; a large partition is split again by the size rule of AQE."""
    (
        df.hint("rebalance", F.col(by))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by)
        .parquet(path)
    )


def create_table(df: DataFrame, table: str, by: str = "dt", path: str | None = None) -> None:
    """`create table if not exists`, with the partition column last; at `path` if given."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        cols = [c for c in df.columns if c != by] + [by]
        writer = df.limit(0).select(*cols).write.partitionBy(by).format("parquet")
        if path:
            writer = writer.option("path", path)
        writer.saveAsTable(table)


def insert_partitions(df: DataFrame, table: str, by: str = "dt", path: str | None = None) -> None:
    """Dynamic-partition insert into a catalog table, replacing the days in `df`."""
    create_table(df, table, by, path)
    spark, key = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    rows = df.select(*spark.table(table).columns).hint("rebalance", F.col(by))
    # A catalog insert takes the mode from the session, not from a writer option.
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        rows.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(key, before)


def read_days(spark: SparkSession, path: str, days: list[str], by: str = "dt") -> DataFrame:
    """Scan of a partitioned table limited to some days, by partition pruning."""
    return spark.read.parquet(path).where(F.col(by).cast("string").isin(days))


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """One micro-batch under its own id. A replayed batch replaces what it wrote, which
    makes the table exactly-once."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def write_batch_partitions(df: DataFrame, path: str, batch_id: int, by: list[str]) -> None:
    """The same with further partition columns above the batch id."""
    (
        df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .hint("rebalance", *[F.col(c) for c in by])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by, "batch_id")
        .parquet(path)
    )


def kafka_sink(servers: str, topic: str, key: str | None = None) -> BatchSink:
    """Rows as JSON messages. Delivery is at least once; consumers drop repeats by the
    fact id. With a key column the topic can be read as an upsert log."""

    def sink(df: DataFrame, batch_id: int) -> None:
        value = F.to_json(F.struct("*")).alias("value")
        message = df.select(value) if key is None else df.select(
            F.col(key).cast("string").alias("key"), value
        )
        (
            message.write.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("topic", topic)
            .save()
        )

    return sink


def olap_sink(fmt: str, path: str, internal: tuple[str, ...] = (), **options: str) -> BatchSink:
    """Micro-batches into an OLAP store through a Spark format that writes folders. A
    replayed batch replaces its own folder."""

    def sink(df: DataFrame, batch_id: int) -> None:
        rows = df.drop(*internal).write.format(fmt).options(**options).mode("overwrite")
        rows.save(f"{path}/batch_id={batch_id}")

    return sink


def export_columns(
    spark: SparkSession, table: str, columns: list[str], fmt: str, path: str, **options: str
) -> None:
    """Read some columns of a warehouse table back and write them to another store. A
    rerun replaces what the last one wrote."""
    spark.table(table).select(*columns).write.format(fmt).options(**options).mode(
        "overwrite"
    ).save(path)


def commit_partitions(
    days: DataFrame, table: str, path: str, high_water_ms: int, delay_ms: int = 600_000
) -> list[str]:
    """Make finished days visible: register them as partitions of the catalog table, in
    one statement, and note them in the marker table. Days already there stay."""
    spark = days.sparkSession
    closed = closed_partitions(days, high_water_ms, delay_ms)
    found = sorted(r["dt"] for r in closed.collect())
    if found:
        added = " ".join(f"PARTITION (dt = '{d}') LOCATION '{path}/dt={d}'" for d in found)
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {added}")
        marks = closed.withColumn("high_water_ms", F.lit(high_water_ms).cast("bigint"))
        marks.coalesce(1).write.mode("overwrite").parquet(f"{path}/_commits/high_water_ms={high_water_ms}")
    return found


def closed_partitions(days: DataFrame, high_water_ms: int, delay_ms: int = 600_000) -> DataFrame:
    """Which `dt` values are over: the end of the day plus the delay has passed. One row
    per day, so the list is short."""
    day_end = F.unix_millis(F.to_timestamp(F.date_add(F.to_date("dt", "yyyyMMdd"), 1)))
    return days.select("dt").distinct().where(day_end + delay_ms <= high_water_ms)
