"""Long sliding windows over a stream.

The stream stores what each micro-batch adds: event counts per key and slide, or
member spans. Both add up, so all windows, or just the current one, are read from the
stored rows with the batch operators, and no window state is held in the stream.
Rows whose windows have all closed go to the late table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonearm.functions.timefmt import DATE
from tonearm.operators import sliding
from tonearm.operators.lateness import is_late
from tonearm.operators.sliding import Sliding
from tonearm.sources.sinks import BatchSink, write_batch, write_batch_partitions


def arrival_clock(df: DataFrame, column: str) -> DataFrame:
    """Processing-time windows: stamp rows with the time of the micro-batch."""
    return df.withColumn(column, F.unix_millis(F.current_timestamp()))


def _high_water(spark: SparkSession, path: str, batch_id: int) -> int | None:
    """Largest event time of all batches before this one."""
    if batch_id == 0:
        return None
    row = spark.read.parquet(f"{path}/high_water/batch_id={batch_id - 1}").first()
    return row["top"] if row else None


def _split_late(batch: DataFrame, batch_id: int, path: str, ts: str, win: Sliding) -> DataFrame:
    spark = batch.sparkSession
    high = _high_water(spark, path, batch_id)
    top = batch.agg(F.max(ts).alias("top")).select(
        F.greatest(F.col("top"), F.lit(high).cast("bigint")).alias("top")
    )
    write_batch(top, f"{path}/high_water", batch_id)
    late = is_late(F.col(ts), F.lit(high).cast("bigint"), win)
    write_batch(batch.where(late), f"{path}/late", batch_id)
    return batch.where(~late)


def count_sink(path: str, keys: list[str], ts: str, win: Sliding) -> BatchSink:
    """Counts per key and slide of each micro-batch, partitioned by day."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            on_time = _split_late(batch, batch_id, path, ts, win)
            panes = on_time.where(F.col(ts).isNotNull()).groupBy(
                *keys, win.first_window(F.col(ts)).alias("pane")
            ).agg(F.count("*").alias("n"))
            day = F.date_format(win.end_time(F.col("pane")), DATE)
            write_batch_partitions(panes.withColumn("day", day), f"{path}/panes", batch_id, ["day"])
        finally:
            batch.unpersist()

    return sink


def stored_counts(
    spark: SparkSession, path: str, keys: list[str], win: Sliding, count: str
) -> DataFrame:
    """All windows so far, as intervals of equal count."""
    panes = spark.read.parquet(f"{path}/panes")
    begin = (F.col("pane") - 1) * (win.slide_s * 1000)
    return sliding.sliding_count(panes, keys, begin, win, count, weight="n")


def current_counts(
    spark: SparkSession, path: str, keys: list[str], win: Sliding, count: str, end_ms: int
) -> DataFrame:
    """The window that ended last before `end_ms`. Only the days it touches are read."""
    last = end_ms // (win.slide_s * 1000)
    first = last - win.panes + 1
    bounds = spark.range(1).select(
        F.date_format(win.end_time(F.lit(first)), DATE), F.date_format(win.end_time(F.lit(last)), DATE)
    ).first()
    panes = spark.read.parquet(f"{path}/panes").where(
        F.col("day").cast("string").between(bounds[0], bounds[1])
        & F.col("pane").between(first, last)
    )
    return panes.groupBy(*keys).agg(F.sum("n").alias(count))


def distinct_sink(path: str, keys: list[str], member: str, ts: str, win: Sliding) -> BatchSink:
    """Member spans of each micro-batch, partitioned by day."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            on_time = _split_late(batch, batch_id, path, ts, win)
            spans = sliding.member_spans(on_time, keys, member, F.col(ts), win)
            day = F.date_format(win.end_time(F.col("_first")), DATE)
            write_batch_partitions(spans.withColumn("day", day), f"{path}/spans", batch_id, ["day"])
        finally:
            batch.unpersist()

    return sink


def stored_distinct(
    spark: SparkSession, path: str, keys: list[str], member: str, win: Sliding, count: str
) -> DataFrame:
    spans = spark.read.parquet(f"{path}/spans")
    return sliding.sliding_distinct_of_spans(spans, keys, member, win, count)
