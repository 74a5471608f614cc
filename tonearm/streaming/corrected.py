"""Sliding counts on Spark's own window state, corrected by late rows.

The stream counts rows per key and slide under a watermark, in update mode, so a batch hands
on the slides that it changed. Those are merged into a keyed table by day, from which the
windows that the batch has closed are emitted, and the last few again, which late rows may
have changed. A row is too late when the last of its windows, with the allowed lateness, is
behind the watermark; such rows are a table of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonearm.functions.timefmt import DATE
from tonearm.operators.lateness import ALLOWED_LATENESS_MS, DISORDER_MS, is_late
from tonearm.operators.sliding import Sliding
from tonearm.sources.keyed import KeyedTable, exists
from tonearm.sources.sinks import BatchSink, write_batch
from tonearm.streaming.summary import BOUNDS, Counts, bounds_before, write_windows

#: Spark tells late rows by the watermark that the batch before last has set.
WATERMARK_LAG = 2


def kept_for_ms(win: Sliding) -> int:
    """How long after its end a slide may still change a window."""
    return (win.panes - 1) * win.slide_s * 1000 + ALLOWED_LATENESS_MS + DISORDER_MS


def changed_panes(rows: DataFrame, keys: list[str], ts: str, win: Sliding) -> DataFrame:
    """`(keys, pane, n, top)` of the slides that a micro-batch changed: their rows, largest time."""
    timed = rows.where(F.col(ts).isNotNull()).withColumn("event_ts", F.timestamp_millis(ts))
    timed = timed.withWatermark("event_ts", f"{kept_for_ms(win)} milliseconds")
    counted = timed.groupBy(F.window("event_ts", f"{win.slide_s} seconds"), *keys).agg(
        F.count("*").alias("n"), F.max(ts).alias("top")
    )
    pane = (F.unix_millis("window.end") / (win.slide_s * 1000)).cast("bigint")
    return counted.select(*keys, pane.alias("pane"), "n", "top")


def pane_table(out: str, keys: list[str], add: tuple[str, ...] = ()) -> KeyedTable:
    columns = ", ".join(f"{k} bigint" for k in keys)
    return KeyedTable(f"{out}/panes", f"{columns}, pane bigint, n bigint, day string", [*keys, "pane", "day"], "day", add=add)


def dated(panes: DataFrame, win: Sliding) -> DataFrame:
    return panes.withColumn("day", F.date_format(win.end_time(F.col("pane")), DATE))


def panes_of(spark: SparkSession, table: KeyedTable, win: Sliding, low: int, closed: int) -> DataFrame:
    """The slides that the windows `low..closed` hold, from the days that these touch."""
    first = low - win.panes + 1
    days = spark.range(1).select(F.explode(F.sequence(
        F.to_date(win.end_time(F.lit(first))), F.to_date(win.end_time(F.lit(closed)))
    )).alias("d")).select(F.date_format("d", DATE))
    return table.read(spark, [r[0] for r in days.collect()]).where(F.col("pane").between(first, closed))


def write_bounds(spark: SparkSession, out: str, batch_id: int, high, low, closed) -> None:
    write_batch(spark.createDataFrame([(high, low, closed)], BOUNDS.rpartition(",")[0]), f"{out}/bounds", batch_id)


def corrected_sink(out: str, summary: Counts) -> BatchSink:
    """Changed slides into the keyed table, closed windows under `windows`."""
    win, slide_ms = summary.win, summary.win.slide_s * 1000
    again = ALLOWED_LATENESS_MS // slide_ms
    table = pane_table(out, summary.keys)

    def sink(changed: DataFrame, batch_id: int) -> None:
        spark = changed.sparkSession
        before = bounds_before(spark, out, batch_id)
        changed = changed.persist()
        try:
            table.upsert(dated(changed.drop("top"), win), batch_id)
            seen = changed.agg(F.max("top").alias("top"), F.min("pane").alias("first")).first()
        finally:
            changed.unpersist()
        highs = [x for x in (before and before["high"], seen["top"]) if x is not None]
        high = max(highs, default=None)
        low = before["closed"] + 1 - again if before and before["closed"] is not None else seen["first"]
        closed = None if high is None else (high - DISORDER_MS) // slide_ms
        if low is not None and closed is not None:
            write_windows(summary, panes_of(spark, table, win, low, closed), low, closed, f"{out}/windows", batch_id)
        write_bounds(spark, out, batch_id, high, low, closed)

    return sink


def late_sink(out: str, ts: str, win: Sliding) -> BatchSink:
    """Rows of each micro-batch that come too late for all their windows, in order of arrival:
    those that Spark's state for the same batches leaves out."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        highs = []
        for past in (WATERMARK_LAG, 1):
            path = f"{out}/high_water/batch_id={batch_id - past}"
            known = batch_id >= past and exists(spark, path)
            highs.append(spark.read.schema("top bigint").parquet(path).first()["top"] if known else None)
        top = batch.agg(F.greatest(F.max(ts), F.lit(highs[1]).cast("bigint")).alias("top"))
        write_batch(top, f"{out}/high_water", batch_id)
        late = is_late(F.col(ts), F.lit(highs[0]).cast("bigint"), win)
        write_batch(batch.where(late), f"{out}/late", batch_id)

    return sink
