"""Sliding counts by the clock of arrival, emitted as their windows close.

All rows of a micro-batch arrive at its clock reading, which is stored before it is used: a
batch that is run again has the same reading. The clock is a parameter, so a run can be
repeated. Windows that ended since the batch before are emitted once; none is ever late.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonearm.sources.keyed import exists
from tonearm.sources.sinks import BatchSink, write_batch
from tonearm.streaming.corrected import bounds_before, dated, pane_table, panes_of, write_bounds
from tonearm.streaming.summary import Counts, write_windows

Clock = Callable[[int], int]


def system_clock(_: int) -> int:
    return time.time_ns() // 1_000_000


def _reading(spark: SparkSession, out: str, batch_id: int, clock: Clock) -> int:
    path = f"{out}/clock/batch_id={batch_id}"
    if not exists(spark, f"{path}/_SUCCESS"):
        write_batch(spark.createDataFrame([(clock(batch_id),)], "at bigint"), f"{out}/clock", batch_id)
    return spark.read.schema("at bigint").parquet(path).first()["at"]


def arrivals_sink(out: str, summary: Counts, clock: Clock = system_clock) -> BatchSink:
    """Rows per key and slide into the keyed table, windows that have ended under `windows`. A clock
    that goes back is held at its last reading."""
    win, slide_ms = summary.win, summary.win.slide_s * 1000
    table = pane_table(out, summary.keys, add=("n",))

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = bounds_before(spark, out, batch_id)
        now = _reading(spark, out, batch_id, clock)
        now = max(now, before["high"]) if before else now
        counted = batch.groupBy(*summary.keys).agg(F.count("*").alias("n"))
        counted = counted.withColumn("pane", F.lit(now // slide_ms + 1).cast("bigint"))
        table.upsert(dated(counted, win), batch_id)
        closed = now // slide_ms
        low = before["closed"] + 1 if before else closed + 1
        if low <= closed:
            write_windows(summary, panes_of(spark, table, win, low, closed), low, closed, f"{out}/windows", batch_id)
        write_bounds(spark, out, batch_id, now, low, closed)

    return sink
