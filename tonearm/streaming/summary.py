"""Sliding summaries that a stream emits as their windows close.

A micro-batch adds what it holds to the state, emits the windows that the watermark has
passed since the batch before, and emits the last few anew, as late rows may still have
changed them. Rows too late for all their windows go to the late table. The state keeps
what windows to come can need, so neither it nor a batch grows with the history.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tonearm.operators import sliding
from tonearm.operators.lateness import ALLOWED_LATENESS_MS, DISORDER_MS, is_late
from tonearm.operators.sliding import Sliding
from tonearm.sources.keyed import exists
from tonearm.sources.sinks import BatchSink, write_batch

BOUNDS = "high bigint, low bigint, closed bigint, batch_id bigint"


@dataclass(frozen=True)
class Counts:
    """Events per key; the state is how many began in each slide."""

    keys: list[str]
    count: str
    win: Sliding

    def parts(self, rows: DataFrame, ts: str) -> DataFrame:
        dated = rows.where(F.col(ts).isNotNull())
        return dated.groupBy(*self.keys, self.win.first_window(F.col(ts)).alias("pane")).agg(F.count("*").alias("n"))

    def fold(self, state: DataFrame) -> DataFrame:
        return state.groupBy(*self.keys, "pane").agg(F.sum("n").alias("n"))

    def needed(self, state: DataFrame, low: int) -> DataFrame:
        return state.where(F.col("pane") > low - self.win.panes)

    def windows(self, state: DataFrame) -> DataFrame:
        begin = (F.col("pane") - 1) * (self.win.slide_s * 1000)
        return sliding.sliding_count(state, self.keys, begin, self.win, self.count, weight="n")


@dataclass(frozen=True)
class Distinct:
    """Distinct members per key; the state is when each was first and last seen per chunk."""

    keys: list[str]
    member: str
    count: str
    win: Sliding

    def parts(self, rows: DataFrame, ts: str) -> DataFrame:
        return sliding.member_spans(rows, self.keys, self.member, F.col(ts), self.win)

    def fold(self, state: DataFrame) -> DataFrame:
        return state.groupBy(*self.keys, self.member, "_chunk").agg(
            F.min("_first").alias("_first"), F.max("_last").alias("_last")
        )

    def needed(self, state: DataFrame, low: int) -> DataFrame:
        return state.where(F.col("_last") > low - self.win.panes)

    def windows(self, state: DataFrame) -> DataFrame:
        return sliding.sliding_distinct_of_spans(state, self.keys, self.member, self.win, self.count)


Summary = Counts | Distinct


def summary_sink(out: str, summary: Summary, ts: str) -> BatchSink:
    """Closed windows of each micro-batch under `windows`, late rows under `late`.

    The state has two slots that batches write in turn: a replayed batch still finds the
    one before it, and no more than two are kept."""
    slide_ms = summary.win.slide_s * 1000
    again = ALLOWED_LATENESS_MS // slide_ms  # closed windows that late rows may still change

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = bounds_before(spark, out, batch_id)
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            high = before["high"] if before else None
            late = is_late(F.col(ts), F.lit(high).cast("bigint"), summary.win)
            write_batch(batch.where(late), f"{out}/late", batch_id)
            undated = batch.where(F.col(ts).isNull()).agg(F.count("*").alias("undated"))
            write_batch(undated, f"{out}/undated", batch_id)
            parts = summary.parts(batch.where(~late), ts)
            if before:
                old = spark.read.schema(parts.schema).parquet(f"{out}/state/slot={(batch_id - 1) % 2}")
                parts = summary.fold(old.unionByName(parts))
            state = parts.persist(StorageLevel.MEMORY_AND_DISK)
            seen = batch.agg(F.max(ts).alias("top"), F.min(summary.win.first_window(F.col(ts))).alias("first")).first()
            high = max((x for x in (high, seen["top"]) if x is not None), default=None)
            low = before["closed"] + 1 - again if before and before["closed"] is not None else seen["first"]
            closed = None if high is None else (high - DISORDER_MS) // slide_ms
            if before and closed is not None and before["closed"] is not None:
                closed = max(closed, before["closed"])
            write_windows(summary, state, low, closed, f"{out}/windows", batch_id)
            kept = state if closed is None else summary.needed(state, closed + 1 - again)
            kept.write.mode("overwrite").parquet(f"{out}/state/slot={batch_id % 2}")
            row = spark.createDataFrame([(high, low, closed)], BOUNDS.rpartition(",")[0])
            write_batch(row, f"{out}/bounds", batch_id)
            state.unpersist()
        finally:
            batch.unpersist()

    return sink


def bounds_before(spark: SparkSession, out: str, batch_id: int):
    """What the batch before has left, read from its folder alone."""
    path = f"{out}/bounds/batch_id={batch_id - 1}"
    if batch_id == 0 or not exists(spark, path):
        return None
    return spark.read.schema(BOUNDS.rpartition(",")[0]).parquet(path).first()


def current_state(spark: SparkSession, out: str) -> DataFrame:
    """The state as the last batch left it."""
    last = spark.read.schema(BOUNDS).parquet(f"{out}/bounds").agg(F.max("batch_id")).first()[0]
    return spark.read.parquet(f"{out}/state/slot={last % 2}")


def write_windows(
    summary: Summary, state: DataFrame, low: int | None, closed: int | None, path: str, batch_id: int
) -> None:
    windows = summary.windows(state)
    if low is None or closed is None:
        windows = windows.limit(0)
    else:
        windows = windows.withColumns({
            "from_window": F.greatest("from_window", F.lit(low)), "to_window": F.least("to_window", F.lit(closed)),
        }).where("from_window <= to_window")
    write_batch(windows, path, batch_id)


def emitted(spark: SparkSession, out: str, summary: Summary) -> DataFrame:
    """What was emitted, each window as the last batch that emitted it has it, as intervals.

    One bounds row per batch tells from which window on the next batch took over."""
    order = W.orderBy("batch_id")
    bounds = spark.read.schema(BOUNDS).parquet(f"{out}/bounds").where("closed is not null")
    until = bounds.select("batch_id", (F.lead("low").over(order) - 1).alias("until"))
    rows = spark.read.parquet(f"{out}/windows").join(until, "batch_id")
    rows = rows.withColumn("to_window", F.least("to_window", "until")).where("from_window <= to_window")
    # Neighbours of one count and chunk are one interval again.
    by = [*summary.keys, "chunk"]
    rows = rows.withColumn("chunk", summary.win.chunk(F.col("from_window")))
    turn = W.partitionBy(*by).orderBy("from_window")
    joins = (F.lag("to_window").over(turn) + 1 == F.col("from_window")) & (F.lag(summary.count).over(turn) == F.col(summary.count))
    rows = rows.withColumn("run", F.sum(F.when(joins, 0).otherwise(1)).over(turn))
    return rows.groupBy(*by, "run").agg(
        F.max(summary.count).alias(summary.count),
        F.min("from_window").alias("from_window"), F.max("to_window").alias("to_window"),
    ).drop("chunk", "run")
