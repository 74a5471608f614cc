"""Sliding windows that are much longer than their slide (24 h by 5 s, 1 h by 5 s).

An event lies in size/slide windows, up to 17,280. Instead of one row per event and
window, each event states where a key's figure changes, and one running sum turns the
changes into intervals over which the figure is constant. Windows are numbered by
their end: window `i` is `[i*slide - size, i*slide)`, aligned to the epoch, and an
event first counts in window `floor(ts / slide) + 1`.

Time is cut into chunks as long as the window itself. What a key carries into a chunk
then depends on the previous chunk alone, so each running sum covers one key and one
chunk, at most `2 * size/slide` change points, however many events a key has. All
grouping before it combines on the map side.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tonearm.functions.timefmt import DATE, DATE_TIME, floor_div
from tonearm.functions.unroll import unroll


@dataclass(frozen=True)
class Sliding:
    size_s: int
    slide_s: int

    @property
    def panes(self) -> int:
        return self.size_s // self.slide_s

    def first_window(self, ts_ms: Column) -> Column:
        return floor_div(ts_ms, self.slide_s * 1000) + 1

    def chunk(self, window: Column) -> Column:
        return floor_div(window, self.panes)

    def end_time(self, window: Column) -> Column:
        return F.timestamp_seconds(window * self.slide_s)


DAY_BY_5S = Sliding(24 * 3600, 5)
HOUR_BY_5S = Sliding(3600, 5)
HOUR_BY_1MIN = Sliding(3600, 60)


def _sweep(changes: DataFrame, keys: list[str], win: Sliding, sums: list[str]) -> DataFrame:
    """Changes `(keys, _chunk, _at, sums)` to intervals over which the sums are constant,
    where the first of them is positive."""
    points = (
        changes.groupBy(*keys, "_chunk", "_at")
        .agg(*[F.sum(s).alias(s) for s in sums])
        .where(" OR ".join(f"{s} <> 0" for s in sums))
    )
    order = W.partitionBy(*keys, "_chunk").orderBy("_at")
    so_far = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    chunk_end = (F.col("_chunk") + 1) * win.panes
    next_at = F.coalesce(F.lead("_at").over(order), chunk_end)
    return points.select(
        *keys,
        *[F.sum(s).over(so_far).alias(s) for s in sums],
        F.col("_at").alias("from_window"),
        (next_at - 1).alias("to_window"),
    ).where(F.col(sums[0]) > 0)


def sliding_sums(
    events: DataFrame, keys: list[str], ts_ms: Column, win: Sliding, sums: dict[str, str]
) -> DataFrame:
    """Sums per key and window, as intervals `from_window..to_window` of equal sums.
    `sums` maps output names to BIGINT expressions; the first one says how many rows
    there are, and windows where it is 0 do not occur."""
    first = events.where(ts_ms.isNotNull()).select(
        *keys, win.first_window(ts_ms).alias("_i"),
        *[F.expr(f"bigint({value})").alias(name) for name, value in sums.items()],
    )
    first = first.withColumn("_c", win.chunk(F.col("_i")))
    up, down = {n: n for n in sums}, {n: f"-{n}" for n in sums}
    # Enters in its own chunk, is carried into the next, and leaves there.
    changes = unroll(first, keys, [
        {"_chunk": "_c", "_at": "_i", **up},
        {"_chunk": "_c + 1", "_at": f"(_c + 1) * {win.panes}", **up},
        {"_chunk": "_c + 1", "_at": f"_i + {win.panes}", **down},
    ])
    return _sweep(changes, keys, win, list(sums))


def sliding_count(
    events: DataFrame, keys: list[str], ts_ms: Column, win: Sliding, count: str,
    weight: str = "1",
) -> DataFrame:
    """Events (or their summed `weight`) per key and window, as intervals."""
    return sliding_sums(events, keys, ts_ms, win, {count: weight})


def member_spans(
    events: DataFrame, keys: list[str], member: str, ts_ms: Column, win: Sliding
) -> DataFrame:
    """First and last window of each member per chunk: all that exact sliding
    distinct counts need. Both are plain min/max, so a hot member combines early."""
    e = events.where(ts_ms.isNotNull() & F.col(member).isNotNull()).select(
        *keys, member, win.first_window(ts_ms).alias("_i")
    )
    return e.groupBy(*keys, member, win.chunk(F.col("_i")).alias("_chunk")).agg(
        F.min("_i").alias("_first"), F.max("_i").alias("_last")
    )


def sliding_distinct(
    events: DataFrame, keys: list[str], member: str, ts_ms: Column, win: Sliding, count: str
) -> DataFrame:
    """Exact distinct members per key and window, as intervals of equal count."""
    e = events.where(ts_ms.isNotNull() & F.col(member).isNotNull()).select(
        *keys, member, win.first_window(ts_ms).alias("_first")
    )
    seen = e.withColumn("_last", F.col("_first")).withColumn("_chunk", win.chunk(F.col("_first")))
    return sliding_distinct_of_spans(seen, keys, member, win, count)


def sliding_distinct_of_spans(
    spans: DataFrame, keys: list[str], member: str, win: Sliding, count: str
) -> DataFrame:
    """The same from `member_spans`, of which there may be several per member and chunk
    (one per micro-batch, or one per event).

    A member is active in a chunk from its start until the windows carried over from
    the chunk before run out, and from its own first window to the end. If the two meet
    it never drops out.
    """
    seen = unroll(spans, [*keys, member], [
        {"_chunk": "_chunk", "_first": "_first", "_carried": "bigint(NULL)"},
        {"_chunk": "_chunk + 1", "_first": "bigint(NULL)", "_carried": "_last"},
    ])
    merged = seen.groupBy(*keys, member, "_chunk").agg(
        F.min("_first").alias("_first"), (F.max("_carried") + win.panes).alias("_out")
    )
    gap = "coalesce(_first > _out, true)"
    changes = unroll(merged, [*keys, "_chunk"], [
        {"_at": f"_chunk * {win.panes}", count: "if(_out IS NULL, 0L, 1L)"},
        {"_at": "_out", count: f"if(_out IS NOT NULL AND {gap}, -1L, 0L)"},
        {"_at": "_first", count: f"if(_first IS NOT NULL AND {gap}, 1L, 0L)"},
    ]).where(f"{count} <> 0")
    return _sweep(changes, keys, win, [count])


def describe(intervals: DataFrame, win: Sliding, date: str = "partition_date") -> DataFrame:
    """Readable window bounds. No interval crosses the end of a day, so the date of
    the window end is one value per row."""
    return intervals.select(
        *[c for c in intervals.columns if c not in ("from_window", "to_window")],
        F.date_format(win.end_time(F.col("from_window")), DATE_TIME).alias("first_window_end"),
        F.date_format(win.end_time(F.col("to_window")), DATE_TIME).alias("last_window_end"),
        (F.col("to_window") - F.col("from_window") + 1).alias("windows"),
        F.date_format(win.end_time(F.col("from_window")), DATE).alias(date),
    )


def expand(intervals: DataFrame, win: Sliding) -> DataFrame:
    """One row per key and window, with start and end in epoch milliseconds."""
    rows = intervals.withColumn(
        "_i", F.explode(F.sequence(F.col("from_window"), F.col("to_window")))
    )
    end = F.col("_i") * (win.slide_s * 1000)
    return rows.select(
        *[c for c in intervals.columns if c not in ("from_window", "to_window")],
        (end - win.size_s * 1000).alias("window_start_ms"),
        end.alias("window_end_ms"),
    )


def window_at(
    events: DataFrame, keys: list[str], ts_ms: Column, win: Sliding, end_ms: int, count: str
) -> DataFrame:
    """The one window a dashboard shows: the last that ended at or before `end_ms`."""
    end = end_ms // (win.slide_s * 1000) * (win.slide_s * 1000)
    inside = events.where((ts_ms >= end - win.size_s * 1000) & (ts_ms < end))
    return inside.groupBy(*keys).agg(F.count("*").alias(count))
