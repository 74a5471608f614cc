"""Dirty records by fact and kind over a sliding hour, with their share of the log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonearm.functions.timefmt import DATE_TIME
from tonearm.functions.unroll import unroll
from tonearm.operators.quality import OUT_OF_RANGE, UNCASTABLE_OR_MISSING
from tonearm.operators.sliding import HOUR_BY_1MIN, Sliding, sliding_sums


def quality_panes(tagged: DataFrame, win: Sliding = HOUR_BY_1MIN) -> DataFrame:
    """Rows of each verdict per fact and slide; at most one row per fact and minute."""
    known = tagged.where(F.col("fact").isNotNull() & F.col("ts").isNotNull())
    return known.groupBy("fact", win.first_window(F.col("ts")).alias("pane")).agg(
        F.count("*").alias("total"),
        F.count_if(F.col("dirty_type") == OUT_OF_RANGE).alias("out_of_range"),
        F.count_if(F.col("dirty_type") == UNCASTABLE_OR_MISSING).alias("uncastable"),
    )


def dirty_windows(panes: DataFrame, win: Sliding = HOUR_BY_1MIN) -> DataFrame:
    """Panes to windows, one row per window, fact and kind of fault that occurs."""
    begin = (F.col("pane") - 1) * (win.slide_s * 1000)
    sums = {"total": "total", "out_of_range": "out_of_range", "uncastable": "uncastable"}
    spans = sliding_sums(panes, ["fact"], begin, win, sums)
    return by_kind(
        spans.selectExpr(
            "fact", "total", "out_of_range", "uncastable",
            "explode(sequence(from_window, to_window)) AS _i",
        ).selectExpr(
            "fact", "total", "out_of_range", "uncastable",
            f"timestamp_seconds((_i - {win.panes}) * {win.slide_s}) AS start",
            f"timestamp_seconds(_i * {win.slide_s}) AS end",
        )
    )


def by_kind(windows: DataFrame) -> DataFrame:
    """Windows `(start, end, fact, total, out_of_range, uncastable)` to one row per kind."""
    kinds = unroll(
        windows.where("out_of_range + uncastable > 0"), ["start", "end", "fact", "total"],
        [
            {"dirty_type": f"'{OUT_OF_RANGE}'", "dirty_count": "out_of_range"},
            {"dirty_type": f"'{UNCASTABLE_OR_MISSING}'", "dirty_count": "uncastable"},
        ],
    ).where("dirty_count > 0")
    return kinds.selectExpr(
        f"date_format(start, '{DATE_TIME}') AS window_start",
        f"date_format(end, '{DATE_TIME}') AS window_end",
        "fact",
        "dirty_type",
        "dirty_count",
        "total AS total_count",
        "dirty_count / total AS dirty_share",
    )
