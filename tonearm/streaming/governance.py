"""Dirty records per fact over a sliding hour, as a stream with a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonearm.operators.governance import by_kind
from tonearm.operators.quality import OUT_OF_RANGE, UNCASTABLE_OR_MISSING
from tonearm.plans.facts import tag_log

DISORDER = "3 seconds"


def dirty_windows(log: DataFrame, watermark: str = DISORDER) -> DataFrame:
    """Windows that have closed. Counted per minute first, so that the spread over the
    sixty windows of an hour acts on a few rows per fact, not on log rows."""
    tagged = tag_log(log).where(F.col("fact").isNotNull() & F.col("ts").isNotNull())
    timed = tagged.withColumn("event_ts", F.timestamp_millis("ts")).withWatermark(
        "event_ts", watermark
    )
    minutes = timed.groupBy(F.window("event_ts", "1 minute"), "fact").agg(
        F.count("*").alias("total"),
        F.count_if(F.col("dirty_type") == OUT_OF_RANGE).alias("out_of_range"),
        F.count_if(F.col("dirty_type") == UNCASTABLE_OR_MISSING).alias("uncastable"),
    )
    hours = minutes.groupBy(
        F.window(F.window_time("window"), "1 hour", "1 minute").alias("hour"), "fact"
    ).agg(
        F.sum("total").alias("total"),
        F.sum("out_of_range").alias("out_of_range"),
        F.sum("uncastable").alias("uncastable"),
    )
    return by_kind(hours.select(
        "hour.start", "hour.end", "fact", "total", "out_of_range", "uncastable"
    ))
