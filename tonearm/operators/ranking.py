"""Top-n reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def top_n(df: DataFrame, by: str, ties: str, n: int = 10, rank: str = "rank") -> DataFrame:
    """The n highest rows, numbered. Each task keeps its own n rows; only those are
    merged, and the numbering runs over n rows."""
    order = [F.desc(by), F.asc(ties)]
    best = df.orderBy(*order).limit(n)
    return best.withColumn(rank, F.row_number().over(W.orderBy(*order)))
