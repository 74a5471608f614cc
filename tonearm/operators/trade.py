"""Daily trade summaries over the two order facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RENEWAL_WINDOW_S = 3 * 24 * 3600


def album_sales(orders: DataFrame) -> DataFrame:
    """Orders (not copies) and money per album and day."""
    return orders.groupBy("album_id", "dt").agg(
        F.count("order_num").alias("sales"), F.sum("amount").alias("amount")
    )


def _near_end():
    return F.abs(F.col("create_ts") - F.col("vip_end")) < RENEWAL_WINDOW_S


def renewal_rate(orders: DataFrame) -> DataFrame:
    """Share of a day's memberships bought within three days of the old one's end."""
    near = F.when(_near_end(), 1).otherwise(0)
    return orders.groupBy("dt").agg((F.sum(near) / F.count("*")).alias("renew_rate"))


def renewal_rate_literal(orders: DataFrame) -> DataFrame:
    """The rate as first written: it counts the zeros too, so it is always 1."""
    flag = F.when(_near_end(), 1).otherwise(0)
    return orders.groupBy("dt").agg((F.count(flag) / F.count("*")).alias("renew_rate"))
