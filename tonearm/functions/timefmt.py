"""Epoch-millisecond columns to and from date strings, in the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three text formats of the warehouse.
DATE = "yyyy-MM-dd"
PARTITION_DATE = "yyyyMMdd"
DATE_TIME = "yyyy-MM-dd HH:mm:ss"


def ms_to_date(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), DATE)


def ms_to_date_time(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), DATE_TIME)


def ms_to_partition_date(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), PARTITION_DATE)


def seconds_to_partition_date(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), PARTITION_DATE)


def date_time_to_ms(text: Column) -> Column:
    return F.unix_millis(F.to_timestamp(text, DATE_TIME))


def date_to_ms(text: Column) -> Column:
    return F.unix_millis(F.to_timestamp(text, DATE))


def floor_div(value: Column, step: int) -> Column:
    """Integer division that rounds down, exact for the whole BIGINT range."""
    return F.call_function("div", value - F.pmod(value, F.lit(step)), F.lit(step))


def align_ms(ms: Column, step_ms: int) -> Column:
    """Next multiple of the step strictly after the given time."""
    return (floor_div(ms, step_ms) + 1) * step_ms
