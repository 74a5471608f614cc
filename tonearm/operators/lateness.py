"""Which rows come too late for every window they belong to.

The watermark is the largest event time seen before, less the allowed disorder. A row is
late when its last window, plus the allowed lateness, lies behind that watermark.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tonearm.operators.sliding import Sliding

DISORDER_MS = 3_000
ALLOWED_LATENESS_MS = 20_000


def is_late(event: Column, high_water: Column, win: Sliding) -> Column:
    last_end = (win.first_window(event) + (win.panes - 1)) * (win.slide_s * 1000)
    late = last_end + (ALLOWED_LATENESS_MS + DISORDER_MS) <= high_water
    return F.coalesce(late, F.lit(False))
