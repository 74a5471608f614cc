"""Sliding windows against brute force over every window."""

import random

import pytest
from pyspark.sql import functions as F

from tonearm.operators import sliding
from tonearm.operators.sliding import Sliding

WIN = Sliding(60, 5)
BASE = 1_700_000_000_000


def events(seed, n, span_ms, keys=3, users=4):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        ts = BASE + rnd.randrange(span_ms)
        if rnd.random() < 0.3:
            ts -= ts % 5000  # right on a boundary
        out.append((rnd.randrange(keys), rnd.randrange(users), ts))
    return out


def brute(rows, win, measure):
    """Every non-empty window by its end."""
    out = {}
    size, slide = win.size_s * 1000, win.slide_s * 1000
    for key, user, ts in rows:
        end = (ts // slide + 1) * slide
        while end - size <= ts < end:
            out.setdefault((key, end), []).append(user)
            end += slide
    return {k: measure(v) for k, v in out.items()}


def expanded(intervals, win, count):
    rows = sliding.expand(intervals, win).collect()
    found = {(r["k"], r["window_end_ms"]): r[count] for r in rows}
    assert len(found) == len(rows), "windows overlap"
    assert all(r["window_end_ms"] - r["window_start_ms"] == win.size_s * 1000 for r in rows)
    return found


@pytest.mark.parametrize("seed,n,span", [(1, 40, 400_000), (2, 200, 90_000), (3, 5, 10_000_000)])
def test_counts_equal_brute_force(spark, seed, n, span):
    rows = events(seed, n, span)
    df = spark.createDataFrame(rows, "k long, u long, ts long")
    got = sliding.sliding_count(df, ["k"], F.col("ts"), WIN, "n")
    assert expanded(got, WIN, "n") == brute(rows, WIN, len)


@pytest.mark.parametrize("seed,n,span", [(4, 40, 400_000), (5, 300, 90_000), (6, 60, 1_000_000)])
def test_distinct_equals_brute_force(spark, seed, n, span):
    rows = events(seed, n, span)
    df = spark.createDataFrame(rows, "k long, u long, ts long")
    got = sliding.sliding_distinct(df, ["k"], "u", F.col("ts"), WIN, "n")
    assert expanded(got, WIN, "n") == brute(rows, WIN, lambda us: len(set(us)))
    spans = sliding.member_spans(df, ["k"], "u", F.col("ts"), WIN)
    stored = sliding.sliding_distinct_of_spans(spans, ["k"], "u", WIN, "n")
    assert expanded(stored, WIN, "n") == brute(rows, WIN, lambda us: len(set(us)))


def test_negative_times(spark):
    rows = [(0, 0, -1), (0, 1, -5000), (0, 2, 0)]
    df = spark.createDataFrame(rows, "k long, u long, ts long")
    got = sliding.sliding_count(df, ["k"], F.col("ts"), WIN, "n")
    assert expanded(got, WIN, "n") == brute(rows, WIN, len)


def test_one_event_is_in_every_window_of_its_day(spark):
    df = spark.createDataFrame([(1, BASE)], "k long, ts long")
    got = sliding.sliding_count(df, ["k"], F.col("ts"), sliding.DAY_BY_5S, "n")
    assert sliding.expand(got, sliding.DAY_BY_5S).count() == 17_280


def test_boundary_event_starts_its_own_pane(spark):
    at = BASE - BASE % 5000
    df = spark.createDataFrame([(1, at)], "k long, ts long")
    got = sliding.sliding_count(df, ["k"], F.col("ts"), WIN, "n")
    ends = sorted(r["window_end_ms"] for r in sliding.expand(got, WIN).collect())
    assert ends[0] == at + 5000 and ends[-1] == at + 60_000


def test_window_at(spark):
    rows = events(7, 100, 200_000)
    df = spark.createDataFrame(rows, "k long, u long, ts long")
    end = (BASE + 120_000) // 5000 * 5000
    got = sliding.window_at(df, ["k"], F.col("ts"), WIN, end + 1234, "n").collect()
    want = {k: v for (k, e), v in brute(rows, WIN, len).items() if e == end}
    assert {r["k"]: r["n"] for r in got} == want


def test_a_hot_key_makes_no_large_group(spark):
    # One key holds all rows, many per pane; no running sum sees more than its chunk.
    df = spark.range(200_000).selectExpr("0L AS k", "id % 50 AS u", f"{BASE}L + id * 3 AS ts")
    first = WIN.first_window(F.col("ts"))
    assert df.select(first.alias("i")).distinct().count() > 2 * WIN.panes
    got = sliding.sliding_count(df, ["k"], F.col("ts"), WIN, "n")
    chunk = F.floor(F.col("from_window") / WIN.panes)
    assert got.groupBy(chunk).count().agg(F.max("count")).first()[0] <= 2 * WIN.panes
    total = sliding.expand(got, WIN).agg(F.sum("n")).first()[0]
    assert total == 200_000 * WIN.panes


def test_no_interval_crosses_midnight(spark):
    rows = events(8, 50, 3 * 86_400_000, keys=1)
    df = spark.createDataFrame(rows, "k long, u long, ts long")
    got = sliding.describe(
        sliding.sliding_count(df, ["k"], F.col("ts"), sliding.DAY_BY_5S, "n"), sliding.DAY_BY_5S
    )
    assert got.where("date(first_window_end) <> date(last_window_end)").count() == 0
    assert got.where("string(date(first_window_end)) <> partition_date").count() == 0
    assert got.where("windows < 1").count() == 0
