"""The keyed table, versions and commits: replays, lost batches, deletes, sums."""

import pytest
from pyspark.sql import functions as F

from tonearm.operators.sliding import DAY_BY_5S
from tonearm.sources.keyed import KeyedTable
from tonearm.streaming import commits, corrected
from tonearm.streaming.arrivals import arrivals_sink
from tonearm.streaming.runner import finish, run_stream
from tonearm.streaming.summary import Counts, emitted
from tonearm.streaming.versions import Versions

SCHEMA = "k bigint, v string, n bigint"


def batch(spark, rows, schema=SCHEMA + ", _deleted boolean"):
    return spark.createDataFrame(rows, schema)


def content(spark, table):
    return sorted((tuple(r) for r in table.read(spark).collect()), key=str)


def test_last_value_of_each_key_stays(spark, tmp_path):
    t = KeyedTable(f"{tmp_path}/t", SCHEMA, ["k"])
    assert content(spark, t) == []
    t.upsert(batch(spark, [(1, "a", 1, None), (2, "b", 1, False), (None, "none", 0, False)]), 0)
    t.upsert(batch(spark, [(1, "c", 2, False)]), 1)
    t.upsert(batch(spark, []), 2)
    t.upsert(batch(spark, [(2, None, None, True), (3, "d", 3, False)]), 3)
    t.upsert(batch(spark, [(None, "one", 1, False)]), 4)
    assert content(spark, t) == [(1, "c", 2), (3, "d", 3), (None, "one", 1)]
    t.upsert(batch(spark, [(2, "back", 5, False)]), 5)
    assert (2, "back", 5) in content(spark, t)


def test_a_batch_counts_once_however_often_it_is_run(spark, tmp_path, monkeypatch):
    t = KeyedTable(f"{tmp_path}/t", SCHEMA, ["k"], add=("n",))
    t.upsert(batch(spark, [(1, "a", 10, False), (2, "b", 1, False)]), 0)
    second = batch(spark, [(1, "c", 5, False), (3, "d", 1, False)])
    # Lost after staging, before the table is touched.
    with monkeypatch.context() as m:
        m.setattr(type(second), "hint", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            t.upsert(second, 1)
    assert content(spark, t) == [(1, "a", 10), (2, "b", 1)]
    for _ in range(3):
        t.upsert(second, 1)
    assert content(spark, t) == [(1, "c", 15), (2, "b", 1), (3, "d", 1)]
    t.upsert(batch(spark, [(1, "e", 1, False)]), 2)
    assert (1, "e", 16) in content(spark, t)


def test_only_touched_partitions_are_replaced(spark, tmp_path):
    t = KeyedTable(f"{tmp_path}/t", "k bigint, day string, n bigint", ["k", "day"], "day", buckets=4)
    t.upsert(spark.createDataFrame([(k, f"2024-01-0{d}", k * d) for k in range(20) for d in (1, 2, 3)], t.schema), 0)
    files = lambda: {str(p): p.stat().st_mtime_ns for p in (tmp_path / "t/rows").rglob("*.parquet")}
    before = files()
    t.upsert(spark.createDataFrame([(7, "2024-01-02", -1)], t.schema), 1)
    changed = {p for p, at in files().items() if before.get(p) != at}
    assert len(changed) == 1 and "day=2024-01-02" in changed.pop()
    assert t.read(spark).count() == 60
    assert t.read(spark, ["2024-01-02", "2024-02-01"]).where("n < 0").count() == 1
    assert t.read(spark, ["2024-02-01"]).count() == 0


def test_newest_complete_version(spark, tmp_path):
    v = Versions(f"{tmp_path}/v")
    v.publish(spark.range(1), 3)
    v.publish(spark.range(2), 12)
    (tmp_path / "v/version=13").mkdir()
    assert v.newest(spark) == 12 and v.read(spark).count() == 2 and v.read(spark, 3).count() == 1


class Progress:
    def __init__(self, watermark):
        self.lastProgress = {"eventTime": {"watermark": watermark} if watermark else {}}


def test_watermark_of_a_progress():
    assert commits.watermark_ms(None) is None and commits.watermark_ms(Progress(None)) is None
    assert commits.watermark_ms(Progress("1970-01-01T00:00:00.000Z")) is None
    assert commits.watermark_ms(Progress("2024-01-02T00:00:01.250Z")) == 1_704_153_601_250


def stream(spark, tmp_path, rows):
    """One more file of (song_id, ts) and the stream over all of them."""
    spark.createDataFrame(rows, "song_id long, ts long").coalesce(1).write.mode("append").json(f"{tmp_path}/in")
    return spark.readStream.schema("song_id long, ts long").json(f"{tmp_path}/in")


def test_late_rows_are_those_that_the_state_drops(spark, tmp_path):
    day, start = 86_400_000, 1_700_000_000_000
    win, keys, out = DAY_BY_5S, ["song_id"], f"{tmp_path}/out"
    summary, dropped = Counts(keys, "n", win), 0
    edge = start + 5 * day - corrected.kept_for_ms(win)
    batches = [
        [(1, start), (2, start + 10)], [(1, start + 5 * day)], [(2, start + 5 * day + 1)],
        [(1, start), (2, start + 1), (3, start + 5 * day - 3_600_000), (1, edge - 5_000), (1, edge + 5_000), (9, None)],
    ]
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        for rows in batches:
            source = stream(spark, tmp_path, rows)
            query = run_stream(
                corrected.changed_panes(source, keys, "ts", win), corrected.corrected_sink(out, summary), f"{out}/c1", mode="update"
            )
            finish(query)
            dropped += sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
            finish(run_stream(source, corrected.late_sink(out, "ts", win), f"{out}/c2"))
    finally:
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
    late = spark.read.parquet(f"{out}/late").collect()
    assert sorted((r["song_id"], r["ts"]) for r in late) == [(1, start), (1, edge - 5_000), (2, start + 1)]
    assert dropped == len(late)
    windows = emitted(spark, out, summary)
    # The row that came an hour late changed the last windows and was not in those before.
    three = windows.where("song_id = 3").collect()
    closed = (start + 5 * day + 1 - 3000) // 5000
    assert [(r["from_window"], r["to_window"], r["n"]) for r in three] == [(closed - 3, closed, 1)]


def test_a_clock_reading_is_kept_for_a_replay(spark, tmp_path):
    readings = iter([1_700_000_000_000, 1_700_000_020_000, 1_700_000_010_000, 1])
    out, summary = f"{tmp_path}/out", Counts(["song_id"], "n", DAY_BY_5S)
    sink = arrivals_sink(out, summary, lambda _: next(readings))
    rows = spark.createDataFrame([(1,), (1,), (2,)], "song_id long")
    sink(rows, 0)
    sink(rows, 1)
    sink(rows, 1)  # takes no new reading and counts once
    sink(rows.where("song_id = 2"), 2)  # a clock that goes back is held
    state = corrected.pane_table(out, ["song_id"]).read(spark).groupBy("song_id").agg(F.sum("n")).collect()
    assert sorted(map(tuple, state)) == [(1, 4), (2, 3)]
    got = {(r["song_id"], r["n"]) for r in emitted(spark, out, summary).collect()}
    assert got == {(1, 2), (2, 1)}
    assert next(readings) == 1
