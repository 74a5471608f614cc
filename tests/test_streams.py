"""Streams in several micro-batches against the batch form of the same rows."""

import json

import pytest
from pyspark.sql import functions as F

from test_presence import PLAYS, plays, replay
from tonearm.functions.naming import snake, snake_case, to_message
from tonearm.operators import lateness, sliding
from tonearm.operators import presence as presence_ops
from tonearm.plans import bridge, facts
from tonearm.session import work_dir
from tonearm.sources import changefeed, logs, sinks
from tonearm.sources.keyed import KeyedTable
from tonearm.streaming import facts as fact_stream
from tonearm.streaming import governance, presence
from tonearm.streaming import sliding as sliding_stream
from tonearm.streaming import summary as summary_stream
from tonearm.streaming.runner import finish, run_stream, run_to_files

DAY = 86_400_000


def write_json(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(json.dumps(r) for r in rows) + "\n")


class Unwritten(KeyedTable):
    def upsert(self, changes, batch_id):
        raise ZeroDivisionError


def test_presence_over_batches(spark, sf_dir, tmp_path, monkeypatch):
    table = presence._last
    far = 3 * 10**17  # times that no clock shows
    rows = [(p, s + 1, None if lead is None else lead + 1, u + 1, ts + (far if p > 60 else 0))
            for p, s, lead, u, ts in plays(11, n=90)]
    rows[5] = (*rows[5][:4], None)
    rows.sort(key=lambda r: (r[4] is not None, r[4] or 0, r[0]))
    out = f"{tmp_path}/out"
    sink = presence.presence_sink(out)
    for i in range(3):
        batch = spark.createDataFrame(rows[i * 30:(i + 1) * 30], PLAYS)
        with monkeypatch.context() as m:  # lost when the songs are stored and the last changes are not
            m.setattr(presence, "_last", lambda o: Unwritten(*vars(table(o)).values()))
            with pytest.raises(ZeroDivisionError):
                sink(batch, i)
        sink(batch, i)
        sink(batch, i)  # replay
        want = replay([(*r[:4], -1 if r[4] is None else r[4]) for r in rows[:(i + 1) * 30]])
        got = spark.read.parquet(f"{out}/online/batch_id={i}").collect()
        assert {r["song_id"]: r["current_online_count"] for r in got} == want
    seen = spark.createDataFrame(rows, PLAYS)
    batch = presence_ops.online_listeners(presence_ops.presence_changes(seen)).collect()
    assert {r["song_id"]: r["current_online_count"] for r in batch} == want
    shown = presence.online_report(presence.current_listeners(spark, out), bridge.dims(spark, sf_dir))
    assert shown.count() == len(want) and shown.first()["partition_time"] >= "2024"


def test_counts_over_batches_and_late_rows(spark, tmp_path):
    base = 1_704_067_200_000
    on_time = [(1, base + i * 7_000) for i in range(20)] + [(2, base + DAY)]
    late_but_open = [(1, base + 1_000)]  # a day's windows of it are still open
    too_late = [(1, base - 40_000)]  # its last window ended before the watermark
    out = str(tmp_path / "out")
    sink = sliding_stream.count_sink(out, ["k"], "ts", sliding.DAY_BY_5S)
    for i, rows in enumerate([on_time, late_but_open + too_late]):
        batch = spark.createDataFrame(rows, "k long, ts long")
        sink(batch, i)
        sink(batch, i)  # replay
    late = spark.read.parquet(f"{out}/late").collect()
    assert [(r["k"], r["ts"]) for r in late] == too_late
    df = spark.createDataFrame(on_time + late_but_open, "k long, ts long")
    want = sliding.sliding_count(df, ["k"], F.col("ts"), sliding.DAY_BY_5S, "n")
    got = sliding_stream.stored_counts(spark, out, ["k"], sliding.DAY_BY_5S, "n")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    now = sliding_stream.current_counts(
        spark, out, ["k"], sliding.DAY_BY_5S, "n", base + 3_600_000
    )
    assert {r["k"]: r["n"] for r in now.collect()} == {1: 21}


def emitted_by_rule(batches, win, distinct):
    """What the windows hold when they are emitted last, batch after batch."""
    rows, high, closed, shown = [], None, None, {}
    for batch in batches:
        late = [r for r in batch if high is not None
                and (r[2] // 5000 + win.panes) * 5000 + 23_000 <= high]
        rows += [r for r in batch if r not in late]
        low = closed + 1 - 4 if closed is not None else min(r[2] // 5000 + 1 for r in batch)
        high = max([r[2] for r in batch] + ([] if high is None else [high]))
        closed = max((high - 3000) // 5000, closed or 0)
        for i in range(low, closed + 1):
            inside = [r for r in rows if i - win.panes < r[2] // 5000 + 1 <= i]
            for k in {r[0] for r in rows}:
                mine = [r[1] for r in inside if r[0] == k]
                shown[k, i] = len(set(mine)) if distinct else len(mine)
    return {k: n for k, n in shown.items() if n}


@pytest.mark.parametrize("distinct", [False, True])
def test_windows_are_emitted_and_corrected(spark, tmp_path, distinct):
    win = sliding.Sliding(60, 5)
    base = 1_704_067_200_000
    batches = [
        [(1, i % 4, base + i * 3_000) for i in range(40)],
        # Late by some seconds, by a minute, and for good; and what moves time on.
        [(1, 9, base + 112_000), (2, 1, base + 60_000), (1, 1, base - 200_000), (2, 2, base + 150_000)],
        [(2, 2, base + 146_000), (2, 3, base + 400_000)],
    ]
    summary = (summary_stream.Distinct(["k"], "m", "n", win) if distinct
               else summary_stream.Counts(["k"], "n", win))
    sink = summary_stream.summary_sink(str(tmp_path), summary, "ts")
    for i, rows in enumerate(batches):
        batch = spark.createDataFrame(rows, "k long, m long, ts long")
        sink(batch, i)
        sink(batch, i)  # replay
    spans = summary_stream.emitted(spark, str(tmp_path), summary).collect()
    got = {(r["k"], i): r["n"] for r in spans for i in range(r["from_window"], r["to_window"] + 1)}
    assert got == emitted_by_rule(batches, win, distinct)
    late = spark.read.parquet(f"{tmp_path}/late").collect()
    assert [(r["k"], r["ts"]) for r in late] == [(1, base - 200_000)]
    slots = spark.read.parquet(f"{tmp_path}/state")
    assert slots.select("slot").distinct().count() == 2
    oldest = slots.where("slot = 0").agg(F.min("_last" if distinct else "pane")).first()[0]
    assert oldest > (base + 397_000) // 5000 - 3 - win.panes - 1


def test_distinct_over_batches(spark, tmp_path):
    base = 1_704_067_200_000
    rows = [(1, i % 5, base + i * 61_000) for i in range(120)]
    out = str(tmp_path / "out")
    sink = sliding_stream.distinct_sink(out, ["p"], "u", "ts", sliding.HOUR_BY_5S)
    for i in range(3):
        sink(spark.createDataFrame(rows[i * 40:(i + 1) * 40], "p long, u long, ts long"), i)
    df = spark.createDataFrame(rows, "p long, u long, ts long")
    want = sliding.sliding_distinct(df, ["p"], "u", F.col("ts"), sliding.HOUR_BY_5S, "n")
    got = sliding_stream.stored_distinct(spark, out, ["p"], "u", sliding.HOUR_BY_5S, "n")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_late_rule(spark):
    base = 1_704_067_200_000
    end = (base // 5000 + 17_280) * 5000
    for high, late in ((None, False), (end + 22_999, False), (end + 23_000, True)):
        rule = lateness.is_late(F.lit(base), F.lit(high).cast("bigint"), sliding.DAY_BY_5S)
        assert spark.range(1).select(rule).first()[0] is late


def test_log_fan_out_equals_batch(spark, sf_dir, tmp_path):
    lines = bridge.log_lines(spark, sf_dir)
    lines.repartition(2).write.text(f"{tmp_path}/in")
    out = f"{tmp_path}/out"
    loads = []

    def load():
        loads.append(1)
        return bridge.dims(spark, sf_dir)

    sink = fact_stream.log_sink(fact_stream.refreshed(load), out)
    stream = logs.parse_log(logs.line_stream(spark, f"{tmp_path}/in", max_files=1))
    finish(run_stream(stream, sink, f"{out}/checkpoint"))
    assert len(loads) == 2  # read again for each batch
    parsed = logs.parse_log(lines)
    for spec in facts.LOG_FACTS:
        want = facts.build_fact(parsed, spec, bridge.dims(spark, sf_dir))
        got = spark.read.parquet(f"{out}/{spec.name}").select(*want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    dirty = spark.read.parquet(f"{out}/dirty")
    assert dirty.count() == facts.dirty_log_records(parsed).count()
    records = {r["record"] for r in dirty.collect()}
    assert any('"extra":null,"more":{"a":[1,2.50]}' in r for r in records)
    assert any('"common":"oops"' in r and '"extra":"z"' in r for r in records)
    dropped = spark.read.parquet(f"{out}/dropped")
    assert dropped.count() == facts.dropped(parsed).agg(F.sum("dropped")).first()[0]
    assert dropped.where("record LIKE 'not json %'").count() > 0


def test_only_the_asked_type_and_fields_are_parsed(spark, sf_dir, tmp_path):
    bridge.log_lines(spark, sf_dir).write.text(f"{tmp_path}/lines")
    lines = spark.read.text(f"{tmp_path}/lines")
    key = "spark.sql.debug.maxToStringFields"
    spark.conf.set(key, "1000")
    try:
        plan = facts.of_lines(lines, facts.LOGIN)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset(key)
    assert "get_json_object(value" in plan and plan.index("from_json") < plan.index("get_json_object")
    assert "login_id" in plan and "province_id" in plan
    assert "comment_id" not in plan and "song_id" not in plan


def test_governance_stream_drops_nothing_in_order(spark, tmp_path):
    base = 1_704_067_200_000
    rows = [{"common": {"play_id": 1, "song_id": i % 3, "user_id": 1}, "channel": "A",
             "mac_id": "m", "type": "play", "ts": base + i * 60_000} for i in range(200)]
    for i in range(2):
        write_json(tmp_path / "in" / f"{i}.json", rows[i * 100:(i + 1) * 100])
    stream = logs.parse_log(logs.line_stream(spark, str(tmp_path / "in"), max_files=1))
    out = f"{tmp_path}/out"
    finish(run_to_files(governance.dirty_windows(stream), f"{out}/w", f"{out}/c"))
    got = spark.read.parquet(f"{out}/w").where("window_end = '2024-01-01 02:00:00'").first()
    assert (got["dirty_count"], got["total_count"]) == (20, 60)


def test_partition_writes_do_not_duplicate(spark, sf_dir, tmp_path):
    fact = facts.clean_fact(bridge.cancelled_orders(spark, sf_dir), facts.CANCEL)
    fact = fact.withColumn("dt", F.substring("dt", 1, 6))
    path = f"{tmp_path}/t"
    sinks.write_partitions(fact, path)
    sinks.write_partitions(fact, path)
    assert spark.read.parquet(path).count() == fact.count()
    one = sinks.read_days(spark, path, ["199507"])
    assert one.count() == fact.where("dt = '199507'").count() > 0
    assert "PartitionFilters: [isnotnull(dt" in one._jdf.queryExecution().toString() or (
        "PartitionFilters: [cast(dt" in one._jdf.queryExecution().toString())


def test_catalog_table_insert_and_export(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS w LOCATION '{tmp_path}/w'")
    try:
        df = spark.createDataFrame([("5", 2, 10, "20240101"), ("6", 1, 7, "20240102")],
                                   "album_id string, sales long, amount long, dt string")
        sinks.insert_partitions(df, "w.album_sales")
        sinks.insert_partitions(df.where("dt = '20240101'"), "w.album_sales")
        assert spark.table("w.album_sales").count() == 2
        for _ in range(2):  # a rerun replaces
            sinks.export_columns(
                spark, "w.album_sales", ["album_id", "sales"], "json", f"{tmp_path}/export"
            )
        assert spark.read.json(f"{tmp_path}/export").count() == 2
        assert sorted(spark.read.json(f"{tmp_path}/export").columns) == ["album_id", "sales"]
    finally:
        spark.sql("DROP DATABASE w CASCADE")


def test_a_replayed_batch_replaces_itself(spark, tmp_path):
    path = f"{tmp_path}/t"
    sinks.write_batch(spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string"), path, 0)
    sinks.write_batch(spark.createDataFrame([(1, "c")], "k long, v string"), path, 1)
    sinks.write_batch(spark.createDataFrame([(1, "d")], "k long, v string"), path, 1)
    got = spark.read.parquet(path).collect()
    assert {(r["batch_id"], r["k"]): r["v"] for r in got} == {(0, 1): "a", (0, 2): "b", (1, 1): "d"}


def test_messages_and_olap_sink(spark, tmp_path):
    df = spark.createDataFrame([(1, 2, 3)], "songId long, searchCount long, updateTime long")
    text = to_message(df, internal=("updateTime",)).first()["value"]
    assert json.loads(text) == {"song_id": 1, "search_count": 2}
    sink = sinks.olap_sink("parquet", f"{tmp_path}/o", internal=("updateTime",))
    sink(df, 0)
    sink(df, 0)  # replay
    sink(df, 1)
    stored = spark.read.parquet(f"{tmp_path}/o")
    assert stored.columns == ["songId", "searchCount", "batch_id"] and stored.count() == 2
    assert snake("windowStart") == "window_start"
    assert snake_case(df).columns == ["song_id", "search_count", "update_time"]
    assert to_message(df).columns == ["value"]


def test_closed_partitions(spark):
    days = spark.createDataFrame([("20240101",), ("20240102",)], "dt string")
    end = 1_704_153_600_000  # 2024-01-02 00:00:00
    assert sinks.closed_partitions(days, end + 599_999).count() == 0
    got = sinks.closed_partitions(days, end + 600_000).collect()
    assert [r["dt"] for r in got] == ["20240101"]


def test_commit_makes_closed_days_visible(spark, tmp_path):
    path = f"{tmp_path}/t"
    df = spark.createDataFrame([(1, "20240101"), (2, "20240102")], "v long, dt string")
    sinks.write_partitions(df, path)
    spark.sql(f"CREATE TABLE sealed (v bigint, dt string) USING parquet PARTITIONED BY (dt) "
              f"LOCATION '{path}'")
    try:
        end = 1_704_153_600_000
        assert sinks.commit_partitions(df, "sealed", path, end + 600_000) == ["20240101"]
        assert [r["v"] for r in spark.table("sealed").collect()] == [1]
        assert sinks.commit_partitions(df, "sealed", path, end + 90_000_000) == [
            "20240101", "20240102"]
        assert spark.table("sealed").count() == 2
    finally:
        spark.sql("DROP TABLE sealed")


def test_snapshot_sorts_before_changes(spark):
    rows = spark.createDataFrame([(1, "a")], "user_id long, user_name string")
    snap = changefeed.snapshot_as_changes(rows, "music", "ods_user", 5)
    row = snap.first()
    assert (row["op"], row["before"], row["after"]["user_name"]) == ("r", None, "a")
    assert row["source"]["table"] == "ods_user"


def test_map_images_become_structs(spark):
    text = '{"op":"d","before":{"user_id":3},"source":{"db":"m","table":"t","pos":1},"ts_ms":1}'
    feed = changefeed.parse_changes(spark.createDataFrame([(text,)], "value string"))
    row = changefeed.row_images_as(feed, ["user_id", "gender"]).first()
    assert row["before"]["user_id"] == "3" and row["before"]["gender"] is None
    assert row["after"] is None


def test_kafka_options():
    opts = logs.kafka_options("host:9092", "log", max_offsets=10)
    assert opts["startingOffsets"] == "latest" and opts["maxOffsetsPerTrigger"] == "10"
    assert "failOnDataLoss" not in opts
    own = logs.kafka_options("host:9092", "log", starting="earliest", failOnDataLoss="true", subscribe="b")
    assert (own["startingOffsets"], own["failOnDataLoss"], own["subscribe"]) == ("earliest", "true", "b")


def test_arrival_clock(spark):
    df = sliding_stream.arrival_clock(spark.range(1), "ts")
    assert df.first()["ts"] > 1_700_000_000_000


def test_work_dir_is_fresh(spark):
    assert work_dir(spark, "x").rsplit("/", 1)[1].startswith("x-")


@pytest.mark.parametrize("text,ms", [("2022-02-03 04:05:06", 1643861106000)])
def test_time_texts(spark, text, ms):
    from tonearm.functions import timefmt as tf
    row = spark.range(1).select(
        tf.date_time_to_ms(F.lit(text)).alias("ms"),
        tf.ms_to_date_time(F.lit(ms)).alias("text"),
        tf.ms_to_date(F.lit(ms)).alias("day"),
        tf.ms_to_partition_date(F.lit(ms)).alias("part"),
        tf.date_to_ms(F.lit("2022-02-03")).alias("day_ms"),
    ).first()
    assert row == (ms, text, "2022-02-03", "20220203", 1643846400000)


def test_a_trade_batch_holds_no_texts_of_clean_rows(spark, sf_dir, tmp_path, monkeypatch):
    base = 1_704_067_200

    def order(i, **more):
        row = {"order_id": str(i), "order_num": "1", "user_id": str(i % 7 + 1), "album_id": "5", "amount": "9",
               "status_type_id": "101", "pay_type": "A", "channel_id": "2", "create_ts": str(base + i), **more}
        return json.dumps({"op": more.pop("op", "r"), "after": row, "ts_ms": (base + i) * 1000,
                           "source": {"db": "music", "table": "ods_album_order", "pos": i}})

    rows = [order(i) for i in range(1, 40)] + [order(41, amount="x"), order(42, user_id=None), order(43, order_id="-1")]
    rows += [order(44, status_type_id="102"), order(45, status_type_id=None), order(46, op="d"), "no json", order(1)]
    changes = changefeed.parse_changes(spark.createDataFrame([(r,) for r in rows], "value string"), list(facts.ALBUM.columns))
    held = []
    judge = facts.judge_trade
    monkeypatch.setattr(facts, "judge_trade", lambda *a: held.append(judge(*a)) or held[-1])
    sink = fact_stream.trade_sink(lambda: bridge.dims(spark, sf_dir), str(tmp_path), facts.ALBUM, "month")
    for _ in range(2):  # a replay
        sink(changes, 0)
    texts = [r["_record"] for r in held[0].where("_clean").collect()]
    assert texts and set(texts) == {None} and not {"value", "after", "before"} & set(held[0].columns)
    key = lambda df: sorted(map(str, df.collect()))
    want = facts.build_fact(changes, facts.ALBUM, bridge.dims(spark, sf_dir))
    got = spark.read.parquet(f"{tmp_path}/dwd_trade_album")
    assert want.count() == 40 and key(got.select(*want.columns)) == key(want)
    want = facts.dirty_trade_records(changes, facts.ALBUM)
    got = spark.read.parquet(f"{tmp_path}/dirty")
    assert want.count() == 4 and key(got.select(*want.columns)) == key(want)
