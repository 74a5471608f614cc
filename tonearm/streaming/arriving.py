"""Registered streams whose result depends on what arrives when.

Their table is cut by the time of arrival. A cut is put into the input folder and the streams
over it are run until they have taken it, so that it is one micro-batch of each, and every
cut is a restart from the checkpoint. The next cut follows.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tonearm.operators import presence, sliding
from tonearm.operators.lookup import Dims
from tonearm.plans import bridge, facts, warehouse
from tonearm.plans.stream_sql import CLOCK_START_MS, CLOCK_STEP_MS, CUTS, DIM_CUTS
from tonearm.session import prepare, work_dir
from tonearm.sources import changefeed, logs
from tonearm.sources.keyed import exists
from tonearm.sources.sinks import write_batch
from tonearm.streaming import arrivals, commits, corrected, handover, listeners
from tonearm.streaming.facts import refreshed
from tonearm.streaming.runner import finish, keyed_state, one_batch_a_run, packed_texts, run_stream
from tonearm.streaming.summary import Counts, emitted
from tonearm.streaming.versions import Versions

COLLECTS = Counts(["song_id"], "collect_count", sliding.DAY_BY_5S)
SEARCHES = Counts(["song_id"], "search_count", sliding.DAY_BY_5S)
FOLLOWS = Counts(["singer_id"], "follow_count", sliding.DAY_BY_5S)


def _lines(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Records of one type as texts, with the time of their arrival."""
    return bridge.log(spark, sf_dir, [kind]).selectExpr("to_json(struct(*)) AS value", "ts AS at")


def cut_bounds(lines: DataFrame, cuts: int) -> list[int]:
    """Equal steps between the first arrival and the last."""
    seen = lines.agg(F.min("at").alias("low"), F.max("at").alias("high")).first()
    if seen["low"] is None:
        return []
    return [seen["low"] + (seen["high"] - seen["low"]) * i // cuts for i in range(1, cuts)]


def late_bounds(lines: DataFrame) -> list[int]:
    """Half the cuts in the last two days, which bring only records that are two days late."""
    seen = lines.agg(F.min("at").alias("low"), F.max("at").alias("high")).first()
    if seen["low"] is None:
        return []
    low, day = seen["low"], bridge.DAY_MS
    on_time = max(low, seen["high"] - 2 * day)
    return [low + (on_time - low) // 3, low + (on_time - low) * 2 // 3, on_time, on_time + day // 4, on_time + day // 2]


def cuts_in_turn(lines: DataFrame, folder: str, bounds: list[int]) -> Iterator[int]:
    """Put one cut after the other into the folder."""
    ends = [None, *bounds, None]
    for i, (low, high) in enumerate(zip(ends, ends[1:])):
        part = lines
        if low is not None:
            part = part.where(F.col("at") >= low)
        if high is not None:
            part = part.where(F.col("at") < high)
        part.select("value").write.mode("append").text(folder)
        yield i


def _clean(spark: SparkSession, folder: str, spec: facts.FactSpec) -> DataFrame:
    return facts.clean_fact(logs.parse_log(logs.line_stream(spark, folder)), spec)


_runs: dict[tuple, str] = {}


def _collects(spark: SparkSession, sf_dir: str) -> str:
    """Corrected windows and the late table over the same batches; one run per session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _runs and exists(spark, f"{_runs[key]}/late"):
        return _runs[key]
    out = work_dir(prepare(spark), "corrected")
    lines = _lines(spark, sf_dir, "collect")
    for _ in cuts_in_turn(lines, f"{out}/in", late_bounds(lines)):
        rows = _clean(spark, f"{out}/in", facts.COLLECT)
        panes = corrected.changed_panes(rows, COLLECTS.keys, "c_ts", COLLECTS.win)
        with one_batch_a_run(spark):
            finish(run_stream(panes, corrected.corrected_sink(out, COLLECTS), f"{out}/checkpoint", mode="update"))
        finish(run_stream(rows, corrected.late_sink(out, "c_ts", COLLECTS.win), f"{out}/late-checkpoint"))
    _runs[key] = out
    return out


def stream_song_collect_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows as last emitted: late rows have changed those that they came in time for."""
    return sliding.describe(emitted(spark, _collects(spark, sf_dir), COLLECTS), COLLECTS.win)


def stream_song_collect_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that came too late for all their windows, and the batch they came in."""
    return spark.read.parquet(f"{_collects(spark, sf_dir)}/late").withColumn("batch_id", F.col("batch_id").cast("bigint"))


def _by_the_clock(spark: SparkSession, sf_dir: str, spec: facts.FactSpec, summary: Counts) -> DataFrame:
    out = work_dir(prepare(spark), "clock")
    lines = _lines(spark, sf_dir, spec.record)
    sink = arrivals.arrivals_sink(out, summary, lambda batch_id: CLOCK_START_MS + batch_id * CLOCK_STEP_MS)
    for _ in cuts_in_turn(lines, f"{out}/in", cut_bounds(lines, CUTS)):
        finish(run_stream(_clean(spark, f"{out}/in", spec), sink, f"{out}/checkpoint"))
    return sliding.describe(emitted(spark, out, summary), summary.win)


def stream_song_search_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Searches by the clock of their arrival, in windows that have ended."""
    return _by_the_clock(spark, sf_dir, facts.SEARCH, SEARCHES)


def stream_singer_follow_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Follows by the clock of their arrival, in windows that have ended."""
    return _by_the_clock(spark, sf_dir, facts.SINGER_FOLLOW, FOLLOWS)


def stream_collect_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the catalog shows of a table that a stream fills: the days that are over."""
    out = work_dir(prepare(spark), "days")
    lines = _lines(spark, sf_dir, "collect")
    table = "collect_days_" + out.rsplit("-", 1)[1]
    days = commits.DayCommits(table, f"{out}/table", "c_ts")
    for _ in bridge.cuts_in_turn(lines, f"{out}/in", bounds=cut_bounds(lines, CUTS)):
        rows = _clean(spark, f"{out}/in", facts.COLLECT)
        commits.create_day_table(rows, table, f"{out}/table")
        timed = rows.withColumn("event_ts", F.timestamp_millis("c_ts")).withWatermark("event_ts", "3 seconds")
        with packed_texts(spark):
            finish(days.watch(run_stream(timed, days.sink(), f"{out}/checkpoint")))
    return spark.table(table)


def stream_song_online_beats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every song's listeners on the first beat after all plays, from keyed state that was left
    and taken up again between the batches."""
    out = work_dir(prepare(spark), "beats")
    lines = _lines(spark, sf_dir, "play")

    def sink(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, f"{out}/beats", batch_id)

    for _ in cuts_in_turn(lines, f"{out}/in", cut_bounds(lines, 3)):
        plays = _clean(spark, f"{out}/in", facts.PLAY)
        with keyed_state(spark):
            query = run_stream(listeners.beats(presence.presence_changes(plays)), sink, f"{out}/checkpoint", every="1 second")
        try:
            _until_beat(spark, query, f"{out}/beats")
        finally:
            query.stop()
    beats = spark.read.parquet(f"{out}/beats")
    last = beats.where(F.col("beat_ms") == beats.agg(F.max("beat_ms")).first()[0]).select("song_id", "current_online_count")
    return warehouse.song_names(last, bridge.dims(spark, sf_dir), ["song_name", "singer_name"])


def _until_beat(spark: SparkSession, query: StreamingQuery, path: str, patience_s: int = 120) -> None:
    """Wait until a batch after the one with the new rows has shown a beat."""
    end = time.monotonic() + patience_s
    taken = None
    while time.monotonic() < end:
        if query.exception() is not None:
            raise query.exception()
        for p in query.recentProgress:
            if p["numInputRows"]:
                taken = p["batchId"]
        if taken is not None:
            done = [p["batchId"] for p in query.recentProgress if p["batchId"] > taken]
            later = [b for b in done if exists(spark, f"{path}/batch_id={b}/_SUCCESS")]
            if any(spark.read.parquet(f"{path}/batch_id={b}").limit(1).count() for b in later):
                return
        time.sleep(0.5)
    raise TimeoutError("no beat")


def stream_dim_user_handover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users from a full read at the feed's second step and the feed's changes after it; the feed
    begins before that."""
    out = work_dir(prepare(spark), "handover")
    users = bridge.users(spark, sf_dir).withColumn(
        "user_name", F.when(F.col("user_id") % 3 == 0, F.concat("user_name", F.lit("-v2"))).otherwise(F.col("user_name"))
    )
    since = 1_700_000_000_002
    users.write.parquet(f"{out}/snapshot")
    snapshot = spark.read.parquet(f"{out}/snapshot")
    table = handover.target(f"{out}/users", snapshot, "user_id")
    feed = bridge.change_lines(bridge.user_changes(spark, sf_dir))
    for _ in cuts_in_turn(feed, f"{out}/in", [since, since + 1, since + 2]):
        changes = changefeed.parse_changes(logs.line_stream(spark, f"{out}/in"), bridge.USER_COLUMNS)
        mine = changefeed.of_table(changes, "music", "ods_user")
        with keyed_state(spark):
            changed = handover.handover(snapshot, since, mine, "user_id")
            finish(run_stream(changed, table.upsert, f"{out}/checkpoint", mode="update"))
    return table.read(spark)


def _with_changing_dims(spark: SparkSession, sf_dir: str, seconds: float) -> DataFrame:
    """Searches while the province table changes before every batch, a minute apart."""
    out = work_dir(prepare(spark), "dims")
    base, provinces, minutes = bridge.dims(spark, sf_dir), Versions(f"{out}/province"), [0]

    def load() -> Dims:
        return Dims.of(base.user.table, base.song.table, base.singer.table, provinces.read(spark))

    now = refreshed(load, seconds, clock=lambda: 60.0 * minutes[0])

    def sink(batch: DataFrame, batch_id: int) -> None:
        write_batch(facts.build_fact(batch, facts.SEARCH, now()), f"{out}/rows", batch_id)

    lines = _lines(spark, sf_dir, "search")
    for i in cuts_in_turn(lines, f"{out}/in", cut_bounds(lines, DIM_CUTS)):
        minutes[0] = i
        named = base.province.table.withColumn("province_name", F.concat("province_name", F.lit(f" v{i}")))
        provinces.publish(named, i)
        log = logs.parse_log(logs.line_stream(spark, f"{out}/in"))
        finish(run_stream(log, sink, f"{out}/checkpoint"))
    return spark.read.parquet(f"{out}/rows").drop("batch_id")


def stream_search_dims_fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each batch sees the dimension as it then is."""
    return _with_changing_dims(spark, sf_dir, 0.0)


def stream_search_dims_held(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension is read again after two minutes; batches in between see the one held."""
    return _with_changing_dims(spark, sf_dir, 120.0)


ARRIVING_QUERIES = {
    fn.__name__: fn
    for fn in (
        stream_song_online_beats,
        stream_song_collect_corrected,
        stream_song_collect_late,
        stream_song_search_clock,
        stream_singer_follow_clock,
        stream_collect_days,
        stream_dim_user_handover,
        stream_search_dims_fresh,
        stream_search_dims_held,
    )
}
