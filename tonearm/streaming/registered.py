"""The stream forms as registered queries. Each writes its table as texts in three cuts, as
a topic would hold them, reads these as a stream, one cut a micro-batch whatever its number of
files, and returns what the stream stored."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import nullcontext

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tonearm.operators import lookup as L
from tonearm.operators import sliding
from tonearm.plans import bridge, facts, warehouse
from tonearm.schemas import DIM_USER
from tonearm.session import prepare, work_dir
from tonearm.sources import changefeed, logs, sinks
from tonearm.sources.keyed import exists
from tonearm.streaming import dims as dim_stream
from tonearm.streaming import facts as fact_stream
from tonearm.streaming import governance, presence
from tonearm.streaming import sliding as sliding_stream
from tonearm.streaming import summary as summary_stream
from tonearm.streaming.runner import finish, one_batch_a_run, packed_texts, run_stream, run_to_files


Start = Callable[[DataFrame], StreamingQuery]


def _in_turn(
    lines: DataFrame, out: str, start: Start, bounds: list[int] | None = None, keep: bool = True
) -> None:
    """The stream that `start` makes of texts (value, at), in the order of `at`: it is taken up
    again for every cut and ends when it has taken that. Unless they are kept, a cut's texts go
    before the next is written."""
    spark = lines.sparkSession
    for _ in bridge.cuts_in_turn(lines, f"{out}/in", bounds=bounds, keep=keep):
        with packed_texts(spark):
            finish(start(logs.line_stream(spark, f"{out}/in")))


def _log(spark: SparkSession, sf_dir: str, spec: facts.FactSpec, ts: str, out: str, start: Start) -> None:
    """A stream of the clean records of one fact, in the order of a field."""
    records = bridge.log(spark, sf_dir, [spec.record])
    lines = records.selectExpr("to_json(struct(*)) AS value", f"bigint(common.{ts}) AS at")
    _in_turn(lines, out, lambda texts: start(facts.clean_fact(logs.parse_log(texts), spec)))


class Lost(Exception):
    """Stands for a driver that is lost in the middle of a batch."""


_fan_outs: dict[tuple[str, str], str] = {}


def _log_facts(spark: SparkSession, sf_dir: str) -> str:
    """All facts, the dirty and the dropped lines of the log; the folder they are in.

    The stream is lost once, with some outputs of its second batch written and some not, and
    started again from its checkpoint. One run per session and folder serves all queries."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _fan_outs and exists(spark, f"{_fan_outs[key]}/checkpoint"):
        return _fan_outs[key]
    out = work_dir(prepare(spark), "facts")
    load = fact_stream.refreshed(lambda: bridge.dims(spark, sf_dir))
    lost: list[int] = []

    def written(output: str, batch_id: int) -> None:
        if batch_id == 1 and output == facts.COMMENT.name and not lost:
            lost.append(batch_id)
            raise Lost(output)

    def run() -> None:
        log = logs.parse_log(logs.line_stream(spark, f"{out}/in"))
        with packed_texts(spark):
            finish(run_stream(log, fact_stream.log_sink(load, out, written), f"{out}/checkpoint"))

    for _ in bridge.cuts_in_turn(bridge.timed_log_lines(spark, sf_dir), f"{out}/in"):
        known = len(lost)
        try:
            run()
        except StreamingQueryException:
            if len(lost) == known:
                raise
            run()
    _fan_outs[key] = out
    return out


def stream_dwd_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of all seven facts and of the dirty table, in common columns."""
    out = _log_facts(spark, sf_dir)
    none = F.lit(None).cast("string")
    rows = spark.read.parquet(f"{out}/dirty").select(
        F.concat(F.lit("dirty "), "fact").alias("output"), F.lit(None).cast("bigint").alias("id"),
        F.lit(None).cast("bigint").alias("user_id"), none.alias("user_name"), "dirty_type", "record",
    )
    for spec in facts.LOG_FACTS:
        good = spark.read.parquet(f"{out}/{spec.name}")
        rows = rows.unionByName(good.select(
            F.lit(spec.name).alias("output"), F.col(spec.id).alias("id"), "user_id", "user_name",
            none.alias("dirty_type"), none.alias("record"),
        ))
    return rows


def stream_dwd_play(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{_log_facts(spark, sf_dir)}/dwd_play").drop("batch_id")


def stream_dwd_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{_log_facts(spark, sf_dir)}/dwd_search").drop("batch_id")


def _fact(spark: SparkSession, sf_dir: str, spec: facts.FactSpec) -> DataFrame:
    return spark.read.parquet(f"{_log_facts(spark, sf_dir)}/{spec.name}").drop("batch_id")


def stream_dwd_collect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact(spark, sf_dir, facts.COLLECT)


def stream_dwd_comment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact(spark, sf_dir, facts.COMMENT)


def stream_dwd_singer_follow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact(spark, sf_dir, facts.SINGER_FOLLOW)


def stream_dwd_login(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact(spark, sf_dir, facts.LOGIN)


def stream_dwd_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact(spark, sf_dir, facts.REGISTER)


def stream_dwd_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = spark.read.parquet(f"{_log_facts(spark, sf_dir)}/dirty")
    return dirty.select("fact", "dirty_type", "record", "ts")


def _trade(spark: SparkSession, sf_dir: str, feed: DataFrame, spec: facts.FactSpec) -> DataFrame:
    out = work_dir(prepare(spark), "trade")
    sink = fact_stream.trade_sink(lambda: bridge.dims(spark, sf_dir), out, spec, "month")

    def start(texts: DataFrame) -> StreamingQuery:
        return run_stream(changefeed.parse_changes(texts, list(spec.columns)), sink, f"{out}/checkpoint")

    _in_turn(bridge.change_lines(feed), out, start, keep=False)
    return spark.read.parquet(f"{out}/{spec.name}").drop("batch_id", "month")


def stream_dwd_trade_vip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trade(spark, sf_dir, bridge.vip_orders(spark, sf_dir), facts.VIP)


def stream_dwd_trade_album(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trade(spark, sf_dir, bridge.album_orders(spark, sf_dir), facts.ALBUM)


def stream_dwd_trade_cancel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trade(spark, sf_dir, bridge.cancelled_orders(spark, sf_dir), facts.CANCEL)


def stream_song_online(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The figures that the last micro-batch showed."""
    out = work_dir(prepare(spark), "online")
    sink = presence.presence_sink(out)
    _log(spark, sf_dir, facts.PLAY, "start_ts", out, lambda clean: run_stream(clean, sink, f"{out}/checkpoint"))
    shown = spark.read.parquet(f"{out}/online")
    shown = shown.where(F.col("batch_id") == shown.agg(F.max("batch_id")).first()[0]).drop("batch_id")
    return presence.online_report(shown, bridge.dims(spark, sf_dir)).drop("partition_time")


def stream_song_collect_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = work_dir(prepare(spark), "collect")
    sink = sliding_stream.count_sink(out, ["song_id"], "c_ts", sliding.DAY_BY_5S)
    _log(spark, sf_dir, facts.COLLECT, "c_ts", out, lambda clean: run_stream(clean, sink, f"{out}/checkpoint"))
    spans = sliding_stream.stored_counts(
        spark, out, ["song_id"], sliding.DAY_BY_5S, "collect_count"
    )
    named = sliding.describe(spans, sliding.DAY_BY_5S)
    return L.add_song(named, bridge.dims(spark, sf_dir))


def stream_song_collect_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one window that a dashboard shows at 2024-01-16 00:00:03, from what is stored."""
    out = work_dir(prepare(spark), "collect")
    sink = sliding_stream.count_sink(out, ["song_id"], "c_ts", sliding.DAY_BY_5S)
    _log(spark, sf_dir, facts.COLLECT, "c_ts", out, lambda clean: run_stream(clean, sink, f"{out}/checkpoint"))
    return sliding_stream.current_counts(
        spark, out, ["song_id"], sliding.DAY_BY_5S, "collect_count", 1_705_363_203_000
    )


def stream_song_search_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Searches by the clock of their arrival: all of this run are still in the state."""
    out = work_dir(prepare(spark), "arrivals")
    counts = summary_stream.Counts(["song_id"], "search_count", sliding.DAY_BY_5S)
    sink = summary_stream.summary_sink(out, counts, "arrival")

    def start(clean: DataFrame) -> StreamingQuery:
        return run_stream(sliding_stream.arrival_clock(clean, "arrival"), sink, f"{out}/checkpoint")

    _log(spark, sf_dir, facts.SEARCH, "s_ts", out, start)
    state = summary_stream.current_state(spark, out)
    return state.groupBy("song_id").agg(F.sum("n").alias("search_count"))


def stream_dwd_trade_cancel_olap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cancelled orders into an OLAP store, here in a format that Spark ships."""
    out = work_dir(prepare(spark), "olap")
    sink = sinks.olap_sink("orc", f"{out}/olap")

    def start(texts: DataFrame) -> StreamingQuery:
        changes = changefeed.parse_changes(texts, list(facts.CANCEL.columns))
        return run_stream(facts.clean_fact(changes, facts.CANCEL), sink, f"{out}/checkpoint")

    _in_turn(bridge.change_lines(bridge.cancelled_orders(spark, sf_dir)), out, start)
    return spark.read.orc(f"{out}/olap").drop("batch_id")


def stream_province_active_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = work_dir(prepare(spark), "active")
    sink = sliding_stream.distinct_sink(
        out, ["province_id"], "user_id", "login_ts", sliding.HOUR_BY_5S
    )
    _log(spark, sf_dir, facts.LOGIN, "login_ts", out, lambda clean: run_stream(clean, sink, f"{out}/checkpoint"))
    spans = sliding_stream.stored_distinct(
        spark, out, ["province_id"], "user_id", sliding.HOUR_BY_5S, "active_user_count"
    )
    named = sliding.describe(spans, sliding.HOUR_BY_5S)
    return L.add_province(named, bridge.dims(spark, sf_dir))


def _summary(spark: SparkSession, sf_dir: str, spec: facts.FactSpec, ts: str, summary) -> DataFrame:
    """The windows that a summary stream has emitted, described."""
    out = work_dir(prepare(spark), "summary")
    sink = summary_stream.summary_sink(out, summary, ts)
    _log(spark, sf_dir, spec, ts, out, lambda clean: run_stream(clean, sink, f"{out}/checkpoint"))
    return sliding.describe(summary_stream.emitted(spark, out, summary), summary.win)


def stream_song_search_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = summary_stream.Counts(["song_id"], "search_count", sliding.DAY_BY_5S)
    return _summary(spark, sf_dir, facts.SEARCH, "s_ts", counts)


def stream_song_collect_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = summary_stream.Counts(["song_id"], "collect_count", sliding.DAY_BY_5S)
    return _summary(spark, sf_dir, facts.COLLECT, "c_ts", counts)


def stream_singer_follow_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = summary_stream.Counts(["singer_id"], "follow_count", sliding.DAY_BY_5S)
    return _summary(spark, sf_dir, facts.SINGER_FOLLOW, "c_ts", counts)


def stream_province_active_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = summary_stream.Distinct(["province_id"], "user_id", "active_user_count", sliding.HOUR_BY_5S)
    return _summary(spark, sf_dir, facts.LOGIN, "login_ts", members)


def stream_dirty_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of the sliding hour that the watermark has closed."""
    out = work_dir(prepare(spark), "dirty")
    lines = bridge.log(spark, sf_dir).selectExpr("to_json(struct(*)) AS value", "ts AS at")
    for last in bridge.cuts_in_turn(lines, f"{out}/in"):
        windows = governance.dirty_windows(logs.parse_log(logs.line_stream(spark, f"{out}/in")))
        # The batch without rows, which closes windows, comes after the last cut alone.
        with packed_texts(spark), nullcontext() if last else one_batch_a_run(spark):
            finish(run_to_files(windows, f"{out}/windows", f"{out}/checkpoint"))
    return spark.read.parquet(f"{out}/windows")


def _dim_user(spark: SparkSession, sf_dir: str, configs) -> DataFrame:
    """The user table after its feed; `configs(n)` is the config's feed as batch n finds it."""
    out = work_dir(prepare(spark), "dim")
    feed = bridge.change_lines(bridge.user_changes(spark, sf_dir))
    batches = iter(range(1_000))
    sink = dim_stream.dim_sink(out, {"dim_user": DIM_USER}, lambda: configs(next(batches)))

    def start(texts: DataFrame) -> StreamingQuery:
        return run_stream(changefeed.parse_changes(texts, bridge.USER_COLUMNS), sink, f"{out}/checkpoint")

    _in_turn(feed, out, start, bounds=[1_700_000_000_002, 1_700_000_000_003])
    return dim_stream.DimTable(out, "dim_user", DIM_USER, "user_id").current(spark)


def stream_dim_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dim_user(spark, sf_dir, lambda _: bridge.user_config_changes(spark, sf_dir))


def stream_dim_user_reconfigured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Before the second batch the config is changed: the table starts anew, and only the
    name is written from then on."""
    return _dim_user(
        spark, sf_dir, lambda batch: bridge.user_config_changes(spark, sf_dir, changed=batch >= 1)
    )


STREAM_QUERIES = {
    fn.__name__: fn
    for fn in (
        stream_dwd_facts,
        stream_dwd_play,
        stream_dwd_search,
        stream_dwd_collect,
        stream_dwd_comment,
        stream_dwd_singer_follow,
        stream_dwd_login,
        stream_dwd_register,
        stream_dwd_dirty,
        stream_dwd_trade_vip,
        stream_dwd_trade_album,
        stream_dwd_trade_cancel,
        stream_song_online,
        stream_song_collect_24h,
        stream_song_collect_at,
        stream_song_search_arrivals,
        stream_dwd_trade_cancel_olap,
        stream_province_active_1h,
        stream_song_search_windows,
        stream_song_collect_windows,
        stream_singer_follow_windows,
        stream_province_active_windows,
        stream_dirty_1h,
        stream_dim_user,
        stream_dim_user_reconfigured,
    )
}
