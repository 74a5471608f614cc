"""Every query by name, over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonearm.functions import timefmt
from tonearm.functions.naming import to_message
from tonearm.operators import changes, dims, lateness, presence, sliding
from tonearm.plans import bridge, facts, warehouse
from tonearm.schemas import DIM_USER
from tonearm.session import prepare, work_dir
from tonearm.sources import changefeed, logs, sinks

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


@query
def ads_song_online_top10(spark, sf_dir):
    return warehouse.song_online_top(bridge.log(spark, sf_dir, ["play"]), bridge.dims(spark, sf_dir))


@query
def dws_song_online(spark, sf_dir):
    return warehouse.song_online_named(
        bridge.log(spark, sf_dir, ["play"]), bridge.dims(spark, sf_dir)
    )


@query
def dws_presence_changes(spark, sf_dir):
    plays = facts.clean_fact(bridge.log(spark, sf_dir, ["play"]), facts.PLAY)
    return presence.presence_changes(plays)


def _log_fact(spec: facts.FactSpec) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        log = bridge.log(spark, sf_dir, [spec.record])
        return facts.build_fact(log, spec, bridge.dims(spark, sf_dir))

    run.__name__ = spec.name
    return run


for _spec in facts.LOG_FACTS:
    query(_log_fact(_spec))


def _log_fact_of_lines(spec: facts.FactSpec) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        log = facts.of_lines(bridge.log_lines(spark, sf_dir), spec)
        return facts.build_fact(log, spec, bridge.dims(spark, sf_dir))

    run.__name__ = f"{spec.name}_of_lines"
    return run


for _spec in facts.LOG_FACTS:
    query(_log_fact_of_lines(_spec))


@query
def dwd_dirty_records(spark, sf_dir):
    """Every dirty record with the text it came as."""
    return facts.dirty_log_records(logs.parse_log(bridge.log_lines(spark, sf_dir)))


@query
def dwd_trade_vip(spark, sf_dir):
    return facts.build_fact(
        bridge.vip_orders(spark, sf_dir), facts.VIP, bridge.dims(spark, sf_dir)
    )


@query
def dwd_trade_album(spark, sf_dir):
    return facts.build_fact(
        bridge.album_orders(spark, sf_dir), facts.ALBUM, bridge.dims(spark, sf_dir)
    )


@query
def dwd_trade_cancel(spark, sf_dir):
    return facts.build_fact(
        bridge.cancelled_orders(spark, sf_dir), facts.CANCEL, bridge.dims(spark, sf_dir)
    )


@query
def dwd_trade_dirty(spark, sf_dir):
    parts = [
        facts.dirty_trade_records(feed(spark, sf_dir), spec)
        for feed, spec in (
            (bridge.vip_orders, facts.VIP),
            (bridge.album_orders, facts.ALBUM),
            (bridge.cancelled_orders, facts.CANCEL),
        )
    ]
    both = parts[0].unionByName(parts[1]).unionByName(parts[2])
    field = lambda name: F.get_json_object("record", f"$.{name}")
    return both.select(
        "fact", field("order_id").cast("bigint").alias("order_id"), "dirty_type", "ts",
        field("user_id").alias("user_id"), field("amount").alias("amount"),
        field("status_type_id").alias("status_type_id"), F.length("record").alias("text_length"),
    )


@query
def dws_album_sales(spark, sf_dir):
    return warehouse.album_sales(bridge.album_orders(spark, sf_dir))


@query
def dws_album_sales_message(spark, sf_dir):
    sales = warehouse.album_sales(bridge.album_orders(spark, sf_dir))
    return to_message(sales.select(
        F.col("album_id").alias("albumId"), "sales", "amount", "dt",
        F.lit(1).alias("updateTime"),
    ), internal=("updateTime",))


@query
def dws_vip_renewal_rate(spark, sf_dir):
    return warehouse.vip_renewal_rate(
        bridge.vip_orders(spark, sf_dir), bridge.dims(spark, sf_dir)
    )


@query
def dws_vip_renewal_rate_literal(spark, sf_dir):
    return warehouse.vip_renewal_rate_literal(
        bridge.vip_orders(spark, sf_dir), bridge.dims(spark, sf_dir)
    )


@query
def dws_song_search_24h(spark, sf_dir):
    return warehouse.song_search_day(
        bridge.log(spark, sf_dir, ["search"]), bridge.dims(spark, sf_dir)
    )


@query
def dws_song_collect_24h(spark, sf_dir):
    return warehouse.song_collect_day(
        bridge.log(spark, sf_dir, ["collect"]), bridge.dims(spark, sf_dir)
    )


@query
def dws_song_collect_at(spark, sf_dir):
    """The window that ends at 2024-01-16 00:00:00."""
    clean = facts.clean_fact(bridge.log(spark, sf_dir, ["collect"]), facts.COLLECT)
    return sliding.window_at(
        clean, ["song_id"], F.col("c_ts"), sliding.DAY_BY_5S, 1_705_363_203_000, "collect_count"
    )


@query
def dws_singer_follow_24h(spark, sf_dir):
    return warehouse.singer_follow_day(
        bridge.log(spark, sf_dir, ["singer_follow"]), bridge.dims(spark, sf_dir)
    )


@query
def dws_province_active_1h(spark, sf_dir):
    return warehouse.province_active_hour(
        bridge.log(spark, sf_dir, ["login"]), bridge.dims(spark, sf_dir)
    )


@query
def dws_dirty_1h(spark, sf_dir):
    return warehouse.dirty_hour(bridge.log(spark, sf_dir))


@query
def late_split(spark, sf_dir):
    """Which collects would be too late once all before 2024-01-20 are in."""
    spec = facts.COLLECT
    clean = facts.clean_fact(bridge.log(spark, sf_dir, [spec.record]), spec)
    high = F.lit(1_705_708_800_000).cast("bigint")
    return clean.select(
        "collect_id", "song_id", "c_ts",
        lateness.is_late(F.col("c_ts"), high, sliding.DAY_BY_5S).alias("is_late"),
    )


@query
def dim_changes_routed(spark, sf_dir):
    routed = changes.route(bridge.user_changes(spark, sf_dir), bridge.user_config(spark, sf_dir))
    image = changes.row_image()
    return routed.select(
        "sink_table",
        changes.row_key(F.col("sink_row_key"), image.getField("user_id")).alias("row_key"),
        "op",
        F.col("source.pos").alias("pos"),
        image.getField("user_name").alias("user_name"),
    )


@query
def ods_changes_parsed(spark, sf_dir):
    """The change feed as texts, parsed with map images, all tables of the database."""
    feed = bridge.user_changes(spark, sf_dir)
    lines = feed.selectExpr("to_json(struct(*)) AS value")
    parsed = changefeed.of_table(changefeed.parse_changes(lines), "music")
    mine = changefeed.row_images_as(parsed, bridge.USER_COLUMNS)
    image = changes.row_image()
    return mine.select(
        "op", "ts_ms", F.col("source.table").alias("source_table"),
        F.col("source.pos").alias("pos"),
        image.getField("user_id").cast("bigint").alias("user_id"),
        image.getField("user_name").alias("user_name"),
    )


@query
def dwd_trade_cancel_stored(spark, sf_dir):
    """The fact written into partitions, twice over, and read back."""
    fact = facts.build_fact(
        bridge.cancelled_orders(spark, sf_dir), facts.CANCEL, bridge.dims(spark, sf_dir)
    ).withColumn("month", F.substring("dt", 1, 6))
    path = work_dir(spark, "cancel")
    sinks.write_partitions(fact, path, "month")
    sinks.write_partitions(fact, path, "month")
    stored = spark.read.parquet(path)
    return stored.withColumn("month", F.col("month").cast("string"))


@query
def dwd_trade_cancel_months(spark, sf_dir):
    """Three years of the stored fact, of which only their partitions are read."""
    fact = facts.build_fact(
        bridge.cancelled_orders(spark, sf_dir), facts.CANCEL, bridge.dims(spark, sf_dir)
    ).withColumn("month", F.substring("dt", 1, 6))
    path = work_dir(spark, "cancel")
    sinks.write_partitions(fact, path, "month")
    months = [f"{year}{month:02d}" for year in (1996, 1997, 1998) for month in range(1, 13)]
    stored = sinks.read_days(spark, path, months, "month")
    return stored.withColumn("month", F.col("month").cast("string"))


@query
def dws_album_sales_exported(spark, sf_dir):
    """Daily sales into a catalog table (created, inserted twice), then exported twice to
    another format and read from there."""
    sales = warehouse.album_sales(bridge.album_orders(spark, sf_dir))
    sales = sales.withColumn("month", F.substring("dt", 1, 6))
    place = work_dir(spark, "album_sales")
    name = "album_sales_" + place.rsplit("-", 1)[1]
    for _ in range(2):
        sinks.insert_partitions(sales, name, "month", f"{place}/table")
    for _ in range(2):
        sinks.export_columns(spark, name, ["album_id", "sales", "amount", "dt"], "orc", f"{place}/export")
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(sales.drop("month").schema).orc(f"{place}/export")


@query
def dim_user_current(spark, sf_dir):
    routed = changes.route(bridge.user_changes(spark, sf_dir), bridge.user_config(spark, sf_dir))
    return dims.current_rows(routed, DIM_USER, "user_id")


@query
def dim_user_merged(spark, sf_dir):
    """The same table in two steps: the snapshot, then the later changes merged in."""
    routed = changes.route(bridge.user_changes(spark, sf_dir), bridge.user_config(spark, sf_dir))
    snapshot = dims.current_rows(routed.where("op = 'r'"), DIM_USER, "user_id")
    effect = dims.net_effect(routed.where("op <> 'r'"), DIM_USER, "user_id")
    return dims.merge(snapshot, effect, DIM_USER, "user_id")


@query
def dim_user_of_snapshot(spark, sf_dir):
    """The same table from a read of the source table, and the change feed from then on."""
    rows = bridge.users(spark, sf_dir)
    feed = bridge.user_changes(spark, sf_dir).where("op <> 'r'")
    whole = changefeed.snapshot_then_changes(rows, feed, "music", "ods_user")
    routed = changes.route(whole, bridge.user_config(spark, sf_dir))
    return dims.current_rows(routed, DIM_USER, "user_id")


@query
def dim_config_current(spark, sf_dir):
    return changes.current_config(bridge.config_changes(spark, sf_dir))


@query
def dim_config_lifecycle(spark, sf_dir):
    return changes.lifecycle(bridge.config_changes(spark, sf_dir))


@query
def ods_log_parsed(spark, sf_dir):
    records = logs.typed_log(logs.parse_log(bridge.log_lines(spark, sf_dir)))
    return records.select(
        "type", "channel", "mac_id", "ts",
        F.col("common.user_id").alias("user_id"), F.col("common.song_id").alias("song_id"),
    )


@query
def ods_log_dropped(spark, sf_dir):
    return facts.dropped(logs.parse_log(bridge.log_lines(spark, sf_dir)))


@query
def ods_log_raw_fields(spark, sf_dir):
    """Which fields each record type carries, from the generic raw layer."""
    raw = logs.parse_raw_log(bridge.log_lines(spark, sf_dir))
    fields = raw.select("type", F.explode(F.map_keys("common")).alias("field"))
    return fields.groupBy("type", "field").agg(F.count("*").alias("records"))


@query
def scalar_time_formats(spark, sf_dir):
    at = F.unix_millis(F.col("ts").cast("timestamp"))
    moment, day = timefmt.ms_to_date_time(at), timefmt.ms_to_date(at)
    return bridge.table(spark, sf_dir, "events").select(
        "event_id",
        day.alias("day"),
        moment.alias("moment"),
        timefmt.ms_to_partition_date(at).alias("partition_day"),
        timefmt.date_time_to_ms(moment).alias("moment_ms"),
        timefmt.date_to_ms(day).alias("day_ms"),
        timefmt.align_ms(at, 5000).alias("next_tick_ms"),
        F.call_function("div", at, F.lit(1000)).alias("seconds"),
        changes.row_key(F.lit("event_id"), F.col("event_id")).alias("row_key"),
    )
