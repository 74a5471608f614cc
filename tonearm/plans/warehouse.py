"""Summary tables: the operators put together over the cleaned facts.

Summaries read the clean fact without its dimension columns and look the names up
after counting, on far fewer rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonearm.operators import lookup as L
from tonearm.operators import presence, ranking, sliding, trade
from tonearm.operators.governance import dirty_windows, quality_panes
from tonearm.plans import facts


def song_online(play_log: DataFrame) -> DataFrame:
    plays = facts.clean_fact(play_log, facts.PLAY)
    return presence.online_listeners(presence.presence_changes(plays))


def song_names(df: DataFrame, dims: L.Dims, take: list[str]) -> DataFrame:
    return L.lookup(df, dims.song_with_singer(), "song_id", {c: c for c in take})


def song_online_named(play_log: DataFrame, dims: L.Dims) -> DataFrame:
    return song_names(song_online(play_log), dims, ["song_name", "singer_name"])


def song_online_top(play_log: DataFrame, dims: L.Dims, n: int = 10) -> DataFrame:
    best = ranking.top_n(song_online(play_log), "current_online_count", "song_id", n)
    take = {c: c for c in ["song_name", "singer_name"]}
    return L.lookup_few(best, dims.song_with_singer(), "song_id", take, limit=n)


def song_search_day(search_log: DataFrame, dims: L.Dims) -> DataFrame:
    clean = facts.clean_fact(search_log, facts.SEARCH)
    spans = sliding.sliding_count(
        clean, ["song_id"], F.col("s_ts"), sliding.DAY_BY_5S, "search_count"
    )
    out = sliding.describe(spans, sliding.DAY_BY_5S, date="partition_time")
    return L.lookup(
        out, dims.song_with_singer(), "song_id",
        {c: c for c in ["song_name", "singer_id", "singer_name"]},
    )


def song_collect_day(collect_log: DataFrame, dims: L.Dims) -> DataFrame:
    clean = facts.clean_fact(collect_log, facts.COLLECT)
    spans = sliding.sliding_count(
        clean, ["song_id"], F.col("c_ts"), sliding.DAY_BY_5S, "collect_count"
    )
    out = sliding.describe(spans, sliding.DAY_BY_5S)
    return L.add_song(out, dims)


def singer_follow_day(follow_log: DataFrame, dims: L.Dims) -> DataFrame:
    clean = facts.clean_fact(follow_log, facts.SINGER_FOLLOW)
    spans = sliding.sliding_count(
        clean, ["singer_id"], F.col("c_ts"), sliding.DAY_BY_5S, "follow_count"
    )
    out = sliding.describe(spans, sliding.DAY_BY_5S)
    return L.add_singer(out, dims)


def province_active_hour(login_log: DataFrame, dims: L.Dims) -> DataFrame:
    clean = facts.clean_fact(login_log, facts.LOGIN)
    spans = sliding.sliding_distinct(
        clean, ["province_id"], "user_id", F.col("login_ts"), sliding.HOUR_BY_5S,
        "active_user_count",
    )
    out = sliding.describe(spans, sliding.HOUR_BY_5S)
    return L.add_province(out, dims)


def dirty_hour(log: DataFrame) -> DataFrame:
    return dirty_windows(quality_panes(facts.tag_log(log)))


def album_sales(album_changes: DataFrame) -> DataFrame:
    return trade.album_sales(facts.clean_fact(album_changes, facts.ALBUM))


def vip_renewal_rate(vip_changes: DataFrame, dims: L.Dims) -> DataFrame:
    return trade.renewal_rate(facts.build_fact(vip_changes, facts.VIP, dims))


def vip_renewal_rate_literal(vip_changes: DataFrame, dims: L.Dims) -> DataFrame:
    return trade.renewal_rate_literal(facts.build_fact(vip_changes, facts.VIP, dims))
