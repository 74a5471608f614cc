"""Record schemas. Leaves that pass the quality rules are read as strings, because
a BIGINT leaf could not tell an uncastable value from a missing one."""

from __future__ import annotations

from pyspark.sql import types as T

# All fields any log record kind may carry inside `common`.
LOG_FIELDS = [
    "play_id", "search_id", "collect_id", "comment_id", "follow_id", "login_id", "register_id",
    "user_id", "song_id", "singer_id", "lead_song_id", "province_id", "channel", "content",
    "start_ts", "s_ts", "c_ts", "comment_date", "login_ts", "channel_ts",
]


def strings(fields: list[str]) -> T.StructType:
    return T.StructType([T.StructField(f, T.StringType()) for f in fields])


LOG_SCHEMA = T.StructType([
    T.StructField("common", strings(LOG_FIELDS)),
    T.StructField("channel", T.StringType()),
    T.StructField("mac_id", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("ts", T.LongType()),
])

# The generic raw layer keeps `common` as a map.
RAW_LOG_SCHEMA = T.StructType([
    T.StructField("common", T.MapType(T.StringType(), T.StringType())),
    T.StructField("channel", T.StringType()),
    T.StructField("mac_id", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("ts", T.LongType()),
])

def change_schema(row_fields: list[str] | None = None) -> T.StructType:
    """Change-feed envelope; without fields the row images stay string maps."""
    row = strings(row_fields) if row_fields else T.MapType(T.StringType(), T.StringType())
    return T.StructType([
        T.StructField("op", T.StringType()),
        T.StructField("before", row),
        T.StructField("after", row),
        T.StructField("source", T.StructType([
            T.StructField("db", T.StringType()),
            T.StructField("table", T.StringType()),
            T.StructField("pos", T.LongType()),
        ])),
        T.StructField("ts_ms", T.LongType()),
    ])


DIM_USER = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("user_name", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("vip_end", T.LongType()),
])
