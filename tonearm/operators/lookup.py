"""Fact-to-dimension lookups: left joins that keep every fact row.

A dimension is broadcast only when its rows, as a hash table in memory, are below the
session's broadcast threshold: a compressed file may be a fraction of that. A larger one
is joined by shuffle, each of its rows once: adaptive execution splits the fact rows of a
hot key, as it may in a left join.
Rows that can match nothing (a null key) are dealt out by what tells them apart, so a
third of all rows without a previous song is no hot key either.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonearm.session import work_dir

Spread = list[str] | None
FEW_KEYS = 1_000  # the most rows a report may have to be looked up by its keys
UNKNOWN = 1 << 62  # a size that is never broadcast


def broadcast_limit(df: DataFrame) -> int:
    """The session's threshold in bytes, read as Spark reads it; negative is never."""
    return int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def planned_bytes(df: DataFrame) -> int | None:
    """The optimizer's size of a plan; for files, what they take on disk."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # a session without a local JVM: unknown, so never broadcast
        return None


def held_bytes(df: DataFrame) -> int | None:
    """What a broadcast of the table holds: its rows as Spark lays them out, in pages that
    grow by doubling. They are added up only if the optimizer's figure is below the
    threshold, so for small files."""
    planned = planned_bytes(df)
    if planned is None or planned > broadcast_limit(df):
        return planned
    texts = [f.name for f in df.schema.fields if f.dataType == T.StringType()]
    row = F.lit(8 + 8 * len(df.columns)).cast("bigint")
    for c in texts:
        row = row + F.coalesce(F.octet_length(f"`{c}`"), F.lit(0)) + 7
    rows = df.agg(F.sum(row)).first()[0] or 0
    return max(planned, 2 * rows)


class Dimension:
    """A dimension table and the size it is checked by. The size is what its rows take in
    memory, or a given bound (after a join)."""

    def __init__(
        self, table: DataFrame, key: str, bytes: int | None = None, few: bool = False
    ) -> None:
        self.table, self.key, self._bytes = table, key, bytes
        self._few = few  # cut to a handful of keys, whatever the threshold

    @property
    def bytes(self) -> int | None:
        if self._bytes is None:
            self._bytes = held_bytes(self.table)
        return self._bytes

    @property
    def small(self) -> bool:
        if self._few:
            return True
        return self.bytes is not None and self.bytes <= broadcast_limit(self.table)


def lookup(
    fact: DataFrame,
    dim: Dimension,
    fact_key: str,
    take: dict[str, str],
    spread_by: Spread = None,
    empty: str | None = None,
) -> DataFrame:
    """Add dimension columns `take = {dimension column: new name}` to the fact.

    Misses give null, or `empty` when it is set. `spread_by` names the fact columns
    that tell rows without a key apart. A new name that the fact already has replaces it.
    """
    kept = [f"f.`{c}`" for c in fact.columns if c not in take.values()]
    d = dim.table.select(dim.key, *[c for c in take if c != dim.key])
    if empty is None:
        added = [f"d.`{c}` AS `{name}`" for c, name in take.items()]
    else:
        added = [f"coalesce(string(d.`{c}`), '{empty}') AS `{name}`" for c, name in take.items()]
    matches = f"f.`{fact_key}` = d.`{dim.key}`"
    if dim.small:
        joined = fact.alias("f").join(F.broadcast(d).alias("d"), F.expr(matches), "left")
    elif not spread_by:
        joined = fact.alias("f").join(d.hint("merge").alias("d"), F.expr(matches), "left")
    else:
        ids = ", ".join(f"`{c}`" for c in spread_by)
        dealt = fact.selectExpr("*", f"coalesce(bigint(`{fact_key}`), xxhash64({ids})) AS _deal")
        found = F.expr(f"f._deal = d.`{dim.key}` AND f.`{fact_key}` IS NOT NULL")
        joined = dealt.alias("f").join(d.hint("merge").alias("d"), found, "left")
    return joined.selectExpr(*kept, *added)


def lookup_few(
    rows: DataFrame, dim: Dimension, key: str, take: dict[str, str], limit: int
) -> DataFrame:
    """The lookup for a report of at most `limit` rows (a top ten). A large dimension is
    cut to the keys of the report, by broadcasting those, and never shuffled. The report
    then occurs twice in the plan; Spark runs its shuffles once and reuses them. Beyond
    FEW_KEYS rows it is a lookup as any other."""
    if dim.small or limit > FEW_KEYS:
        return lookup(rows, dim, key, take)
    keys = F.broadcast(rows.select(F.col(key).alias(dim.key)).limit(limit))
    found = dim.table.join(keys, dim.key, "left_semi")
    return lookup(rows, Dimension(found, dim.key, few=True), key, take)


@dataclass
class Dims:
    """The four dimensions of the warehouse.

    Songs and singers are joined to each other once, before any fact is touched, so
    that a fact needs one lookup for both instead of two. If the join is too large to
    broadcast, it is written to the shared folder and every lookup reads that.
    """

    user: Dimension
    song: Dimension
    singer: Dimension
    province: Dimension
    _wide: Dimension | None = None

    @classmethod
    def of(cls, user: DataFrame, song: DataFrame, singer: DataFrame, province: DataFrame) -> Dims:
        return cls(
            Dimension(user, "user_id"),
            Dimension(song, "song_id"),
            Dimension(singer, "singer_id"),
            Dimension(province, "province_id"),
        )

    def song_with_singer(self) -> Dimension:
        if self._wide is None:
            self._wide = self._join_singers()
        return self._wide

    def _join_singers(self) -> Dimension:
        wide = lookup(
            self.song.table.withColumnRenamed("song_type_id", "song_type"),
            self.singer,
            "singer_id",
            {
                "singer_name": "singer_name",
                "gender": "singer_gender",
                "nationality": "singer_nationality",
            },
            spread_by=["song_id"],  # songs without a singer
        )
        # Three text columns are added to five, one singer per song at most: below
        # twice the size of the songs, plus the singers once.
        sizes = self.song.bytes, self.singer.bytes
        bound = UNKNOWN if None in sizes else 2 * sizes[0] + sizes[1]
        if bound <= broadcast_limit(wide):
            return Dimension(wide, "song_id", bytes=bound)
        path = work_dir(wide.sparkSession, "songs")
        wide.write.parquet(path)
        stored = wide.sparkSession.read.schema(wide.schema).parquet(path)
        return Dimension(stored, "song_id", bytes=bound)


SONG_COLUMNS = ["song_name", "singer_id", "song_type", "song_duration"]
SINGER_COLUMNS = ["singer_name", "singer_gender", "singer_nationality"]


def add_user(fact: DataFrame, dims: Dims, spread_by: Spread = None) -> DataFrame:
    return lookup(
        fact, dims.user, "user_id", {"user_name": "user_name", "gender": "user_gender"}, spread_by
    )


def add_vip_user(fact: DataFrame, dims: Dims, spread_by: Spread = None) -> DataFrame:
    """User columns plus the end of the membership in seconds, 0 when there is none."""
    out = lookup(
        fact,
        dims.user,
        "user_id",
        {"user_name": "user_name", "gender": "user_gender", "vip_end": "vip_end"},
        spread_by,
    )
    return out.withColumn(
        "vip_end", F.coalesce(F.call_function("div", F.col("vip_end"), F.lit(1000)), F.lit(0))
    )


def add_song(fact: DataFrame, dims: Dims, spread_by: Spread = None) -> DataFrame:
    """Song columns only."""
    songs = Dimension(
        dims.song.table.withColumnRenamed("song_type_id", "song_type"),
        "song_id",
        bytes=dims.song.bytes,
    )
    return lookup(fact, songs, "song_id", {c: c for c in SONG_COLUMNS}, spread_by)


def add_song_and_singer(fact: DataFrame, dims: Dims, spread_by: Spread = None) -> DataFrame:
    take = {c: c for c in SONG_COLUMNS + SINGER_COLUMNS}
    return lookup(fact, dims.song_with_singer(), "song_id", take, spread_by)


def add_lead_song_and_singer(fact: DataFrame, dims: Dims, spread_by: Spread = None) -> DataFrame:
    """The previous song and its singer; empty texts when there is none."""
    take = {
        "song_name": "lead_song_name",
        "singer_id": "lead_singer_id",
        "song_type": "lead_song_type",
        "song_duration": "lead_song_duration",
        "singer_name": "lead_singer_name",
        "singer_gender": "lead_singer_gender",
        "singer_nationality": "lead_singer_nationality",
    }
    return lookup(
        fact, dims.song_with_singer(), "lead_song_id", take, spread_by, empty=""
    )


def add_singer(fact: DataFrame, dims: Dims, spread_by: Spread = None) -> DataFrame:
    take = {
        "singer_name": "singer_name",
        "gender": "singer_gender",
        "nationality": "singer_nationality",
    }
    return lookup(fact, dims.singer, "singer_id", take, spread_by)


def add_province(fact: DataFrame, dims: Dims, spread_by: Spread = None) -> DataFrame:
    return lookup(
        fact, dims.province, "province_id", {"province_name": "province_name"}, spread_by
    )
