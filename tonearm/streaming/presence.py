"""Current listeners per song over a stream of plays.

Two keyed tables: the last change of every song and user, and the listeners of every song. A
micro-batch compares its own last changes with those stored, and adds the differences to
the songs, so it costs what it brings; the figures shown are one row per song.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tonearm.functions.timefmt import DATE
from tonearm.operators.lookup import Dims
from tonearm.operators.presence import ENTER, last_change, presence_changes
from tonearm.plans.warehouse import song_names
from tonearm.sources.keyed import KeyedTable
from tonearm.sources.sinks import BatchSink

LAST = "song_id bigint, user_id bigint, last struct<ts: bigint, play_id: bigint, seq: int>"
ONLINE = "song_id bigint, current_online_count bigint"


def _last(out: str) -> KeyedTable:
    return KeyedTable(f"{out}/last", LAST, ["song_id", "user_id"])


def _online(out: str) -> KeyedTable:
    return KeyedTable(f"{out}/listeners", ONLINE, ["song_id"], add=("current_online_count",))


def presence_sink(out: str) -> BatchSink:
    """Clean plays into the last changes and, for every song, its current listeners.

    The songs come first: a batch that is run again finds its differences staged, or finds the
    last changes as they were before it."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        last = last_change(presence_changes(batch)).select("song_id", "user_id", "last")
        last = last.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            before = _last(out).near(last).withColumnRenamed("last", "before")
            newer = last.join(before.hint("merge"), ["song_id", "user_id"], "left").withColumn(
                "last", F.when(F.col("before") > F.col("last"), F.col("before")).otherwise(F.col("last"))
            ).persist(StorageLevel.MEMORY_AND_DISK)
            inside = lambda c: F.coalesce((F.col(f"{c}.seq") == ENTER).cast("bigint"), F.lit(0))
            _online(out).upsert(
                newer.groupBy("song_id").agg(F.sum(inside("last") - inside("before")).alias("current_online_count")), batch_id
            )
            _last(out).upsert(newer.drop("before"), batch_id)
            newer.unpersist()
            current_listeners(spark, out).write.mode("overwrite").parquet(f"{out}/online/batch_id={batch_id}")
        finally:
            last.unpersist()

    return sink


def current_listeners(spark: SparkSession, out: str) -> DataFrame:
    """Listeners per song as of the last batch; a song that was only left has 0."""
    return _online(out).read(spark)


def online_report(online: DataFrame, dims: Dims) -> DataFrame:
    """What is shown on each beat: all songs with their listeners, names, and the date."""
    named = song_names(online, dims, ["song_name", "singer_name"])
    return named.withColumn("partition_time", F.date_format(F.current_timestamp(), DATE))
