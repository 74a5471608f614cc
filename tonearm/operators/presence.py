"""Who listens to what: enter and leave events from plays, listeners per song."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonearm.functions.unroll import unroll

# At one play the enter comes before the leave.
ENTER, LEAVE = 0, 1

def presence_changes(plays: DataFrame) -> DataFrame:
    """Each play enters its song and, if there was one before, leaves that one."""

    moves = unroll(
        plays.selectExpr("user_id", "start_ts AS ts", "play_id", "song_id AS _song",
                         "lead_song_id AS _lead"),
        ["user_id", "ts", "play_id"],
        [{"song_id": "_song", "seq": str(ENTER)}, {"song_id": "_lead", "seq": str(LEAVE)}],
    )
    return moves.where("song_id IS NOT NULL").select(
        "song_id", "user_id", "ts", "play_id", "seq"
    )


def change_order() -> Column:
    """What decides which change is the last: time, then play, then kind. A null time
    comes before all others."""
    return F.struct("ts", "play_id", "seq")


def last_change(changes: DataFrame) -> DataFrame:
    """Per song and user the last change, and whether the user is in after it."""
    last = changes.groupBy("song_id", "user_id").agg(F.max(change_order()).alias("last"))
    return last.select("song_id", "user_id", "last", (F.col("last.seq") == ENTER).alias("online"))


def online_listeners(changes: DataFrame) -> DataFrame:
    """Listeners per song; a song that was only left appears with 0."""
    return (
        last_change(changes)
        .groupBy("song_id")
        .agg(F.sum(F.col("online").cast("bigint")).alias("current_online_count"))
    )
