"""Current listeners per song as keyed state with a beat.

Spark keeps, per song, the last change of each listener and the number of those inside. A
batch reads and writes the entries it names. A processing-time timer on a grid tells the
figure of every song, whether or not it changed, those with nobody left included.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tonearm.operators.presence import ENTER

#: Between two beats.
BEAT_MS = 5_000
BEATS = "song_id bigint, current_online_count bigint, beat_ms bigint"


def _order(ts: int | None, play_id: int | None, seq: int) -> tuple:
    """The order of changes; a null comes before all others."""
    return (ts is not None, ts or 0, play_id is not None, play_id or 0, seq)


class Listeners(StatefulProcessor):
    def __init__(self, beat_ms: int = BEAT_MS):
        self.beat_ms = beat_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getMapState("last", "user_id bigint", "ts bigint, play_id bigint, seq int")
        self.inside = handle.getValueState("inside", "n bigint")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        newest: dict[int, tuple] = {}
        for r in rows:
            change = (r.ts, r.play_id, r.seq)
            if r.user_id not in newest or _order(*change) > _order(*newest[r.user_id]):
                newest[r.user_id] = change
        known = self.inside.exists()
        n = before = self.inside.get()[0] if known else 0
        for user, change in newest.items():
            held = tuple(self.last.getValue((user,))) if self.last.containsKey((user,)) else None
            if held is not None and _order(*held) >= _order(*change):
                continue
            self.last.updateValue((user,), change)
            n += (change[2] == ENTER) - (held is not None and held[2] == ENTER)
        if not known or n != before:
            self.inside.update((n,))
        if not known:
            self._next_beat(timerValues.getCurrentProcessingTimeInMs())
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        self._next_beat(now)
        yield Row(song_id=key[0], current_online_count=self.inside.get()[0], beat_ms=now // self.beat_ms * self.beat_ms)

    def _next_beat(self, now: int) -> None:
        self.handle.registerTimer((now // self.beat_ms + 1) * self.beat_ms)

    def close(self) -> None:
        pass


def beats(changes: DataFrame, beat_ms: int = BEAT_MS) -> DataFrame:
    """`(song_id, current_online_count, beat_ms)` of every song on every beat, from a stream of
    presence changes. Needs the RocksDB state store (`runner.keyed_state`)."""
    return changes.groupBy("song_id").transformWithState(
        statefulProcessor=Listeners(beat_ms), outputStructType=BEATS, outputMode="Append", timeMode="ProcessingTime"
    )
