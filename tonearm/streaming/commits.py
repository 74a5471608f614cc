"""Day partitions that a running stream makes visible once they are over.

Rows go into folders by day and batch. The watermark of the stream's own progress tells
which days no row is due for any more; these are registered with the catalog, so a reader
of the table sees whole days only.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tonearm.functions.timefmt import ms_to_partition_date
from tonearm.sources.sinks import BatchSink, closed_partitions, write_batch_partitions

COMMIT_DELAY_MS = 600_000


def watermark_ms(query: StreamingQuery | None) -> int | None:
    """The watermark of the last finished batch; none before there is one."""
    progress = query.lastProgress if query is not None else None
    text = progress["eventTime"].get("watermark") if progress and progress["eventTime"] else None
    if not text or text.startswith("1970-01-01T00:00:00"):
        return None
    return round(datetime.strptime(text, "%Y-%m-%dT%H:%M:%S.%fZ").replace(tzinfo=timezone.utc).timestamp() * 1000)


class DayCommits:
    """The sink of a stream, and the stream itself once it runs (`watch`)."""

    def __init__(self, table: str, path: str, ts: str, delay_ms: int = COMMIT_DELAY_MS):
        self.table, self.path, self.ts, self.delay_ms = table, path, ts, delay_ms
        self.query: StreamingQuery | None = None
        self.before: int | None = None

    def watch(self, query: StreamingQuery) -> StreamingQuery:
        """A stream that is taken up again has the watermark that it was left with."""
        self.before = self._high()
        self.query = query
        return query

    def _high(self) -> int | None:
        high = watermark_ms(self.query)
        return self.before if high is None else high

    def sink(self) -> BatchSink:
        def sink(batch: DataFrame, batch_id: int) -> None:
            rows = batch.withColumn("dt", ms_to_partition_date(F.col(self.ts)))
            write_batch_partitions(rows.where("dt is not null"), self.path, batch_id, ["dt"])
            self.commit(batch)

        return sink

    def commit(self, batch: DataFrame) -> None:
        """Register the folders of all days that are over. Folders already there stay."""
        spark, high = batch.sparkSession, self._high()
        if high is None:
            return
        stored = spark.read.parquet(self.path).select(F.col("dt").cast("string").alias("dt"), "batch_id").distinct()
        over = stored.join(closed_partitions(stored, high, self.delay_ms), "dt")
        # One row per day and batch, and only such as the catalog is to hold.
        found = sorted((r["dt"], r["batch_id"]) for r in over.collect())
        if found:
            parts = " ".join(
                f"PARTITION (dt = '{d}', batch_id = {b}) LOCATION '{self.path}/dt={d}/batch_id={b}'" for d, b in found
            )
            spark.sql(f"ALTER TABLE {self.table} ADD IF NOT EXISTS {parts}")


def create_day_table(rows: DataFrame, table: str, path: str) -> None:
    """A catalog table over the folders, of which it knows none yet."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    rows.sparkSession.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}, dt string, batch_id bigint) USING parquet "
        f"PARTITIONED BY (dt, batch_id) LOCATION '{path}'"
    )
