"""The log and change-feed streams into the fact tables and the dirty table."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tonearm.functions.timefmt import ms_to_partition_date
from tonearm.operators.lookup import Dims
from tonearm.plans import facts
from tonearm.sources.sinks import BatchSink, write_batch, write_batch_partitions


def refreshed(
    load: Callable[[], Dims], seconds: float = 0.0, clock: Callable[[], float] = time.monotonic
) -> Callable[[], Dims]:
    """Dimensions that are read again after that many seconds; 0 is every batch."""
    held: dict[str, object] = {}

    def get() -> Dims:
        now = clock()
        if "dims" not in held or now - held["at"] >= seconds:
            held["dims"], held["at"] = load(), now
        return held["dims"]

    return get


def log_sink(
    dims: Callable[[], Dims], out: str, written: Callable[[str, int], None] = lambda output, batch_id: None
) -> BatchSink:
    """One read of the log feeds all seven facts and the dirty table. `written` is told of
    every output as it is done. Each output of a batch is replaced when the batch is run again."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        tagged = facts.tag_log(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            now = dims()
            for spec in facts.LOG_FACTS:
                good = tagged.where(
                    (F.col("fact") == spec.name) & F.col("dirty_type").isNull()
                )
                rows = facts.enrich(facts.typed(good, spec), spec, now)
                write_batch(rows, f"{out}/{spec.name}", batch_id)
                written(spec.name, batch_id)
            bad = tagged.where(F.col("dirty_type").isNotNull()).select(
                "fact", "dirty_type", facts.record_text(batch).alias("record"), "ts",
                ms_to_partition_date(F.col("ts")).alias("day"),
            )
            write_batch_partitions(bad, f"{out}/dirty", batch_id, ["fact", "day"])
            lost = tagged.where(F.col("fact").isNull())
            lost = lost.select("type", facts.record_text(batch).alias("record"))
            write_batch(lost, f"{out}/dropped", batch_id)
        finally:
            tagged.unpersist()

    return sink


def trade_sink(
    dims: Callable[[], Dims], out: str, spec: facts.FactSpec, by: str = "dt"
) -> BatchSink:
    """Change rows of one order table into its day partitions, bad ones to `dirty`.

    `by="month"` makes coarser folders, for a first load that spans years of days with
    few orders each; `dt` is then a plain column. A batch is parsed once; what is held of it
    are typed columns, and texts of dirty rows alone.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        judged = facts.judge_trade(batch, spec).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows = facts.enrich(facts.judged_clean(judged, spec), spec, dims())
            if spec.keep_status is not None:
                rows = rows.where("user_id is not null and order_id is not null")
            if by == "month":
                rows = rows.withColumn("month", F.substring("dt", 1, 6))
            write_batch_partitions(rows, f"{out}/{spec.name}", batch_id, [by])
            # Dirty rows go by the day of the change, which a replay gives again.
            day = ms_to_partition_date(F.col("ts"))
            bad = facts.judged_dirty(judged, spec).withColumn("day", day)
            write_batch_partitions(bad, f"{out}/dirty", batch_id, ["fact", "day"])
        finally:
            judged.unpersist()

    return sink
