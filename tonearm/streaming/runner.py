"""Starting a stream: source frame, sink, checkpoint, trigger."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tonearm.sources.sinks import BatchSink


def run_stream(
    df: DataFrame,
    sink: BatchSink,
    checkpoint: str,
    every: str | None = None,
    mode: str = "append",
    name: str | None = None,
) -> StreamingQuery:
    """Start a stream into a micro-batch sink. Without `every` it takes what is there
    now and ends. State and progress live in the checkpoint, so a lost executor or a
    restart continues from the last finished batch."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return _triggered(writer, every).foreachBatch(sink).start()


def run_to_files(
    df: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Start a stream into Parquet files, exactly once."""
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return _triggered(writer, every).format("parquet").option("path", path).start()


def _triggered(writer, every: str | None):
    if every:
        return writer.trigger(processingTime=every)
    return writer.trigger(availableNow=True)


def finish(query: StreamingQuery) -> None:
    """Wait for a stream that ends by itself; raise what stopped it."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


#: Keyed state with maps and timers needs this store.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Settings that a stream takes at its start; afterwards the session has its own again.
    Dots are written as two underscores."""
    names = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def keyed_state(spark: SparkSession):
    return settings(spark, spark__sql__streaming__stateStore__providerClass=ROCKSDB)


def one_batch_a_run(spark: SparkSession):
    """No batch without rows: a watermark moves with the next rows, not by itself."""
    return settings(spark, spark__sql__streaming__noDataMicroBatches__enabled="false")


#: Bytes of compressed texts that one task reads: parsed, they are more than ten times that.
PACKED_BYTES = 16 << 20


def packed_texts(spark: SparkSession):
    """For streams over compressed texts: a task reads fewer bytes of them."""
    most = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    return settings(spark, spark__sql__files__maxPartitionBytes=str(min(most, PACKED_BYTES)))
