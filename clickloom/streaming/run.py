"""Starting, writing and stopping streaming queries."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from clickloom.session import STATE, settings


def _writer(df: DataFrame, checkpoint: str, every: str | None) -> DataStreamWriter:
    """``every`` is the batch interval; without it the query takes what is there and ends."""
    writer = df.writeStream.option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


@contextmanager
def state_partitions(spark: SparkSession, number: int) -> Iterator[None]:
    """Queries first started inside keep their state in at most ``number`` partitions.

    The number stays with a query's checkpoint, so choose it for the keys that will be
    open at once. The session's shuffle partitions remain the upper bound.
    """
    setting = "spark.sql.shuffle.partitions"
    with settings(spark, **{setting: str(max(1, min(int(spark.conf.get(setting)), number)))}):
        yield


def state_on_disk(spark: SparkSession) -> AbstractContextManager[None]:
    """Queries first started inside keep their state as :data:`~clickloom.session.STATE` says, whatever the session's settings.

    Spark's default holds all keys of all partitions on the executors' heaps, two versions of them, so a state that grows with the
    input needs executors that grow with it.
    """
    return settings(spark, **STATE)


def append_files(df: DataFrame, path: str, checkpoint: str, every: str | None = None,
                 fmt: str = "parquet") -> StreamingQuery:
    """Final rows, each exactly once, in a folder per day."""
    writer = _writer(df, checkpoint, every).outputMode("append").format(fmt)
    return writer.option("path", path).partitionBy("date").start()


def start_batches(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
                  every: str | None = None) -> StreamingQuery:
    """Each batch given to ``write`` with its number; the same number comes again after a failure."""
    return _writer(df, checkpoint, every).foreachBatch(write).start()


def append_live(counts: DataFrame, path: str, checkpoint: str,
                every: str | None = None) -> StreamingQuery:
    """Changed counts of every batch, in a folder per day and batch.

    A batch that is repeated after a failure replaces its own folders.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("batch", F.lit(batch_id).cast("bigint")).hint("rebalance", "date")
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("date", "batch").parquet(path)
        )

    return _writer(counts, checkpoint, every).outputMode("update").foreachBatch(write).start()


def run_for(queries: Iterable[StreamingQuery], seconds: float, grace: float = 60.0) -> None:
    """Let queries run for a bounded time, then stop them all between two batches.

    When one fails the others are stopped as well, and its error is raised at the end. A query
    that is still within a batch after ``grace`` seconds is stopped there; the next start from the
    checkpoint repeats the batch.
    """
    queries = list(queries)
    end = time.monotonic() + seconds
    try:
        while time.monotonic() < end and any(query.isActive for query in queries):
            if any(query.exception() for query in queries):
                break
            time.sleep(min(0.2, max(0.0, end - time.monotonic())))
    finally:
        last = time.monotonic() + grace
        for query in queries:
            while query.isActive and query.status["isTriggerActive"] and time.monotonic() < last:
                time.sleep(0.05)
            query.stop()
    for query in queries:
        if error := query.exception():
            raise error


def keep_running(start: Callable[[], StreamingQuery], tries: int = 3, pause: float = 1.0) -> StreamingQuery:
    """Wait for a query to end; when it fails, start it again from its checkpoint, at most ``tries`` times in all.

    The last failure is raised. A batch that failed is repeated with the same offsets.
    """
    for left in reversed(range(tries)):
        query = start()
        try:
            query.awaitTermination()
            return query
        except StreamingQueryException:
            if not left:
                raise
            time.sleep(pause)
    raise ValueError("tries must be at least 1")
