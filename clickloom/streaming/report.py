"""What a live run has done: lines and clicks per batch and in all."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from clickloom.operators.filters import CLICK_MARK

SCHEMA = "batch bigint, lines bigint, clicks bigint, started string, seconds double"


def observed(lines: DataFrame, name: str = "run") -> DataFrame:
    """The lines, counted on their way: no pass of its own."""
    marked = F.col("event").contains(CLICK_MARK)
    return lines.observe(name, F.count(F.lit(1)).alias("lines"), F.count(F.when(marked, 1)).alias("clicks"))


class RunReport(StreamingQueryListener):
    """A row per batch of the queries with :func:`observed` lines, as they finish."""

    def __init__(self, name: str = "run"):
        self.name, self.batches, self.ended = name, {}, set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = json.loads(event.progress.json)
        seen = progress.get("observedMetrics", {}).get(self.name)
        if seen:
            # a batch that is repeated replaces its row
            self.batches[progress["id"], progress["batchId"]] = (
                progress["batchId"], seen["lines"], seen["clicks"], progress["timestamp"],
                progress["durationMs"].get("triggerExecution", 0) / 1000)

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))

    def wait(self, query: StreamingQuery, seconds: float = 30.0) -> None:
        """Events come after the fact; wait for a query's last one."""
        end = time.monotonic() + seconds
        while str(query.runId) not in self.ended and time.monotonic() < end:
            time.sleep(0.05)

    def rows(self, spark: SparkSession) -> DataFrame:
        """``batch, lines, clicks, started, seconds``; batches without lines are left out."""
        return spark.createDataFrame([row for row in self.batches.values() if row[1]], SCHEMA)


def totals(rows: DataFrame) -> DataFrame:
    """Lines and clicks of the whole run, and clicks per second of its batches' time."""
    return rows.agg(F.count(F.lit(1)).alias("batches"), F.coalesce(F.sum("lines"), F.lit(0)).alias("lines"),
                    F.coalesce(F.sum("clicks"), F.lit(0)).alias("clicks"),
                    (F.sum("clicks") / F.sum("seconds")).alias("clicks_per_second"))
