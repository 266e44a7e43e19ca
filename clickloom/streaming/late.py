"""Lines that came too late for a live count, as a result instead of a silent gap.

A windowed count drops a line whose window the watermark has passed. The same rule, applied to lines instead of counts, tells
which ones: the windows' line digests are counted with the same watermark, and late is what the stored raw lines have more
of. Digests leave the state with their windows. (Spark judges a batch's lines by the watermark that the batch before it had.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.functions.clock import epoch_unit
from clickloom.sources.lines import click_lines
from clickloom.streaming.feed import plausible

_KEYS = ["date", "time", "digest"]


def _digest() -> Column:
    return F.sha2(F.col("event"), 256).alias("digest")


def _timed(lines: DataFrame) -> DataFrame:
    timed = click_lines(lines).withColumn("t", F.get_json_object("event", "$.t").try_cast("bigint"))
    return timed.where(plausible("t"))


def counted_lines(lines: DataFrame, delay: str, unit: str = "minute") -> DataFrame:
    """How often each click line was counted in its window: ``date, time, digest, clicks``, for a live table."""
    timed = _timed(lines).select(F.timestamp_seconds("t").alias("event_time"), _digest()).withWatermark("event_time", delay)
    counted = timed.groupBy(F.window("event_time", f"1 {unit}").alias("window"), "digest").agg(F.count(F.lit(1)).alias("clicks"))
    start = F.unix_seconds("window.start")
    return counted.select(epoch_unit(start, "day").alias("date"), epoch_unit(start, unit).alias("time"), "digest", "clicks")


def newest_counts(rows: DataFrame) -> DataFrame:
    """The live table's rows after their last change: counts only grow."""
    return rows.groupBy(*_KEYS).agg(F.max("clicks").alias("clicks"))


def late_lines(raw_clicks: DataFrame, counted: DataFrame, unit: str = "minute") -> DataFrame:
    """Click lines that are missing from the live counts, and how many copies of each: ``date, time, event, clicks``.

    Digests, not lines, are shuffled; the lines are fetched for the late ones alone.
    """
    lines = _timed(raw_clicks.select("event")).select(
        epoch_unit("t", "day").alias("date"), epoch_unit("t", unit).alias("time"), _digest(), "event")
    arrived = lines.groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("n"))
    missing = arrived.join(counted, _KEYS, "left").select(
        *_KEYS, (F.col("n") - F.coalesce("clicks", F.lit(0))).alias("clicks")).where("clicks > 0")
    return lines.join(missing, _KEYS).select("date", "time", "event", "clicks").distinct()
