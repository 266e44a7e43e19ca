"""Counts per event-time window, and the live tables they feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.functions.clock import epoch_unit
from clickloom.operators.counts import count_keys
from clickloom.schema import SERVING_TABLES
from clickloom.sources.serving import read_table


def windowed_counts(clicks: DataFrame, keys: list[str], unit: str,
                    length: str | None = None, slide: str | None = None) -> DataFrame:
    """Clicks per key and window of event time: ``date, keys…, time, clicks``.

    The window is one ``unit`` unless a ``length`` is given; with a ``slide`` windows
    overlap. A minute is one row however many batches its clicks arrive in.
    """
    window = F.window("event_time", length or f"1 {unit}", slide)
    counted = (
        count_keys(clicks, keys, "event_time").groupBy(window.alias("window"), *keys)
        .agg(F.count(F.lit(1)).alias("clicks"))
    )
    start = F.unix_seconds("window.start")
    return counted.select(epoch_unit(start, "day").alias("date"), *keys,
                          epoch_unit(start, unit).alias("time"), "clicks")


def sliding_counts(panes: DataFrame, length: int, slide: int = 1) -> DataFrame:
    """Overlapping windows of ``length`` minutes that begin every ``slide`` minutes, from counts per minute.

    The minutes are first summed to panes of one slide each; a pane, not a click, is copied into the windows it is part of. A
    window has a row if a click lies in it; ``date`` and ``time`` are its beginning. ``length`` is a multiple of ``slide``.
    """
    if length % slide:
        raise ValueError("a window must be made of whole slides")
    keys = [name for name in panes.columns if name not in ("date", "time", "clicks")]
    minute = F.unix_seconds(F.try_to_timestamp(F.concat_ws(" ", "date", "time"), F.lit("yyyy-MM-dd HH:mm"))) / 60
    pane = F.floor(minute / slide).alias("pane")
    summed = panes.groupBy(*keys, pane).agg(F.sum("clicks").alias("clicks"))
    starts = F.explode(F.sequence(F.col("pane") - (length // slide - 1), F.col("pane"))).alias("start")
    windows = summed.select(*keys, starts, "clicks").groupBy(*keys, "start").agg(F.sum("clicks").alias("clicks"))
    epoch = F.col("start") * slide * 60
    return windows.select(epoch_unit(epoch, "day").alias("date"), *keys, epoch_unit(epoch, "minute").alias("time"), "clicks")


def read_live(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The newest count of every key of a live table; counts only grow."""
    rows = spark.read.schema(f"{SERVING_TABLES[table]}, batch bigint").parquet(path)
    keys = [name for name in rows.columns if name not in ("clicks", "batch")]
    return rows.groupBy(*keys).agg(F.max("clicks").alias("clicks"))


def read_counts(spark: SparkSession, live: str, root: str, table: str) -> DataFrame:
    """Serving rows of the closed days and live rows of the days after them."""
    served = read_table(spark, root, table)
    last = served.select(F.coalesce(F.max("date"), F.lit(""))).scalar()
    recent = read_live(spark, live, table).where(F.col("date") > last)
    return served.unionByName(recent)
