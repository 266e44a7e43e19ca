"""The daily counter, live: different lines per day."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickloom.functions.clock import epoch_unit
from clickloom.plans.reads import daily_counters
from clickloom.streaming.feed import SALTS, plausible


def line_counter(lines: DataFrame, delay: str) -> DataFrame:
    """``date, clicks`` of every day that the watermark has passed, once and final.

    Two stateful steps in a row. Copies of a line have its time, so the first step keeps a line's digest no longer than
    the delay; the second counts what passes by day. Digests spread a hot line's copies by a salt first. Lines without a
    plausible time belong to no day here.
    """
    timed = lines.withColumn("t", F.get_json_object("event", "$.t").try_cast("bigint")).where(plausible("t"))
    marked = timed.select(
        F.timestamp_seconds("t").alias("event_time"), "salt", F.unhex(F.sha2(F.col("event"), 256)).alias("digest"))
    marked = marked.withWatermark("event_time", delay)
    once = (marked.dropDuplicatesWithinWatermark(["event_time", "digest", "salt"])
            .dropDuplicatesWithinWatermark(["event_time", "digest"]))
    spread = F.pmod(F.hash("digest"), F.lit(SALTS)).alias("part")
    counted = once.groupBy(F.window("event_time", "1 day").alias("day"), spread).agg(F.count(F.lit(1)).alias("clicks"))
    return counted.select(epoch_unit(F.unix_seconds("day.start"), "day").alias("date"), "part", "clicks")


def daily_totals(closed: DataFrame, raw_clicks: DataFrame) -> DataFrame:
    """Different lines of every day: closed days as counted live, the others from their stored raw lines."""
    done = closed.groupBy("date").agg(F.sum("clicks").alias("clicks"))
    open_days = raw_clicks.join(done.select("date"), "date", "left_anti")
    return done.unionByName(daily_counters(open_days))
