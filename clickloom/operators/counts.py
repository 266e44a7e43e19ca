"""Grouped counts.

Counts group by the number of the second, minute or hour, an integer, and turn it into
text only for the result rows: the shuffle then carries no formatted dates. Every count is
a partial and a final hash aggregate, so a key holding a large share of all clicks is
reduced to one row per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.functions.clock import (
    SECONDS, bucket_date, bucket_time, epoch_unit, time_bucket, today_unit,
)
from clickloom.functions.web import domain_of
from clickloom.operators.filters import with_values
from clickloom.schema import COUNT_KEYS

#: Click field behind each serving key.
KEY_FIELDS = {"domain": "u", "country_code": "c"}

#: Characters of ``HH:mm:ss`` that a unit keeps.
_WIDTH = {"hour": 2, "minute": 5, "second": 8}


def count_keys(events: DataFrame, keys: list[str], time: str = "t") -> DataFrame:
    """Click rows reduced to their time and the serving keys, without rows that lack one."""
    make = {"domain": domain_of, "country_code": F.col}
    columns = [make[key](KEY_FIELDS[key]).alias(key) for key in keys]
    return with_values(events.select(time, *columns), time, *keys)


def count_by(events: DataFrame, keys: list[str], unit: str) -> DataFrame:
    """Clicks per key and second, minute or hour: ``date, keys…, time, clicks``."""
    counted = (
        count_keys(events, keys)
        .groupBy(time_bucket("t", unit).alias("bucket"), *keys)
        .agg(F.count(F.lit(1)).alias("clicks"))
    )
    return counted.select(bucket_date("bucket", unit).alias("date"), *keys,
                          bucket_time("bucket", unit).alias("time"), "clicks")


def count_table_of(events: DataFrame, subject: str, unit: str) -> DataFrame:
    """The rows of one serving table, e.g. ``("country_domain", "minute")``."""
    return count_by(events, COUNT_KEYS[subject], unit)


def roll_up(counts: DataFrame, unit: str) -> DataFrame:
    """Coarser counts from finer ones: far fewer rows to read than the clicks."""
    keys = [name for name in counts.columns if name not in ("date", "time", "clicks")]
    time = F.substring("time", 1, _WIDTH[unit]).alias("time")
    return (
        counts.groupBy("date", *keys, time).agg(F.sum("clicks").alias("clicks"))
        .select("date", *keys, "time", "clicks")
    )


def hour_cube(events: DataFrame) -> DataFrame:
    """Clicks per time zone and hour: all that the three hour patterns need, in one pass."""
    return (
        events.groupBy(time_bucket("t", "hour").alias("bucket"), F.col("tz").alias("timezone"))
        .agg(F.count(F.lit(1)).alias("counter"))
    )


def _pattern(cube: DataFrame, *groups: Column) -> DataFrame:
    hour = epoch_unit(F.col("bucket") * SECONDS["hour"], "hour").alias("hour")
    return cube.groupBy(*groups, hour).agg(F.sum("counter").alias("counter"))


def _run_day(run: Column | None) -> Column:
    return today_unit("day", run).alias("@timestamp")


def hour_counts(cube: DataFrame, run: Column | None = None) -> DataFrame:
    """Clicks per hour of day, stamped with the run's day. A missing time is a group."""
    counted = _pattern(cube)
    return counted.select(_run_day(run), "hour", "counter").orderBy(F.desc("counter"), "hour")


def tz_hour_counts(cube: DataFrame, run: Column | None = None) -> DataFrame:
    """Clicks per time zone and hour of day, stamped with the run's day."""
    counted = _pattern(cube, F.col("timezone"))
    return (counted.select(_run_day(run), "timezone", "hour", "counter")
            .orderBy("timezone", F.desc("counter"), "hour"))


def day_hour_counts(cube: DataFrame) -> DataFrame:
    """Clicks per day and hour."""
    day = bucket_date("bucket", "hour").alias("@timestamp")
    return _pattern(cube, day).orderBy(F.desc("counter"), "`@timestamp`", "hour")
