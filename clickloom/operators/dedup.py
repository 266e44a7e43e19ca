"""Exact duplicates within a day.

All three group by every column they keep, so copies merge in the map tasks and a line that
makes up a third of the input costs one row per task in the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def distinct_lines(raw_clicks: DataFrame) -> DataFrame:
    """One row per day and line."""
    return raw_clicks.select("date", "event").distinct()


def distinct_ids(click_ids: DataFrame) -> DataFrame:
    """One row per day and id."""
    return click_ids.select("date", "id").distinct()


def lines_per_day(raw_clicks: DataFrame) -> DataFrame:
    """Different lines per day: ``date, clicks``.

    Only the count is wanted, so the shuffle carries each line's SHA-256 digest instead of
    the line.
    """
    digest = F.unhex(F.sha2(F.col("event"), 256)).alias("digest")
    return (
        raw_clicks.select("date", digest).distinct()
        .groupBy("date").agg(F.count(F.lit(1)).alias("clicks"))
    )
