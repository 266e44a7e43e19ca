"""Top-k with the key as tie-break, so that the cut is the same on every run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def top(counts: DataFrame, key: str, n: int | None = None, by: str = "clicks") -> DataFrame:
    """Largest counts first; ``n`` rows, or all of them in order."""
    ordered = counts.orderBy(F.desc(by), key)
    return ordered if n is None else ordered.limit(n)


def rank_per_day(counts: DataFrame, key: str, n: int, by: str = "clicks") -> DataFrame:
    """The ``n`` largest of every day. Spark cuts each task to ``n`` per day before the shuffle."""
    order = Window.partitionBy("date").orderBy(F.desc(by), key)
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
