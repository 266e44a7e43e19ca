"""Replay of stored lines as a live feed."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom.session import scratch_dir
from clickloom.streaming.feed import line_feed


class Replay(NamedTuple):
    """Delivered files, how many make a batch, and the watermark delay that loses no line."""

    path: str
    files: int
    files_per_batch: int
    delay: str

    def feed(self, spark: SparkSession) -> DataFrame:
        return line_feed(spark, self.path, self.files_per_batch)


def deliver(lines: DataFrame, slices: int = 5) -> Replay:
    """Write lines as text files, one slice of the covered time after the other.

    Files inside a slice are in no order, so the delay covers one slice: no line can then
    be older than the watermark when it is read. Lines without a time come first.
    """
    spark = lines.sparkSession
    stored, landing = scratch_dir(spark, "replay-lines"), scratch_dir(spark, "replay")
    epoch = F.get_json_object("event", "$.t").try_cast("bigint")
    lines.withColumn("epoch", epoch).write.option("compression", "zstd").parquet(stored)
    timed = spark.read.schema("event string, epoch bigint").parquet(stored)
    first, last = timed.agg(F.min("epoch"), F.max("epoch")).first()
    first, last = first or 0, last or 0
    width = (last - first) // slices + 1
    for k in range(slices):
        start = first + k * width
        inside = (F.col("epoch") >= start) & (F.col("epoch") < start + width)
        chosen = timed.where(inside | F.col("epoch").isNull() if k == 0 else inside)
        chosen.select("event").write.mode("append").option("compression", "gzip").text(landing)
    files = len(spark.read.text(landing).inputFiles())
    return Replay(landing, files, -(-files // slices), f"{width} seconds")


def deliver_in_steps(lines: DataFrame, path: str, slices: int, again: Column | None = None) -> Iterator[None]:
    """Write lines slice by slice of the covered time, pausing after each; for runs that restart in between.

    A line of which ``again`` is true is delivered a second time, with the next slice. Lines without a time come first.
    """
    spark, stored = lines.sparkSession, scratch_dir(lines.sparkSession, "replay-steps")
    epoch = F.get_json_object("event", "$.t").try_cast("bigint")
    lines.select("event", epoch.alias("epoch")).distinct().write.option("compression", "zstd").parquet(stored)
    timed = spark.read.schema("event string, epoch bigint").parquet(stored)
    first, last = timed.agg(F.min("epoch"), F.max("epoch")).first()
    first, last = first or 0, last or 0
    width = (last - first) // slices + 1
    part = F.coalesce(F.floor((F.col("epoch") - first) / width), F.lit(0))
    for k in range(slices + (again is not None)):
        chosen = timed.where(part == k)
        if again is not None:
            chosen = chosen.unionByName(timed.where((part == k - 1) & again))
        chosen.select("event").write.mode("append").text(path)
        yield
