"""Live click lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom.sources.lines import click_lines, parse_clicks

#: Groups over which copies of one id are spread before they meet.
SALTS = 16

#: Seconds by which a click's time may be ahead of the cluster's clock.
AHEAD = 86_400


def line_feed(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Lines of the files that arrive in a folder: ``event, salt``.

    ``salt`` depends on the file a line came in, so a task that runs again computes the
    same one. Offsets and replay come from the query's checkpoint.
    """
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    salt = F.pmod(F.hash("_metadata.file_path"), F.lit(SALTS)).alias("salt")
    return reader.text(path).select(F.col("value").alias("event"), salt)


def kafka_feed(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Lines of a Kafka topic: ``event, salt``. Needs the Kafka source on the class path."""
    records = (
        spark.readStream.format("kafka").options(**options)
        .option("kafka.bootstrap.servers", servers).option("subscribe", topic).load()
    )
    salt = F.pmod(F.hash("partition", "offset"), F.lit(SALTS)).alias("salt")
    return records.select(F.col("value").cast("string").alias("event"), salt)


def timed_clicks(lines: DataFrame, delay: str, *fields: str) -> DataFrame:
    """Clicks that have a time, with the named fields and a watermark on ``event_time``.

    Clicks older than the newest by more than ``delay`` are missing from live counts until the
    day is closed; clicks with an implausible time go to the odd clicks.
    """
    events = parse_clicks(click_lines(lines), "t", *fields)
    timed = events.where(plausible("t")).withColumn("event_time", F.timestamp_seconds("t"))
    return timed.withWatermark("event_time", delay)


def plausible(epoch: str) -> Column:
    """Whether a click's time can move the watermark: from 1970 to ``AHEAD`` seconds after now.

    A time in milliseconds would move it by millennia, and every later click would be late.
    """
    return (F.col(epoch) >= 0) & (F.col(epoch) <= F.unix_timestamp(F.current_timestamp()) + AHEAD)


def odd_clicks(lines: DataFrame) -> DataFrame:
    """Click lines with a time that :func:`timed_clicks` does not take, under today's day."""
    timed = lines.withColumn("t", F.get_json_object("event", "$.t").try_cast("bigint"))
    odd = click_lines(timed).where(F.col("t").isNotNull() & ~plausible("t"))
    return odd.select(F.current_date().cast("string").alias("date"), "event")
