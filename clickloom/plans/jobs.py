"""Batch jobs: archive in, tables or documents out.

Each job reads and parses the archive once. What several results share is written as a
narrow table first; it is small against the archive, and a lost executor costs no re-read
of the archive because the table is on shared storage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom.functions.clock import bucket_date, bucket_time, time_bucket
from clickloom.functions.web import domain_of
from clickloom.operators.counts import (
    day_hour_counts, hour_counts, hour_cube, roll_up, tz_hour_counts,
)
from clickloom.operators.reshape import click_ids, enrich_documents, full_events, raw_by_day
from clickloom.schema import COUNT_KEYS, SERVING_TABLES, UNITS, count_table
from clickloom.session import scratch_dir
from clickloom.sinks.documents import write_documents, write_json
from clickloom.sinks.tables import (
    write_click_ids, write_full_events, write_raw_clicks, write_table,
)
from clickloom.sources.lines import click_lines, parse_clicks
from clickloom.sources.serving import read_table

PATTERNS = ["query1", "query2", "query3"]


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a shared intermediate result and read it back."""
    path = scratch_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hour_patterns(events: DataFrame, run: Column | None = None) -> dict[str, DataFrame]:
    """The three hour patterns, from one pass over ``t`` and ``tz``."""
    cube = stored(hour_cube(events), "hour-cube")
    return dict(zip(PATTERNS, [hour_counts(cube, run), tz_hour_counts(cube, run),
                               day_hour_counts(cube)]))


def run_hour_patterns(lines: DataFrame, out: str, run: Column | None = None) -> None:
    """Archive lines to pattern documents in ``out/query1`` to ``out/query3``."""
    events = parse_clicks(click_lines(lines, clean=True), "t", "tz")
    for name, pattern in hour_patterns(events, run).items():
        write_json(pattern, f"{out}/{name}")


def second_cube(events: DataFrame) -> DataFrame:
    """Clicks per second, country and domain, NULL keys included.

    The base of all nine count tables: a table drops the NULLs of its own keys only.
    """
    keyed = events.select("t", F.col("c").alias("country_code"), domain_of("u").alias("domain"))
    counted = (
        keyed.where(F.col("t").isNotNull())
        .groupBy(time_bucket("t", "second").alias("bucket"), "country_code", "domain")
        .agg(F.count(F.lit(1)).alias("clicks"))
    )
    return counted.select(bucket_date("bucket", "second").alias("date"), "country_code", "domain",
                          bucket_time("bucket", "second").alias("time"), "clicks")


def build_count_tables(events: DataFrame, root: str) -> None:
    """All count tables below ``root``: seconds from the clicks, each coarser one from the finer."""
    spark = events.sparkSession
    cube = stored(second_cube(events), "second-cube")
    for subject, keys in COUNT_KEYS.items():
        finer = cube.dropna(subset=keys).select("date", *keys, "time", "clicks")
        for unit in UNITS:
            table = count_table(subject, unit)
            same_keys = unit == "second" and subject == "country_domain"
            write_table(finer if same_keys else roll_up(finer, unit), f"{root}/{table}")
            finer = read_table(spark, root, table)


def build_event_tables(lines: DataFrame, root: str) -> None:
    """Raw lines, ids and wide events below ``root``."""
    write_raw_clicks(raw_by_day(lines), f"{root}/raw_clicks")
    events = parse_clicks(click_lines(lines))
    write_click_ids(click_ids(events), f"{root}/click_ids")
    write_full_events(full_events(events), f"{root}/full_events")


def build_serving(lines: DataFrame, root: str) -> None:
    """Every serving table from archive lines."""
    build_count_tables(parse_clicks(click_lines(lines), "t", "c", "u"), root)
    build_event_tables(lines, root)


def table_sizes(spark: SparkSession, root: str) -> DataFrame:
    """Rows and clicks of each count table below ``root``."""
    parts = []
    for table in SERVING_TABLES:
        rows = read_table(spark, root, table)
        clicks = F.sum("clicks") if "clicks" in rows.columns else F.count(F.lit(1))
        parts.append(rows.agg(F.lit(table).alias("table"), F.count(F.lit(1)).alias("rows"),
                              clicks.alias("clicks")))
    sizes = parts[0]
    for part in parts[1:]:
        sizes = sizes.unionByName(part)
    return sizes
