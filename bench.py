"""Time the headline queries and print one JSON line.

Reads the tables in ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``. The archive job reads JSON
lines: the lines derived from the tables, repeated with new ids until there are at least
429,289 clicks, the size of the published run of the same three queries.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from clickloom.catalog import RUN_EPOCH, catalog
from clickloom.plans.jobs import run_hour_patterns
from clickloom.session import build_session, scratch_dir
from clickloom.sources.derived import derived_lines
from clickloom.sources.lines import click_lines, read_archive

PUBLISHED_CLICKS = 429_289

HEADLINE = [
    "hour_counts", "tz_hour_counts", "day_hour_counts", "domain_seconds", "domain_minutes",
    "country_domain_minutes", "country_minutes", "domain_hours", "daily_counter",
    "top_countries", "top_domains", "domain_evolution_last40", "parse_events", "enrich_docs",
    "full_event", "click_ids", "raw_by_day", "method_share", "top20_timezones",
    "top50_domains", "geo_heatmap", "tz_peak_hour", "sql_domain_minutes",
    "stream_domain_minutes", "stream_dedup_clicks", "stream_enrich_docs",
]


def archive(spark, tables: str) -> tuple[str, int]:
    """A folder of JSON lines with enough clicks, and their number."""
    path = scratch_dir(spark, "bench-archive")
    lines = derived_lines(spark, tables)
    copies = -(-PUBLISHED_CLICKS // click_lines(lines).count())
    numbered = lines.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    mark = F.concat(F.lit('"_id":"'), F.col("copy").cast("string"), F.lit("-"))
    numbered.select(F.replace("event", F.lit('"_id":"'), mark).alias("event")).write.text(path)
    return path, click_lines(read_archive(spark, path)).count()


def timed(run) -> float:
    began = time.perf_counter()
    run()
    return round(time.perf_counter() - began, 3)


def main() -> None:
    tables = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                          spark__driver__memory="12g", spark__ui__enabled="false",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    path, clicks = archive(spark, tables)
    patterns = timed(lambda: run_hour_patterns(read_archive(spark, path),
                                               scratch_dir(spark, "bench-patterns"), F.lit(RUN_EPOCH)))
    queries = {"archive_patterns_job": patterns}
    every = catalog()
    for name in HEADLINE:
        queries[name] = timed(lambda: every[name](spark, tables).write.format("noop")
                              .mode("overwrite").save())
    print(json.dumps({
        "metric": "headline queries, total time",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "sf": os.path.basename(tables.rstrip("/")).removeprefix("sf"),
        "archive_clicks": clicks,
        "archive_clicks_per_sec": round(clicks / patterns),
        "cores": int(cpus),
        "spark": spark.version,
    }))


if __name__ == "__main__":
    main()
