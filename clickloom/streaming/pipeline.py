"""The two live jobs: counts with raw lines, and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom.operators.counts import KEY_FIELDS
from clickloom.operators.filters import drop_empty_lines
from clickloom.operators.reshape import enrich_documents, raw_by_day
from clickloom.plans.jobs import build_serving
from clickloom.schema import COUNT_KEYS, count_table
from clickloom.session import remove_folder
from clickloom.sinks.documents import with_day
from clickloom.sources.lines import click_lines, parse_clicks
from clickloom.streaming.counts import windowed_counts
from clickloom.streaming.dedup import ids_once
from clickloom.streaming.feed import odd_clicks, timed_clicks
from clickloom.streaming.run import append_files, append_live

LIVE_UNITS = ["second", "minute"]
LIVE_TABLES = [count_table(subject, unit) for subject in COUNT_KEYS for unit in LIVE_UNITS]
# The batch intervals of the two jobs.
COUNT_INTERVAL = "10 seconds"
DOCUMENT_INTERVAL = "5 seconds"


def start_counts(lines: DataFrame, root: str, checkpoints: str, delay: str = "10 minutes",
                 every: str | None = COUNT_INTERVAL) -> dict[str, StreamingQuery]:
    """Six live count tables, the raw lines, the odd ones and the ids, each its own query.

    Separate queries keep their own state and checkpoint, so one can fail, restart or be
    rebuilt without the others. Event-time windows give the same sums whatever the batch
    interval is.
    """
    queries = {}
    for subject, keys in COUNT_KEYS.items():
        for unit in LIVE_UNITS:
            table = count_table(subject, unit)
            clicks = timed_clicks(lines, delay, *[KEY_FIELDS[key] for key in keys])
            counts = windowed_counts(clicks, keys, unit)
            queries[table] = append_live(counts, f"{root}/{table}", f"{checkpoints}/{table}", every)
    raw = raw_by_day(lines)
    queries["raw_clicks"] = append_files(raw, f"{root}/raw_clicks", f"{checkpoints}/raw_clicks", every)
    queries["odd_clicks"] = append_files(odd_clicks(lines), f"{root}/odd_clicks", f"{checkpoints}/odd_clicks", every)
    ids = ids_once(timed_clicks(lines, delay, "_id"))
    queries["click_ids"] = append_files(ids, f"{root}/click_ids", f"{checkpoints}/click_ids", every)
    return queries


def start_documents(lines: DataFrame, path: str, checkpoint: str,
                    every: str | None = DOCUMENT_INTERVAL, lang: str = "en") -> StreamingQuery:
    """Enriched documents as JSON lines. No state: a projection and a small broadcast join."""
    events = parse_clicks(click_lines(drop_empty_lines(lines.select("event"))))
    return append_files(with_day(enrich_documents(events, lang)), path, checkpoint, every, "json")


def close_days(spark: SparkSession, live: str, root: str, days: list[str]) -> None:
    """Recount days from their stored raw lines into all serving tables, then remove their live counts.

    The raw lines hold every click of a day however late it came, so the serving rows are exact:
    no click is lost to the watermark, no line or id is there twice. Closing a day again after more
    lines have come replaces its rows by the same rules.
    """
    stored = spark.read.schema("event string, date string").parquet(f"{live}/raw_clicks")
    build_serving(stored.where(F.col("date").isin(days)).select("event"), root)
    for table in LIVE_TABLES:
        for day in days:
            remove_folder(spark, f"{live}/{table}/date={day}")
