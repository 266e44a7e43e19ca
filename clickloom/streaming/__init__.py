"""The same click queries over a live feed, with Structured Streaming."""

from clickloom.streaming.counts import read_counts, read_live, windowed_counts
from clickloom.streaming.dedup import ids_once
from clickloom.streaming.feed import kafka_feed, line_feed, odd_clicks, timed_clicks
from clickloom.streaming.pipeline import close_days, start_counts, start_documents
from clickloom.streaming.run import append_files, append_live, run_for, start_batches
from clickloom.streaming.tables import batch_tables, start_tables

__all__ = [
    "append_files", "append_live", "batch_tables", "close_days", "kafka_feed", "line_feed", "ids_once",
    "odd_clicks", "read_counts", "read_live", "run_for", "start_counts", "start_batches", "start_documents",
    "start_tables", "timed_clicks", "windowed_counts",
]
