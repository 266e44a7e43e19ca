"""Serving tables and documents on storage."""

from clickloom.sinks.documents import write_documents, write_json, write_lines
from clickloom.sinks.store import TableStore
from clickloom.sinks.tables import (
    catalogue, create_tables, register_tables, write_click_ids, write_full_events, write_raw_clicks, write_table,
)

__all__ = [
    "TableStore", "catalogue", "create_tables", "register_tables", "write_click_ids", "write_documents", "write_full_events", "write_json",
    "write_lines", "write_raw_clicks", "write_table",
]
