"""Where click lines and serving rows come from."""

from clickloom.sources.lines import (
    click_lines, parse_clicks, read_archive, read_events, register_events,
)
from clickloom.sources.serving import first_clicks, latest_day, point_read, read_day, read_table, stored_days

__all__ = [
    "click_lines", "first_clicks", "latest_day", "parse_clicks", "point_read", "read_archive",
    "read_day", "read_events", "read_table", "register_events", "stored_days",
]
