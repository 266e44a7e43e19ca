"""Filters, reshaping, counts, dedup and top-k on click rows."""

from clickloom.operators.counts import (
    count_by, count_table_of, day_hour_counts, hour_counts, hour_cube, roll_up, tz_hour_counts,
)
from clickloom.operators.dedup import distinct_ids, distinct_lines, lines_per_day
from clickloom.operators.filters import (
    drop_empty_lines, exclude_value, keep_click_lines, with_values,
)
from clickloom.operators.reshape import (
    click_ids, drop_coordinates, enrich_documents, export_lines, full_events, panel_rows, raw_by_day,
    rename_fields, strip_spaces, to_documents,
)
from clickloom.operators.topk import rank_per_day, top

__all__ = [
    "click_ids", "count_by", "count_table_of", "day_hour_counts", "distinct_ids",
    "distinct_lines", "drop_coordinates", "drop_empty_lines", "enrich_documents",
    "exclude_value", "export_lines", "full_events", "hour_counts", "hour_cube",
    "keep_click_lines", "lines_per_day", "panel_rows", "rank_per_day", "raw_by_day", "rename_fields",
    "roll_up", "strip_spaces", "to_documents", "top", "tz_hour_counts", "with_values",
]
