"""Row filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Fixed value: the text that marks a line as a click.
CLICK_MARK = '"h":'


def keep_click_lines(lines: DataFrame) -> DataFrame:
    """Lines that carry a user hash key. A text test: it keeps malformed clicks too."""
    return lines.where(F.col("event").contains(CLICK_MARK))


def drop_empty_lines(lines: DataFrame) -> DataFrame:
    return lines.where(F.length("event") > 0)


def with_values(events: DataFrame, *columns: str) -> DataFrame:
    """Rows in which none of the columns is NULL."""
    return events.dropna(subset=list(columns))


def exclude_value(df: DataFrame, column: str, value: str) -> DataFrame:
    """Remove one value; rows where the column is NULL stay."""
    return df.where(~F.col(column).eqNullSafe(value))
