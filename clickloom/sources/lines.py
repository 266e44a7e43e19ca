"""Click lines, from an archive folder or a stream, and how they become rows.

Lines are a DataFrame with one string column, ``event``. The functions here serve batch
and streaming alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.operators.filters import keep_click_lines
from clickloom.operators.reshape import strip_spaces
from clickloom.schema import CLICK, click_fields


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """All lines of a folder of text files (plain or compressed)."""
    return spark.read.text(path).withColumnRenamed("value", "event")


def click_lines(lines: DataFrame, clean: bool = False) -> DataFrame:
    """The click lines only; ``clean`` also removes every space, as the archive job does."""
    lines = keep_click_lines(lines)
    return strip_spaces(lines) if clean else lines


def parse_clicks(lines: DataFrame, *fields: str) -> DataFrame:
    """Lines as typed rows; a malformed line keeps its text in ``_corrupt_record``.

    Other columns of ``lines`` stay.

    Name the ``fields`` a query uses: the parser then skips all others. The mode is given
    although it is the default, because only then does one row get parsed once and not
    once per field.
    """
    schema = click_fields(*fields) if fields else CLICK
    event = F.from_json("event", schema, {"mode": "PERMISSIVE"}).alias("click")
    others = [name for name in lines.columns if name != "event"]
    return lines.select(*others, event).select(*others, "click.*")


def read_events(spark: SparkSession, path: str, *fields: str, clean: bool = False) -> DataFrame:
    """The archive's clicks as rows."""
    return parse_clicks(click_lines(read_archive(spark, path), clean), *fields)


def register_events(events: DataFrame, name: str) -> DataFrame:
    """Name the rows for SQL text."""
    events.createOrReplaceTempView(name)
    return events
