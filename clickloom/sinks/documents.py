"""Documents as JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickloom.functions.clock import MISSING


def write_json(rows: DataFrame, path: str) -> None:
    """One document per row."""
    rows.write.mode("overwrite").json(path)


def write_lines(lines: DataFrame, path: str) -> None:
    """A one-column DataFrame as text."""
    lines.write.mode("overwrite").text(path)


def with_day(documents: DataFrame) -> DataFrame:
    """Add the partition column from the document's time."""
    day = F.coalesce(F.substring("`@timestamp`", 1, 10), F.lit(MISSING))
    return documents.withColumn("date", day)


def write_documents(documents: DataFrame, path: str) -> None:
    """Enriched documents under their day."""
    (
        with_day(documents).hint("rebalance", "date")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("date").json(path)
    )
