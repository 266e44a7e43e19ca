"""Reads of the serving tables. They are partitioned by ``date``, so a day is a folder."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom.functions.clock import MISSING, today_unit
from clickloom.schema import SERVING_TABLES
from clickloom.session import folder_names


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A serving table below ``root``; the known schema saves reading footers for it."""
    return spark.read.schema(SERVING_TABLES[table]).parquet(f"{root}/{table}")


def latest_day(table: DataFrame) -> Column:
    """The newest day of a table, as a scalar subquery."""
    days = table.where(F.col("date") != "N/A") if "date" in table.columns else table
    return days.select(F.max("date")).scalar()


def stored_days(spark: SparkSession, root: str, table: str) -> list[str]:
    """The days a serving table has folders for, from a listing: no file is opened."""
    names = folder_names(spark, f"{root}/{table}")
    return sorted(unquote(name.removeprefix("date=")) for name in names if name.startswith("date="))


def point_read(spark: SparkSession, root: str, table: str, domain: str | Column, day: str | None = None) -> DataFrame:
    """One domain's rows of one stored day, the newest unless given.

    Only the day's folder is listed; within its files, row groups without the domain are passed over by their smallest and
    greatest value and by their Bloom filter.
    """
    if day is None:
        day = max((d for d in stored_days(spark, root, table) if d != MISSING), default=MISSING)
    return read_day(read_table(spark, root, table), day, domain)


def read_day(table: DataFrame, day: str | Column | None = None,
             domain: str | Column | None = None) -> DataFrame:
    """Rows of one day (today in UTC unless given), and of one domain if asked."""
    rows = table.where(F.col("date") == (today_unit("day") if day is None else day))
    return rows if domain is None else rows.where(F.col("domain") == domain)


def first_clicks(raw_clicks: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` raw clicks by day and line."""
    return raw_clicks.select("date", "event").orderBy("date", "event").limit(n)
