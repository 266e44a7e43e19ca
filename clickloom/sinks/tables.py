"""Serving tables: Parquet, one folder per day, one row per key.

Every write replaces the days it has rows for and leaves the others, so a job that runs
again, or runs twice, leaves the same table.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from clickloom.operators.dedup import distinct_ids, distinct_lines
from clickloom.schema import SERVING_TABLES


#: Columns by whose single values tables are read: row groups carry a Bloom filter of them.
POINT_KEYS = {"domain"}


def register_tables(spark: SparkSession, database: str, root: str, tables: Iterable[str] = SERVING_TABLES) -> None:
    """Written tables below ``root`` as tables of a database: each day's folder a partition, with sizes for the optimizer.

    Registering again finds the days written since.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table in tables:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{table} ({SERVING_TABLES[table]}) USING parquet "
                  f"PARTITIONED BY (date) LOCATION '{root}/{table}'")
        spark.sql(f"ALTER TABLE {database}.{table} RECOVER PARTITIONS")
        spark.sql(f"ANALYZE TABLE {database}.{table} COMPUTE STATISTICS")


def catalogue(spark: SparkSession, database: str, tables: Iterable[str] = SERVING_TABLES) -> DataFrame:
    """``table, partitions, rows`` of registered tables, counted by reading through the database."""
    parts = [spark.table(f"{database}.{table}").agg(
        F.lit(table).alias("table"), F.count_distinct("date").alias("partitions"), F.count(F.lit(1)).alias("rows"))
        for table in tables]
    return reduce(DataFrame.unionByName, parts)


def create_tables(spark: SparkSession, database: str, location: str | None = None,
                  reset: bool = False) -> None:
    """Create the serving tables in a database; ``reset`` drops what was there before."""
    if reset:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
    for table, columns in SERVING_TABLES.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{table} ({columns}) "
                  "USING parquet PARTITIONED BY (date)")


def write_table(rows: DataFrame, path: str, sort: list[str] | None = None) -> None:
    """Replace the days found in ``rows``.

    ``rebalance`` sizes the files: AQE cuts a day that is too large for one task into
    several and puts small days together. Sorting by the key narrows the range each Parquet
    row group covers, which is what a read of one domain skips by.
    """
    keys = sort or [name for name in rows.columns if name not in ("date", "clicks")]
    writer = (
        rows.hint("rebalance", "date")
        .sortWithinPartitions("date", *keys)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    )
    for name in POINT_KEYS.intersection(rows.columns):
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
    writer.partitionBy("date").parquet(path)


def write_raw_clicks(raw_clicks: DataFrame, path: str) -> None:
    """Raw lines under their day, each once."""
    write_table(distinct_lines(raw_clicks), path)


def write_click_ids(ids: DataFrame, path: str) -> None:
    """Ids under their day, each once."""
    write_table(distinct_ids(ids), path)


def write_full_events(events: DataFrame, path: str) -> None:
    """Wide events, one per day and id: of several, the one with the greatest fields.

    Clicks without an id cannot be told apart and are all kept.
    """
    fields = [name for name in events.columns if name not in ("date", "id")]
    # a click without an id gets a number of its own, so one pass and one shuffle serve both kinds; of several
    # with one id a map task sends only its greatest
    alone = F.when(F.col("id").isNull(), F.monotonically_increasing_id())
    order = Window.partitionBy("date", "id", "_alone").orderBy(*[F.desc_nulls_last(name) for name in fields])
    rows = events.withColumn("_alone", alone).withColumn("_nth", F.row_number().over(order)).where("_nth = 1")
    write_table(rows.drop("_alone", "_nth"), path, ["id"])
