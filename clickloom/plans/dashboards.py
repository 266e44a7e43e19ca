"""Dashboard panels over the documents (live) and the hour patterns (batch)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickloom.functions.clock import bucket_date, bucket_time, time_bucket
from clickloom.functions.geo import coarser_cell, geo_cell, geohash_of_cell
from clickloom.operators.filters import with_values
from clickloom.operators.topk import top

TIMEZONE_BARS = 20
DOMAIN_BARS = 50
HOURS = [f"{hour:02d}" for hour in range(24)]


def _share(docs: DataFrame, field: str) -> DataFrame:
    return with_values(docs, field).groupBy(field).agg(F.count(F.lit(1)).alias("clicks"))


def docs_per_minute(docs: DataFrame) -> DataFrame:
    """Histogram of documents by minute of their time."""
    counted = (
        with_values(docs, "t").groupBy(time_bucket("t", "minute").alias("bucket"))
        .agg(F.count(F.lit(1)).alias("clicks"))
    )
    minute = F.concat_ws(" ", bucket_date("bucket", "minute"), bucket_time("bucket", "minute"))
    return counted.select(minute.alias("minute"), "clicks")


def period_total(docs: DataFrame, start: int, end: int) -> DataFrame:
    """Clicks from epoch ``start`` up to but not including ``end``."""
    inside = (F.col("t") >= start) & (F.col("t") < end)
    return docs.where(inside).agg(F.count(F.lit(1)).alias("clicks"))


def method_share(docs: DataFrame) -> DataFrame:
    """Clicks per shortener and their share of all; the total is summed over the groups."""
    methods = _share(docs, "short_url_cname")
    total = methods.select(F.sum("clicks")).scalar()
    return methods.withColumn("share", F.col("clicks").cast("double") / total)


def top_timezones(docs: DataFrame, n: int = TIMEZONE_BARS) -> DataFrame:
    return top(_share(docs, "timezone"), "timezone", n)


def top_document_domains(docs: DataFrame, n: int = DOMAIN_BARS) -> DataFrame:
    return top(_share(docs, "domain"), "domain", n)


def geo_heatmap(docs: DataFrame, precision: int = 5) -> DataFrame:
    """Clicks per geohash cell. Groups by grid numbers and names only the cells found."""
    lon, lat = F.get("location", F.lit(0)), F.get("location", F.lit(1))
    row, column = geo_cell(lat, lon, precision)
    counted = (
        docs.where(lat.isNotNull() & lon.isNotNull())
        .groupBy(row.alias("row"), column.alias("column"))
        .agg(F.count(F.lit(1)).alias("clicks"))
    )
    cell = geohash_of_cell(F.col("row"), F.col("column"), precision)
    return counted.select(cell.alias("cell"), "clicks")


def geo_pyramid(docs: DataFrame, precisions: range = range(1, 8)) -> DataFrame:
    """Clicks per geohash cell at every zoom: ``precision, cell, clicks``.

    Clicks are counted once, by cells of the finest precision; a coarser cell's numbers are the leading bits of a finer one's, so
    grouping sets over shifted numbers make all levels from those counts, in one pass.
    """
    finest = max(precisions)
    lon, lat = F.get("location", F.lit(0)), F.get("location", F.lit(1))
    row, column = geo_cell(lat, lon, finest)
    counted = (docs.where(lat.isNotNull() & lon.isNotNull()).groupBy(row.alias("row"), column.alias("column"))
               .agg(F.count(F.lit(1)).alias("clicks")))
    levels = {}
    for p in precisions:
        coarse_row, coarse_column = coarser_cell(F.col("row"), F.col("column"), finest, p)
        levels |= {f"row{p}": coarse_row, f"column{p}": coarse_column}
    wide = counted.select("clicks", *[value.alias(name) for name, value in levels.items()])
    pairs = [[F.col(f"row{p}"), F.col(f"column{p}")] for p in precisions]
    sums = wide.groupingSets(pairs, *[F.col(name) for name in levels]).agg(F.sum("clicks").alias("clicks"))
    # a row has numbers of its own level only
    level = F.coalesce(*[F.when(F.col(f"row{p}").isNotNull(), F.lit(p)) for p in precisions])
    cell = F.coalesce(*[F.when(F.col(f"row{p}").isNotNull(), geohash_of_cell(F.col(f"row{p}"), F.col(f"column{p}"), p))
                        for p in precisions])
    return sums.select(level.alias("precision"), cell.alias("cell"), "clicks")


def known_vs_new(docs: DataFrame) -> DataFrame:
    """Clicks of known (1) and new (0) browsers; not every click says which."""
    return _share(docs, "known_user")


def batch_histogram(hours: DataFrame) -> DataFrame:
    """The hour pattern in order of the day; clicks without a time have no bar."""
    return with_values(hours, "hour").select("hour", "counter").orderBy("hour")


def batch_total(hours: DataFrame) -> DataFrame:
    return hours.agg(F.sum("counter").alias("clicks"))


def tz_lines(tz_hours: DataFrame) -> DataFrame:
    """One row per time zone with a column per hour. The hours are given, so no extra job."""
    table = tz_hours.groupBy("timezone").pivot("hour", HOURS).agg(F.sum("counter"))
    return table.select("timezone", *[F.coalesce(F.col(hour), F.lit(0)).alias(f"h{hour}")
                                      for hour in HOURS])


def tz_peak_hour(tz_hours: DataFrame) -> DataFrame:
    """The hour with most clicks in each time zone; the earlier one on a tie."""
    rank = F.struct("counter", (-F.col("hour").cast("int")).alias("early"))
    best = with_values(tz_hours, "hour").groupBy("timezone").agg(
        F.max_by(F.struct("hour", "counter"), rank).alias("best"))
    return best.select("timezone", "best.hour", "best.counter")
