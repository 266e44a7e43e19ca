"""Totals of any period from stored running sums: a boundary costs two look-ups, whatever the period's length.

Three levels: blocks of ``BLOCK`` days, days within a block, minutes within a day. Running sums are made within a block and within
a day only, so no window spans all rows; what lies before a block is a sum over one number per block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from clickloom.functions.clock import SECONDS, time_bucket

#: Days of a block.
BLOCK = 512
_MINUTES = SECONDS["day"] // 60


def _running(rows: DataFrame, whole: str, part: str, name: str) -> DataFrame:
    """Per ``whole`` its parts with the clicks up to and with each, in order; a bounded number of parts."""
    order = Window.partitionBy(whole).orderBy(part).rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.select(whole, F.struct(F.col(part).alias("at"), F.sum("clicks").over(order).alias("upto")).alias("x"))
    return summed.groupBy(whole).agg(F.sort_array(F.collect_list("x")).alias(name))


def write_running_sums(events: DataFrame, root: str) -> None:
    """Running sums of the clicks that have a time, below ``root``: one pass over the clicks, the rest from its counts."""
    spark = events.sparkSession
    counted = (events.where(F.col("t").isNotNull()).groupBy(time_bucket("t", "minute").alias("bucket"))
               .agg(F.count(F.lit(1)).alias("clicks")))
    placed = counted.select(F.floor(F.col("bucket") / _MINUTES).alias("day"),
                            F.pmod("bucket", F.lit(_MINUTES)).cast("int").alias("minute"), "clicks")
    _running(placed, "day", "minute", "minutes").write.mode("overwrite").parquet(f"{root}/days")
    days = spark.read.parquet(f"{root}/days")
    totals = days.select(F.floor(F.col("day") / BLOCK).alias("block"), "day",
                         F.element_at("minutes", -1)["upto"].alias("clicks"))
    _running(totals, "block", "day", "days").write.mode("overwrite").parquet(f"{root}/blocks")


def _before(sums: Column, at: Column) -> Column:
    """The running sum of the last part before ``at``."""
    return F.coalesce(F.array_max(F.transform(F.filter(sums, lambda x: x["at"] < at), lambda x: x["upto"])), F.lit(0))


def _clicks_before(spark: SparkSession, root: str, rows: DataFrame, epoch: str, name: str) -> DataFrame:
    """``rows`` with the clicks before the minute of ``epoch`` as the column ``name``."""
    days, blocks = spark.read.parquet(f"{root}/days"), spark.read.parquet(f"{root}/blocks")
    sizes = blocks.select("block", F.element_at("days", -1)["upto"].alias("clicks"))
    # one number per block of days: some seventy in a century
    known = [(r["block"], r["clicks"]) for r in sizes.collect()]
    earlier = F.array(*[F.struct(F.lit(b).alias("block"), F.lit(n).alias("clicks")) for b, n in known]) if known else None
    day = F.floor(F.col(epoch) / SECONDS["day"])
    rows = rows.withColumns({"_day": day, "_block": F.floor(day / BLOCK),
                             "_minute": F.floor(F.pmod(F.col(epoch), F.lit(SECONDS["day"])) / 60).cast("int")})
    found = (rows.join(days.withColumnRenamed("day", "_day"), "_day", "left")
             .join(blocks.withColumnRenamed("block", "_block"), "_block", "left"))
    total = _before(F.col("minutes"), F.col("_minute")) + _before(F.col("days"), F.col("_day"))
    if earlier is not None:
        total = total + F.aggregate(F.filter(earlier, lambda b: b["block"] < F.col("_block")), F.lit(0).cast("bigint"),
                                    lambda s, b: s + b["clicks"])
    return found.withColumn(name, total).drop("_day", "_block", "_minute", "minutes", "days")


def period_totals(spark: SparkSession, root: str, periods: DataFrame) -> DataFrame:
    """``periods`` (with ``start`` and ``end``, epochs at whole minutes, the end not included) and their ``clicks``."""
    rows = _clicks_before(spark, root, periods, "start", "_from")
    rows = _clicks_before(spark, root, rows, "end", "_to")
    return rows.withColumn("clicks", F.greatest(F.col("_to") - F.col("_from"), F.lit(0))).drop("_from", "_to")
