"""Each click once."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickloom.functions.clock import epoch_unit


def ids_once(clicks: DataFrame) -> DataFrame:
    """Day and id of every click, once per day and id within the watermark.

    Copies are dropped in two steps: first per ``salt`` too, which spreads the copies of one
    id over as many tasks as there are salts, then among the few that are left. Copies whose
    times lie further apart than the watermark's delay fall to the table's next rewrite.
    """
    ids = clicks.select("event_time", "salt", epoch_unit("t", "day").alias("date"),
                        F.col("_id").alias("id"))
    spread = ids.dropDuplicatesWithinWatermark(["date", "id", "salt"])
    return spread.dropDuplicatesWithinWatermark(["date", "id"]).select("date", "id")
