"""All live tables from one pass over the feed.

Each batch is read and parsed once, into a stored piece of the archive; everything else is made from that: the cube of clicks
per second, country and domain, the nine count tables from the cube, raw lines and ids. One commit puts all of it in
force. Counts are sums over batches, so there is no state, no watermark and no late click: a click counts in its second
whenever it comes. A batch that is repeated is either in force already or replaces its own parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom.operators.counts import roll_up
from clickloom.operators.dedup import distinct_ids, distinct_lines
from clickloom.operators.reshape import click_ids, raw_by_day
from clickloom.plans.jobs import second_cube, stored
from clickloom.schema import COUNT_KEYS, UNITS, count_table
from clickloom.session import remove_folder
from clickloom.sinks.store import FANOUT, TableStore
from clickloom.sources.lines import click_lines, parse_clicks
from clickloom.streaming.run import start_batches

LIVE_COUNTS = [count_table(subject, unit) for subject in COUNT_KEYS for unit in UNITS]


def batch_tables(lines: DataFrame) -> dict[str, DataFrame]:
    """What some lines add to every table. ``lines`` is read for the cube, for raw lines and for ids."""
    events = parse_clicks(click_lines(lines), "_id", "t", "c", "u")
    cube = stored(second_cube(events), "batch-cube")
    tables = {"raw_clicks": distinct_lines(raw_by_day(lines)), "click_ids": distinct_ids(click_ids(events))}
    for subject, keys in COUNT_KEYS.items():
        finer = cube.dropna(subset=keys).groupBy("date", *keys, "time").agg(F.sum("clicks").alias("clicks"))
        for unit in UNITS:
            tables[count_table(subject, unit)] = finer if unit == "second" else roll_up(finer, unit)
    return tables


def start_tables(spark: SparkSession, lines: DataFrame, root: str, checkpoint: str, every: str | None = None,
                 fanout: int = FANOUT) -> StreamingQuery:
    """Nine count tables, raw lines and ids below ``root``, by one query that reads the feed once."""
    store = TableStore(spark, root, fanout)

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch_id <= store.state().batch:
            return
        place = f"{root}/arrived/{batch_id:015d}"
        batch.select("event").write.mode("overwrite").option("compression", "zstd").parquet(place)
        store.commit(batch_id, batch_tables(spark.read.schema("event string").parquet(place)))
        remove_folder(spark, place)  # the raw lines are in the store now
        store.clean()

    return start_batches(lines, write, checkpoint, every)
