"""Tables that a stream adds to in batches, all at once, and that stay small to read.

A batch adds one part (a folder) per table. The parts that make up the tables are listed in a manifest, one file per
batch; a batch is in force when its manifest is there, for all tables at the same moment. So

- a batch that is repeated after its manifest was written changes nothing;
- a batch that stopped between its parts and its manifest is written again over the same folders;
- a reader sees whole batches only, and keeps reading the parts it started with.

Parts of one day are merged when ``fanout`` of a level have come together, into one part of the next level: a day has
fewer than ``fanout`` parts per level, and a row is rewritten once per level, so with n batches both are about the logarithm
of n. Only the days that a batch touches are looked at. Parts that no newer manifest names are removed later.
"""

from __future__ import annotations

import json
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple
from urllib.parse import unquote

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.schema import SERVING_TABLES
from clickloom.session import folder_bytes, folder_names, read_file, remove_folder, write_file

#: Parts of one day and level that are merged.
FANOUT = 8
#: Tables that are written at the same time.
AT_ONCE = 4
#: Bytes of a file that merging makes, about.
FILE_BYTES = 64 << 20
#: Manifests whose parts are kept for readers that are still at them.
KEPT = 2


class Part(NamedTuple):
    """A folder with rows of one day; ``folder`` is below the table's, ``day`` the name of the folder in it."""

    table: str
    day: str
    level: int
    folder: str


class State(NamedTuple):
    """The last batch in force (-1 before the first) and the parts of all tables."""

    batch: int
    parts: list[Part]


def merged(rows: DataFrame) -> DataFrame:
    """Rows of several parts as one table: clicks added up by key, other rows once."""
    keys = [name for name in rows.columns if name != "clicks"]
    if "clicks" not in rows.columns:
        return rows.distinct()
    return rows.groupBy(*keys).agg(F.sum("clicks").alias("clicks"))


class TableStore:
    """Serving tables below one folder that change together. One writer; any number of readers."""

    def __init__(self, spark: SparkSession, root: str, fanout: int = FANOUT):
        self.spark, self.root, self.fanout = spark, root, fanout

    def _manifests(self) -> list[str]:
        names = folder_names(self.spark, f"{self.root}/manifest")
        return sorted(name for name in names if name.endswith(".json"))

    def _load(self, name: str) -> State:
        found = json.loads(read_file(self.spark, f"{self.root}/manifest/{name}"))
        return State(found["batch"], [Part(*part) for part in found["parts"]])

    def state(self) -> State:
        names = self._manifests()
        return self._load(names[-1]) if names else State(-1, [])

    def _switch(self, state: State) -> None:
        """Put a batch in force: its manifest appears as a whole or not at all."""
        write_file(self.spark, f"{self.root}/manifest/{state.batch:015d}.json", json.dumps(state._asdict()))

    def _write(self, rows: DataFrame, table: str, folder: str, level: int) -> list[Part]:
        """One part per day found in the rows; ``date`` stays a column, so that parts can be read one by one."""
        return self._put(rows.withColumn("day", F.col("date")).hint("rebalance", "day"), table, folder, level)

    def _merge(self, parts: list[Part], table: str, folder: str, level: int) -> list[Part]:
        """Parts as one, by a single shuffle: a day is dealt into as many files as its bytes ask for, a key's rows to one.

        A key has one row in each part at most, so there is nothing to combine before the shuffle and no key weighs more than
        another.
        """
        rows, days = self._read(table, parts), defaultdict(int)
        for part in parts:
            days[part.day] += folder_bytes(self.spark, f"{self.root}/parts/{table}/{part.folder}/{part.day}")
        keys = [name for name in rows.columns if name != "clicks"]
        slot = F.pmod(F.xxhash64(*keys), F.lit(-(-max(days.values()) // FILE_BYTES) or 1))
        dealt = rows.select("*", F.col("date").alias("day"), slot.alias("slot")).repartition("day", "slot")
        return self._put(merged(dealt).drop("slot"), table, folder, level)

    def _put(self, rows: DataFrame, table: str, folder: str, level: int) -> list[Part]:
        """Rows with their ``day``, dealt out as the files are to be."""
        place = f"{self.root}/parts/{table}/{folder}"
        keys = [name for name in rows.columns if name not in ("date", "clicks", "day")]
        rows.sortWithinPartitions("day", *keys).write.mode("overwrite").partitionBy("day").parquet(place)
        days = [name for name in folder_names(self.spark, place) if name.startswith("day=")]
        return [Part(table, day, level, folder) for day in sorted(days)]

    def _read(self, table: str, parts: list[Part]) -> DataFrame:
        schema = SERVING_TABLES[table]
        if not parts:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.root}/parts/{table}/{part.folder}/{part.day}" for part in parts]
        return self.spark.read.schema(schema).parquet(*paths)

    def _compacted(self, batch: int, table: str, parts: list[Part], fresh: list[Part]) -> list[Part]:
        """The table's parts after merging what the fresh ones have made full."""
        level = 0
        while fresh:
            touched, by_day = {part.day for part in fresh}, defaultdict(list)
            for part in parts:
                if part.level == level and part.day in touched:
                    by_day[part.day].append(part)
            full = [part for same in by_day.values() if len(same) >= self.fanout for part in same]
            if not full:
                break
            level += 1
            fresh = self._merge(full, table, f"{batch:015d}-{level}", level)
            parts = [part for part in parts if part not in full] + fresh
        return parts

    def commit(self, batch: int, tables: dict[str, DataFrame]) -> bool:
        """Add a batch's rows to the tables; False if it is in force already."""
        state = self.state()
        if batch <= state.batch:
            return False

        def add(table: str) -> list[Part]:
            mine = [part for part in state.parts if part.table == table]
            fresh = self._write(tables[table].select(*self._names(table)), table, f"{batch:015d}-0", 0)
            return self._compacted(batch, table, mine + fresh, fresh)

        # a batch's tables are small: several at a time fill the cluster
        with ThreadPoolExecutor(AT_ONCE) as pool:
            parts = [part for same in pool.map(inheritable_thread_target(self.spark)(add), tables) for part in same]
        parts += [part for part in state.parts if part.table not in tables]
        self._switch(State(batch, parts))
        return True

    @staticmethod
    def _names(table: str) -> list[str]:
        return [column.split()[0] for column in SERVING_TABLES[table].split(", ")]

    def read(self, table: str, *days: str) -> DataFrame:
        """The rows of a table, or of some of its days: other days' files are not even listed."""
        wanted = [part for part in self.state().parts
                  if part.table == table and (not days or self._day(part) in days)]
        return merged(self._read(table, wanted))

    @staticmethod
    def _day(part: Part) -> str:
        return unquote(part.day.removeprefix("day="))

    def days(self, table: str) -> list[str]:
        """The days that a table has rows for, from the manifest alone."""
        return sorted({self._day(part) for part in self.state().parts if part.table == table})

    def latest_day(self, table: str) -> str | None:
        """The newest day of a table, without reading a row."""
        return max((day for day in self.days(table) if day != "N/A"), default=None)

    def parts_per_day(self, table: str) -> int:
        """The most parts that any day of a table has."""
        counts: dict[str, int] = defaultdict(int)
        for part in self.state().parts:
            counts[part.day] += part.table == table
        return max(counts.values(), default=0)

    def clean(self, kept: int = KEPT) -> int:
        """Remove older manifests, and parts that only they name; returns how many folders went."""
        names = self._manifests()
        if not names:
            return 0
        states = [self._load(name) for name in names[-kept:]]
        used = {(part.table, part.folder) for state in states for part in state.parts}
        gone = 0
        for table in folder_names(self.spark, f"{self.root}/parts"):
            for folder in folder_names(self.spark, f"{self.root}/parts/{table}"):
                # parts newer than the last manifest belong to a batch that is being written
                if (table, folder) not in used and int(folder.split("-")[0]) <= states[-1].batch:
                    remove_folder(self.spark, f"{self.root}/parts/{table}/{folder}")
                    gone += 1
        for name in names[:-kept]:
            remove_folder(self.spark, f"{self.root}/manifest/{name}")
        return gone
