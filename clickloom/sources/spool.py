"""A spool of click lines as a streaming source: files of newline JSON that writers go on appending to.

An offset is how many bytes of each file have been read, always up to the end of a line: a last line that is still being
written is left for a later batch. Offsets are in the query's checkpoint, so a query that is stopped, fails or is started
anew goes on at the byte where its last finished batch ended; no line is lost or read twice. A batch is cut into ranges of
bytes, also within one file; a line belongs to the range it begins in. Files that have been removed drop out of the offsets, so
they are as many as the spool keeps.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from clickloom.streaming.feed import SALTS

#: Bytes of a range, and of one read.
RANGE_BYTES, BLOCK_BYTES = 64 << 20, 1 << 20


def _files(path: str) -> tuple[fs.FileSystem, str]:
    system, base = fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else path.replace("file:", "", 1))
    return system, base


def _whole(file, size: int) -> int:
    """Bytes of a file up to the end of its last complete line."""
    end = size
    while end > 0:
        start = max(0, end - BLOCK_BYTES)
        file.seek(start)
        at = file.read(end - start).rfind(b"\n")
        if at >= 0:
            return start + at + 1
        end = start
    return 0


class Range(InputPartition):
    """Bytes ``start`` to ``end`` of one file; ``end`` is the end of a line, ``first`` where the batch began."""

    def __init__(self, path: str, name: str, first: int, start: int, end: int, last: int):
        self.path, self.name, self.first, self.start, self.end, self.last = path, name, first, start, end, last


class SpoolReader(DataSourceStreamReader):
    def __init__(self, path: str, range_bytes: int = RANGE_BYTES):
        self.path, self.range_bytes = path, range_bytes

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        system, base = _files(self.path)
        found = {}
        for info in system.get_file_info(fs.FileSelector(base, allow_not_found=True)):
            # like Spark's own file sources: hidden and marker files are not data
            if info.type == fs.FileType.File and not info.base_name.startswith((".", "_")):
                with system.open_input_file(info.path) as file:
                    found[info.base_name] = _whole(file, info.size)
        return dict(sorted(found.items()))

    def partitions(self, start: dict, end: dict) -> list[Range]:
        ranges = []
        for name, last in end.items():
            first = start.get(name, 0)
            ranges += [Range(self.path, name, first, at, min(at + self.range_bytes, last), last)
                       for at in range(first, last, self.range_bytes)]
        return ranges

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        system, base = _files(partition.path)
        with system.open_input_file(f"{base}/{partition.name}") as file:
            at = partition.start
            if at > partition.first:
                at = self._next_line(file, at - 1, partition.last)  # a line begun before belongs to the range before
            while at < partition.end:
                # up to the end of the line that holds the block's last byte
                stop = self._next_line(file, min(at + BLOCK_BYTES, partition.end) - 1, partition.last)
                file.seek(at)
                yield self._rows(partition.name, at, file.read(stop - at))
                at = stop

    @staticmethod
    def _next_line(file, at: int, last: int) -> int:
        """Where the line after the one with byte ``at`` begins."""
        while at < last:
            file.seek(at)
            block = file.read(min(BLOCK_BYTES, last - at))
            found = block.find(b"\n")
            if found >= 0:
                return at + found + 1
            at += len(block)
        return last

    @staticmethod
    def _rows(name: str, at: int, block: bytes) -> pa.RecordBatch:
        """The lines of a block that begins and ends with whole lines, each with the place it begins at."""
        lines = block.split(b"\n")[:-1]
        sizes = pc.add(pc.binary_length(pa.array(lines, pa.binary())), 1)
        places = pc.add(pc.subtract(pc.cumulative_sum(sizes.cast(pa.int64())), sizes.cast(pa.int64())), at)
        texts = pa.array([line.removesuffix(b"\r").decode("utf-8", "replace") for line in lines], pa.string())
        return pa.RecordBatch.from_arrays([texts, pa.array([name] * len(lines), pa.string()), places], ["event", "file", "at"])


class SpoolSource(DataSource):
    """``spark.readStream.format("click_spool").load(folder)``: event, file and the byte a line begins at."""

    @classmethod
    def name(cls) -> str:
        return "click_spool"

    def schema(self) -> str:
        return "event string, file string, at bigint"

    def streamReader(self, schema) -> SpoolReader:
        return SpoolReader(self.options["path"], int(self.options.get("rangebytes", RANGE_BYTES)))


def spool_feed(spark: SparkSession, path: str, range_bytes: int | None = None) -> DataFrame:
    """Lines of a spool as a live feed: ``event, salt``, the salt from a line's place."""
    spark.dataSource.register(SpoolSource)
    reader = spark.readStream.format("click_spool")
    if range_bytes:
        reader = reader.option("rangeBytes", range_bytes)
    salt = F.pmod(F.hash("file", "at"), F.lit(SALTS)).alias("salt")
    return reader.load(path).select("event", salt)
