"""Counting 64-bit keys of whole texts with few rows.

Documents belong to shards by their number. A task packs the keys of a shard into sorted arrays of
distinct keys with counts, one per bucket of the key's high bits, so a key costs its shard one
entry however often it occurs, and a row carries hundreds of keys. Buckets add up; what they know
goes back to the shards that asked, and meets the shard's documents there. Both
numbers are chosen from the size of the input, so a bucket and a shard stay at a few MB.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.text import chunks, mix
from clickloom.session import scratch_dir

#: Bytes of text in a shard, about.
SHARD_BYTES = 12_000_000
#: Keys a task packs before it sends them on.
HOLD = 2_000_000

PACKED = "shard int, bucket int, keys binary, counts binary"
PACKED_SCHEMA = pa.schema([("shard", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


@dataclass(frozen=True)
class Layout:
    """How many shards of documents and buckets of keys."""

    shards: int
    buckets: int

    @classmethod
    def of(cls, docs: DataFrame) -> Layout:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shards = max(4, -(-size // SHARD_BYTES))
        return cls(shards, shards)


def sharded(docs: DataFrame, layout: Layout) -> DataFrame:
    """(shard, doc_id, text); the shard follows from number and text, so different texts of one number are spread."""
    doc_id, text = F.col("doc_id").cast("bigint"), F.col("text").cast("string")
    shard = F.pmod(F.xxhash64(doc_id, text), F.lit(layout.shards)).cast("int")
    return docs.select(shard.alias("shard"), doc_id.alias("doc_id"), text.alias("text"))


def stored_by(frame: DataFrame, label: str, column: str, number: int) -> DataFrame:
    """The rows written once, in ``number`` buckets of a column: grouping them by it needs no shuffle."""
    place = scratch_dir(frame.sparkSession, label)
    table = f"{label}_{uuid.uuid5(uuid.NAMESPACE_URL, place).hex}"
    (frame.write.format("parquet").option("compression", "zstd").option("path", place)
     .bucketBy(number, column).saveAsTable(table))
    return frame.sparkSession.table(table)


def stretches(docs: DataFrame, layout: Layout) -> DataFrame:
    """(shard, doc_id, text), written once; a shard is a stretch of rows that one task read, of about ``SHARD_BYTES``.

    A task that reads the rows again meets few shards, so it sends few rows per bucket, however many shards there are; with shards
    by hash (:func:`sharded`) it meets all of them. No text is shuffled, and copies of one row are no shard of their own.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, size = TaskContext.get().partitionId(), 0, 0
        for chunk in chunks(batches):
            shard = int(mix(np.array([task << 32 | number], np.uint64))[0] >> np.uint64(33))
            yield from chunk.add_column(0, "shard", pa.array(np.full(len(chunk), shard, np.int32))).to_batches()
            size += pc.sum(pc.binary_length(chunk["text"])).as_py() or 0
            if size >= SHARD_BYTES:
                number, size = number + 1, 0

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored_by(rows.mapInArrow(run, "shard int, doc_id bigint, text string"), "stretches", "shard", layout.shards)


def add_up(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[begin], np.add.reduceat(counts, begin)


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in the sorted array."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


class Packer:
    """Keys of one task, by shard."""

    def __init__(self, buckets: int, kept: Callable[[np.ndarray], np.ndarray] = lambda counts: counts):
        self.buckets, self.kept = buckets, kept
        self.held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.size = 0

    def add(self, shard: int, keys: np.ndarray, counts: np.ndarray) -> None:
        if len(keys):
            self.held.setdefault(shard, []).append((keys, counts))
            self.size += len(keys)

    def full(self) -> bool:
        """Whether it is time to send; what is held is added up first."""
        if self.size < HOLD:
            return False
        self.fold()
        return self.size > HOLD // 2

    def fold(self) -> None:
        self.held = {s: [add_up(*(np.concatenate(x) for x in zip(*parts)))] for s, parts in self.held.items()}
        self.size = sum(len(p[0][0]) for p in self.held.values())

    def send(self) -> Iterator[pa.RecordBatch]:
        self.fold()
        for shard, [(keys, counts)] in self.held.items():
            bucket = bucket_of(keys, self.buckets)
            at = np.searchsorted(bucket, np.arange(self.buckets + 1))
            some = np.flatnonzero(np.diff(at))
            keys, counts = keys.astype("<u8"), self.kept(counts)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(some), shard, np.int32)), pa.array(some.astype(np.int32)),
                pa.array([keys[at[b]:at[b + 1]].tobytes() for b in some], pa.binary()),
                pa.array([packed_counts(counts[at[b]:at[b + 1]]).tobytes() for b in some], pa.binary()),
            ], ["shard", "bucket", "keys", "counts"])
        self.held, self.size = {}, 0


def packed_counts(counts: np.ndarray) -> np.ndarray:
    """Counts in as few bytes each as the largest needs: 1, 2, 4 or 8."""
    most = int(counts.max(initial=0))
    return counts.astype(next(f"<u{n}" for n in (1, 2, 4, 8) if most < 1 << 8 * n))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of keys, in their order."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def by_shard(table: pa.Table) -> Iterator[tuple[int, pa.Table]]:
    """A chunk's rows, shard by shard."""
    shard = table["shard"].to_numpy()
    order = np.argsort(shard, kind="stable")
    values, begin = np.unique(shard[order], return_index=True)
    for value, rows in zip(values.tolist(), np.split(order, begin[1:])):
        yield value, table.take(pa.array(rows))


def pack(docs: DataFrame, layout: Layout, keys_of: Callable, kept=lambda counts: counts, whole: bool = False) -> DataFrame:
    """Packed keys of sharded documents.

    ``keys_of(texts)``, or of the ``whole`` rows, gives (keys, counts, first key of each text).
    """
    buckets = layout.buckets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(buckets, kept)
        for chunk in chunks(batches):
            keys, counts, first = keys_of(chunk if whole else chunk["text"])
            shard = np.repeat(chunk["shard"].to_numpy(), np.diff(first))
            order = np.argsort(shard, kind="stable")
            values, begin = np.unique(shard[order], return_index=True)
            for value, rows in zip(values.tolist(), np.split(order, begin[1:])):
                packer.add(value, *add_up(keys[rows], counts[rows]))
            if packer.full():
                yield from packer.send()
        yield from packer.send()

    return docs.mapInArrow(run, PACKED)


def unpack(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys and counts of all rows end to end, and the row each belongs to."""
    keys = [np.frombuffer(x, "<u8") for x in table["keys"].to_pylist()]
    counts = [np.frombuffer(x, f"<u{len(x) // max(len(k), 1) or 1}") for k, x in zip(keys, table["counts"].to_pylist())]
    row = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
    return (np.concatenate([*keys, np.zeros(0, "<u8")]), np.concatenate([*[c.astype(np.int64) for c in counts], np.zeros(0, np.int64)]), row)


def answered(packed: DataFrame, wanted: Callable[[np.ndarray], np.ndarray] | None = None,
             known: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """Per shard and bucket its keys with their counts over all shards, those that are ``wanted``.

    ``known`` makes something else of a bucket's distinct keys and their counts, to be sent in place of counts.
    """
    def run(table: pa.Table) -> pa.Table:
        keys, counts, row = unpack(table)
        distinct, total = add_up(keys, counts)
        if known:
            total = known(distinct, total)
        mine = total[np.searchsorted(distinct, keys)]
        shard = table["shard"].to_numpy()[row]
        keep = wanted(mine) if wanted else np.ones(len(keys), bool)
        keys, mine, shard = keys[keep], mine[keep], shard[keep]
        # rows of one shard are put together, each key once
        order = np.lexsort((keys, shard))
        keys, mine, shard = keys[order], mine[order], shard[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (shard[1:] != shard[:-1])
        keys, mine, shard = keys[new].astype("<u8"), mine[new], shard[new]
        values, begin = np.unique(shard, return_index=True)
        bounds = [*begin.tolist(), len(keys)]
        bucket = table["bucket"][0].as_py() if table.num_rows else 0
        return pa.table({
            "shard": pa.array(values.astype(np.int32)),
            "bucket": pa.array(np.full(len(values), bucket, np.int32)),
            "keys": pa.array([keys[a:b].tobytes() for a, b in zip(bounds, bounds[1:])], pa.binary()),
            "counts": pa.array([packed_counts(mine[a:b]).tobytes() for a, b in zip(bounds, bounds[1:])], pa.binary()),
        })

    return packed.groupBy("bucket").applyInArrow(run, PACKED)


def with_answers(docs: DataFrame, answers: DataFrame, layout: Layout, run: Callable, schema: str, *more: DataFrame) -> DataFrame:
    """Run ``run(shard, keys, counts, chunks of the shard's documents)`` for each shard.

    Keys and counts of ``more`` answers follow those of the first.

    Documents and answers are put in one table and dealt out by shard, answers first. Of these a
    task keeps one shard's; documents stream past them.
    """
    kinds = 1 + len(more)
    dealt = docs.select("shard", F.lit(kinds).alias("kind"), "doc_id", "text", F.lit(None).cast("binary").alias("keys"),
                        F.lit(None).cast("binary").alias("counts"))
    for k, frame in enumerate((answers, *more)):
        dealt = dealt.unionByName(frame.select("shard", F.lit(k).alias("kind"), F.lit(None).cast("bigint").alias("doc_id"),
                                               F.lit(None).cast("string").alias("text"), "keys", "counts"))
    dealt = dealt.repartitionById(layout.shards, "shard").sortWithinPartitions("shard", "kind", "doc_id")

    def one(shard: int, parts: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
        held, first = [], None
        for rows in parts:
            kind = rows["kind"].to_numpy()
            split = int((kind < kinds).sum())
            for k in np.unique(kind[:split]).tolist():
                a, b = np.searchsorted(kind, [k, k + 1])
                held.append((k, rows.slice(a, b - a).select(["keys", "counts"])))
            if split < len(kind):
                first = rows.slice(split)
                break
        if first is None:
            return
        known = []
        for k in range(kinds):
            mine = [rows for kind, rows in held if kind == k]
            keys, counts, _ = unpack(pa.concat_tables(mine)) if mine else (np.zeros(0, np.uint64), np.zeros(0, np.int64), None)
            order = np.argsort(keys)
            known += [keys[order], counts[order]]
        texts = (rows.select(["doc_id", "text"]).combine_chunks().to_batches() for rows in chain([first], parts))
        yield from run(shard, *known, chunks(chain.from_iterable(texts)))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealt_ = (part for batch in batches for part in by_shard(pa.Table.from_batches([batch])))
        for shard, parts in groupby(dealt_, key=lambda part: part[0]):
            yield from one(shard, (rows for _, rows in parts))

    return dealt.mapInArrow(whole, schema)
