"""Language-model scores from a log-frequency Bloom filter.

Texts are stored once in shards of rows that were read together, so a task that counts them meets few shards and sends a row
per shard and bucket of keys; they cross no shuffle. Training texts are counted in packed keys: every word and every pair of
neighbouring words. Word counts go back to the shards that hold the words, exact, for the base score. Pairs go
into a Bloom filter: the count c is quantised to q = 1 + floor(log2 c), and the filter holds the pair with
each of the marks 1 .. q. A reader probes with 1, 2, ... until a probe fails; the last mark that
holds gives the count back as the middle of its range. A mark that holds by chance makes a pair a
step too frequent, with the filter's false-positive rate; no mark that was put in is ever missed.

The filter is cut by ranges of keys into one slice per bucket, ten to twenty bits a mark, so it grows with the marks and
chance hits stay as rare whatever the corpus. Only training pairs are counted, and a bucket's task writes its slice as
bytes to a table that stays (:func:`train_filter`), to be read again by any later run. A slice is never probed beyond the
highest mark put into it. Workers get the filter by broadcast and probe it where the texts are, so no pair comes back through a shuffle.
A filter of more than ``BROADCAST_BYTES`` is not broadcast: there the pairs that a shard asks about go packed to their
slices, and the marks found come back, a byte each in the order asked; both ways give the same marks.

Score of a token w after h: ``a p2(w | h) + (1 - a) p1(w)``, with p1 the base probability and
p2 = c(h w) / c(h), at most 1; a is ``SHARE`` for frequent h and less for rare ones. The first token of a text
has p1 alone.

Defined cases: a null or empty text is one end token; texts are whole; a null doc_id is of no training document and not held out;
repeated rows are counted and scored each; other columns are never looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.packed import (
    PACKED, PACKED_SCHEMA, Layout, Packer, add_up, answered, bucket_of, pack, packed_counts, stored_by, stretches, unpack,
)
from clickloom.llm.text import chunks, find_words, mix, strings
from clickloom.session import scratch_dir, shuffles_removed

#: Fixed values of the held-out rule.
FOLDS, HELD_OUT = 7, 2
#: Bits of the filter per mark, at least.
BITS_PER_MARK = 10
PROBES = 3
#: A filter of more bytes is not broadcast.
BROADCAST_BYTES = 512 << 20
SLICE = "slices int, bucket int, log int, most int, pairs bigint, bits binary"
#: The part of pairs in a score, and the count of a history at which it has half of it.
SHARE, HALF = 0.4, 20.0

END = mix(np.array([0x2545F4914F6CDD1D], np.uint64))[0]
_SALT = np.array([0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)
_MARK = 0x9FB21C651E98DF25

_RESULT = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
           "base_score double, score double")


def in_training(doc_ids: list) -> np.ndarray:
    return np.array([i is not None and zlib.crc32(str(i).encode()) % FOLDS != HELD_OUT for i in doc_ids], bool)


def token_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of each text, its words and one end, as hashes end to end; their bounds."""
    words = find_words(texts, lower=True)
    bounds = words.first + np.arange(len(words.first))
    out = np.empty(bounds[-1], np.uint64)
    ends = bounds[1:] - 1
    inside = np.ones(len(out), bool)
    inside[ends] = False
    out[inside], out[ends] = words.hashes, END
    return out, bounds


def pairs_of(tokens: np.ndarray) -> np.ndarray:
    """The hash of the pair that each token ends; meaningless for the first of a text."""
    return mix(np.roll(tokens, 1) * _SALT[0] + tokens * _SALT[1])


def count_words(docs: DataFrame, layout: Layout) -> DataFrame:
    """Per shard and bucket the words its documents hold, with their counts in training.

    A word that only held-out documents have is asked for too, and answered with 0.
    """
    def keys_of(chunk: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        tokens, bounds = token_hashes(strings(chunk["text"]))
        train = in_training(chunk["doc_id"].to_pylist())
        return tokens, np.repeat(train, np.diff(bounds)).astype(np.int64), bounds

    return pack(docs, layout, keys_of, whole=True)


def count_pairs(docs: DataFrame, layout: Layout, asked: bool = False) -> DataFrame:
    """Per shard and bucket the pairs that its training documents hold, with their counts.

    ``asked``: the pairs of all documents, those of a shard in one row per bucket and in order.
    """
    def keys_of(chunk: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        tokens, bounds = token_hashes(strings(chunk["text"]))
        used = inside(bounds) & np.repeat(in_training(chunk["doc_id"].to_pylist()), np.diff(bounds))
        keys = pairs_of(tokens)[used]
        return keys, np.ones(len(keys), np.int64), np.append(0, np.cumsum(used))[bounds]

    def ask(rows: pa.Table) -> pa.Table:
        pairs = np.concatenate([pairs_of(tokens)[inside(bounds)] for _, tokens, bounds in tokens_in(rows)])
        keys, packer = distinct(pairs)[0], Packer(layout.buckets)
        packer.add(rows["shard"][0].as_py(), keys, np.ones(len(keys), np.int64))
        return pa.Table.from_batches(packer.send(), PACKED_SCHEMA)

    return docs.groupBy("shard").applyInArrow(ask, PACKED) if asked else pack(docs, layout, keys_of, whole=True)


def tokens_in(rows: pa.Table) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """The rows in chunks, each with its tokens and their bounds."""
    for chunk in chunks(rows.to_batches()):
        yield chunk, *token_hashes(strings(chunk["text"]))


def inside(bounds: np.ndarray) -> np.ndarray:
    """Which tokens end a pair: all but the first of each text."""
    out = np.ones(bounds[-1], bool)
    out[bounds[:-1]] = False
    return out


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the place of each key among them."""
    order = np.argsort(keys, kind="stable")
    new = np.ones(len(keys), bool)
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(new) - 1
    return keys[order[new]], place


def marks_of(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log2(np.maximum(counts, 1))).astype(np.int64)


@dataclass(frozen=True)
class Shape:
    """A filter of slices by ranges of keys, each of ``2 ** log`` bits."""

    slices: int
    log: int

    @classmethod
    def of(cls, marks: int, slices: int, max_bits: int | None = None, bits_per_mark: int = BITS_PER_MARK) -> Shape:
        """About ten bits a mark and twenty at most; ``max_bits`` bounds all slices together, if it is given."""
        log = (bits_per_mark * marks // slices).bit_length()
        if max_bits is not None:
            log = min(log, (max_bits // slices).bit_length() - 1)
        return cls(slices, max(10, log))

    @property
    def bits(self) -> int:
        return self.slices << self.log


def positions(keys: np.ndarray, mark: int, shape: Shape) -> Iterator[np.ndarray]:
    """The bits that stand for pairs with a mark, all in the slice of the pair's bucket."""
    return bits_of(keys, mark, bucket_of(keys, shape.slices) << shape.log, shape.log)


def bits_of(keys: np.ndarray, mark: int, begin: np.ndarray, log: int | np.ndarray) -> Iterator[np.ndarray]:
    """The bits of pairs in slices that ``begin`` somewhere and have ``2 ** log`` bits."""
    first = mix(keys + np.uint64(_MARK * mark & 0xFFFFFFFFFFFFFFFF))
    step, down = mix(first) | np.uint64(1), np.uint64(64) - np.asarray(log).astype(np.uint64)
    for k in range(PROBES):
        yield begin + ((first + np.uint64(k) * step) >> down).astype(np.int64)


def filled(keys: np.ndarray, marks: np.ndarray, shape: Shape) -> np.ndarray:
    """The bytes of a filter that holds distinct pairs with each of their marks."""
    bits = np.zeros(shape.bits, bool)
    for level in range(1, int(marks.max(initial=0)) + 1):
        for place in positions(keys[marks >= level], level, shape):
            bits[place] = True
    return np.packbits(bits, bitorder="little")


def probed_marks(filter_: np.ndarray, keys: np.ndarray, shape: Shape, most: int | None = None) -> np.ndarray:
    """The highest mark, ``most`` at most, up to which the filter holds all of a pair's; 0 for a pair it does not hold."""
    mark, open_, level = np.zeros(len(keys), np.int64), np.arange(len(keys)), 0
    while len(open_) and level != most:
        level += 1
        held = np.ones(len(open_), bool)
        for bit in positions(keys[open_], level, shape):
            held &= (filter_[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
        open_ = open_[held]
        mark[open_] = level
    return mark


def middle(mark: np.ndarray) -> np.ndarray:
    """The middle of the counts that have a mark."""
    return np.where(mark > 1, 0.75 * 2.0 ** mark, mark)


def probed(filter_: np.ndarray, keys: np.ndarray, shape: Shape, most: int | None = None) -> np.ndarray:
    """The counts that the filter gives for pairs, 0 for one it does not hold."""
    return middle(probed_marks(filter_, keys, shape, most))


def slices_of(pairs: DataFrame, layout: Layout, bits_per_mark: int = BITS_PER_MARK) -> DataFrame:
    """The filter of counted pairs, a row per bucket: a slice's size, its highest mark and its bytes."""
    slices = layout.buckets

    def run(table: pa.Table) -> pa.Table:
        keys, counts, _ = unpack(table)
        keys, counts = add_up(keys, counts)
        marks = marks_of(counts)
        shape = Shape.of(int(marks.sum()), 1, bits_per_mark=bits_per_mark)
        return pa.table({"slices": pa.array([slices], pa.int32()), "bucket": table["bucket"].slice(0, 1),
                         "log": pa.array([shape.log], pa.int32()), "most": pa.array([int(marks.max())], pa.int32()),
                         "pairs": pa.array([len(keys)], pa.int64()),
                         "bits": pa.array([filled(keys, marks, shape).tobytes()], pa.binary())})

    return pairs.groupBy("bucket").applyInArrow(run, SLICE)


def train_filter(docs: DataFrame, place: str, layout: Layout | None = None, bits_per_mark: int = BITS_PER_MARK) -> DataFrame:
    """Count the training pairs of the documents and write their filter to ``place``.

    Their counts go nowhere but into slices, so all documents are one shard: a task sends a row per bucket, whatever their number.
    """
    layout = layout or Layout.of(docs)
    rows = docs.select(F.lit(0).alias("shard"), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    slices_of(count_pairs(rows, layout), layout, bits_per_mark).write.parquet(place)
    return docs.sparkSession.read.parquet(place)


class Filter:
    """Slices as one array of bytes, as a worker holds and probes them."""

    def __init__(self, table: pa.Table):
        self.slices = table["slices"][0].as_py() if table.num_rows else 1
        self.log, self.most = np.zeros(self.slices, np.int64), np.zeros(self.slices, np.int64)
        self.begin = np.zeros(self.slices, np.int64)
        at = table["bucket"].to_numpy()
        size = pc.binary_length(table["bits"]).to_numpy().astype(np.int64)
        self.log[at], self.most[at] = table["log"].to_numpy(), table["most"].to_numpy()
        self.begin[at] = 8 * (np.cumsum(size) - size)
        self.bytes = np.concatenate([np.zeros(0, np.uint8), *(np.frombuffer(x.as_buffer(), np.uint8) for x in table["bits"])])

    def marks(self, keys: np.ndarray) -> np.ndarray:
        """The highest mark up to which each pair's slice holds all; 0 for a pair it does not hold."""
        bucket = bucket_of(keys, self.slices)
        mark, level = np.zeros(len(keys), np.int64), 0
        open_ = np.flatnonzero(self.most[bucket] > 0)
        while len(open_):
            level += 1
            of = bucket[open_]
            held = np.ones(len(open_), bool)
            for bit in bits_of(keys[open_], level, self.begin[of], self.log[of]):
                held &= (self.bytes[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
            open_ = open_[held]
            mark[open_] = level
            open_ = open_[self.most[bucket[open_]] > level]
        return mark


def through_slices(asked: DataFrame, slices: DataFrame, named: bool = True) -> DataFrame:
    """Per shard and bucket the pairs asked for with their marks, those whose mark is not 1; pairs meet their slice by bucket.

    Not ``named``: the marks alone, of all pairs in the order asked; a mark is a byte, a pair eight.
    """
    def run(table: pa.Table, own: pa.Table) -> pa.Table:
        filter_ = Filter(own)
        out = []
        for row in table.to_batches(max_chunksize=1):
            keys = np.frombuffer(row["keys"][0].as_buffer(), "<u8")
            mark = filter_.marks(keys)
            told = mark != 1 if named else np.ones(len(mark), bool)
            out.append({"shard": row["shard"][0].as_py(), "bucket": row["bucket"][0].as_py(),
                        "keys": keys[told].tobytes() if named else b"", "counts": packed_counts(mark[told]).tobytes()})
        return pa.Table.from_pylist(out, PACKED_SCHEMA)

    return asked.groupBy("bucket").cogroup(slices.groupBy("bucket")).applyInArrow(run, PACKED)


def score_documents(docs: DataFrame, place: str | None = None, broadcast_bytes: int = BROADCAST_BYTES,
                    bits_per_mark: int = BITS_PER_MARK) -> DataFrame:
    """Per row the exact base score and the model's score of the whole text.

    The filter is written to ``place``, if it is given, and can be read from there afterwards.
    """
    spark = docs.sparkSession
    layout = Layout.of(docs)
    rows = stretches(docs, layout)
    # each bucket's distinct words and their counts: one small row per bucket
    def sums(table: pa.Table) -> pa.Table:
        keys, counts, _ = unpack(table)
        _, first = np.unique(keys, return_index=True)
        return pa.table({"tokens": [int(counts[first].sum())], "words": [int((counts[first] > 0).sum())]})

    with shuffles_removed(spark):
        words = stored_by(answered(count_words(rows, layout)), "words", "bucket", layout.buckets)
        total = words.groupBy("bucket").applyInArrow(sums, "tokens bigint, words bigint").agg(F.sum("tokens"), F.sum("words")).first()
        slices = train_filter(rows, place or scratch_dir(spark, "filter"), layout, bits_per_mark)
    n, v = int(total[0] or 0), int(total[1] or 0)
    base = np.log10(n + v + 1.0)
    size = slices.agg(F.sum(F.octet_length("bits"))).first()[0] or 0
    answers, filter_ = words.withColumn("kind", F.lit(0)), None
    if size <= broadcast_bytes:
        filter_ = spark.sparkContext.broadcast(Filter(slices.toArrow()))
    else:
        marks = through_slices(count_pairs(rows, layout, asked=True), slices, named=False)
        answers = answers.unionByName(marks.withColumn("kind", F.lit(1)))

    def run(texts: pa.Table, told: pa.Table) -> pa.Table:
        parts = list(tokens_in(texts))
        keys, counts, _ = unpack(told.filter(pc.equal(told["kind"], 0)))
        order = np.argsort(keys)
        words, place = distinct(np.concatenate([tokens for _, tokens, _ in parts]))
        if not np.array_equal(keys[order], words):
            raise ValueError(f"counts of {len(keys)} words came back for {len(words)}")
        known = counts[order][place]
        if not filter_:
            pairs, place = distinct(np.concatenate([pairs_of(tokens)[inside(bounds)] for _, tokens, bounds in parts]))
            marks = marks_in_order(told.filter(pc.equal(told["kind"], 1)))
            if len(marks) != len(pairs):
                raise ValueError(f"{len(marks)} marks came back for {len(pairs)} pairs")
            marks = marks[place]
        out, at, pair = [], 0, 0
        for table, tokens, bounds in parts:
            ids = table["doc_id"].to_pylist()
            c, later = known[at:at + len(tokens)], inside(bounds)
            at += len(tokens)
            log1 = np.log10(c + 1.0) - base
            before = np.roll(c, 1)
            ask = later & (c > 0) & (before > 0)
            both = np.zeros(len(tokens))
            if filter_:
                both[ask] = middle(filter_.value.marks(pairs_of(tokens)[ask]))
            else:
                both[ask] = middle(marks[pair:pair + later.sum()][ask[later]])
                pair += later.sum()
            share = np.where(later, SHARE * before / (before + HALF), 0.0)
            two = np.minimum(both, np.minimum(before, c)) / np.maximum(before, 1)
            log2 = np.log10(share * two + (1 - share) * 10.0 ** log1)
            add = lambda x: np.add.reduceat(x, bounds[:-1])  # noqa: E731  every text has a token
            crc = [i is not None and zlib.crc32(str(i).encode()) % FOLDS == HELD_OUT for i in ids]
            out.append(pa.table([
                table["doc_id"], pa.array(crc), pa.array(np.diff(bounds)), pa.array(add((c > 0).astype(np.int64))),
                pa.array(np.full(len(ids), n)), pa.array(add(log1)), pa.array(add(log2))],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]))
        return pa.concat_tables(out)

    return rows.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(run, _RESULT)


def marks_in_order(told: pa.Table) -> np.ndarray:
    """The marks of a shard's pairs, from a row per bucket; a mark is at most 64, so a byte."""
    rows = told.take(pc.sort_indices(told["bucket"]))
    return np.frombuffer(b"".join(rows["counts"].to_pylist()), np.uint8).astype(np.int64)


def op8_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
