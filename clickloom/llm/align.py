"""Tokens of two vocabularies aligned by the bytes they cover.

A encodes a space and the text, B the text, to which it adds that space itself, so both cover the same bytes. Per chunk
of texts all tokens of A and B lie on one axis of bytes:

1. They are lexsorted by start. A running maximum of their ends (``maximum.accumulate``) is how far tokens so far reach;
   a token that starts where or after they reach begins a group. So groups end exactly where a token of A and one of B
   both end, and no group crosses a text.
2. Within a group every token of A is linked with the tokens of B whose bytes it shares: a run of them, found by binary
   search, so a group of n and m tokens has less than n + m links, never n times m looked at.

A pair of ids counts the documents that hold it linked. The distinct pairs of each document are written once with how
often it holds them; counts come from one grouping with map-side combine and go back by a join, broadcast while
there are at most ``BROADCAST_PAIRS`` pairs, else sorted and merged, in which AQE splits a pair that many documents have.

Defined cases: null and empty texts have no tokens, nor have texts whose tokens' bytes are not the text again (the
decoded form of a mark or a stray byte); control strings in a text are plain text; long texts are taken whole; every row
gives a row, repeated ones too, and counts as a document of its own; a null ``doc_id`` is passed through; other columns are
never looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.llm.bpe import byte_symbols
from clickloom.llm.text import chunks
from clickloom.session import scratch_dir

#: Bytes of text that a task aligns at once.
CHUNK_BYTES = 1_000_000
#: More pairs than these are not broadcast; a pair takes some 40 bytes there.
BROADCAST_PAIRS = 1_000_000
#: Letters up to Latin Extended-B, the same in all versions of Unicode since 5.0.
OLD = re.compile("[\x00-\u024f]*")
#: Fixed value: the mark of a space in pieces.
SPACE = "▁"


def default_vocabularies() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class ByteLevel:
    """A byte-level vocabulary of the tokenizers library; it encodes a space and the text.

    Where merges come in the order of the ids they make, the tiktoken library gives the same ids several times faster. It
    takes the texts whose letters are all older than any difference in what the two libraries call a letter.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import public_tokenizers
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        self.model.no_truncation()
        self.model.no_padding()
        byte_of = {c: b for b, c in enumerate(byte_symbols())}
        vocab = self.model.get_vocab(with_added_tokens=True)
        self.pieces = [b""] * (max(vocab.values()) + 1)
        for text, i in vocab.items():
            # an added token's string is no byte-level text and never comes out here
            self.pieces[i] = bytes(byte_of[c] for c in text) if all(c in byte_of for c in text) else text.encode()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        made = [vocab[a + b] for a, b in pairs]
        own = {i for i in vocab.values() if i not in self.model.get_added_tokens_decoder()}
        self.fast = None
        if made == sorted(set(made)) and len(own) == len(made) + 256 and min(made, default=256) == 256:
            self.fast = Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                 mergeable_ranks={self.pieces[i]: i for i in own})

    def encode(self, texts: list[str]) -> list[list[int]]:
        plain = [self.fast is not None and OLD.fullmatch(t) is not None for t in texts]
        rest = iter(self.model.encode_batch_fast([f" {t}" for t, p in zip(texts, plain) if not p], add_special_tokens=False))
        return [self.fast.encode_ordinary(f" {t}") if p else next(rest).ids for t, p in zip(texts, plain)]


class Pieces:
    """A sentencepiece vocabulary; its model adds the space."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.pieces = [bytes([int(name[1:-1], 16)]) if self.model.is_byte(i) else name.replace(SPACE, " ").encode()
                       for i, name in enumerate(names)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@cache
def vocabulary(path: str) -> ByteLevel | Pieces:
    """The vocabulary of a file, loaded once in a worker."""
    return ByteLevel(path) if path.endswith(".json") else Pieces(path)


@cache
def _sizes(path: str) -> np.ndarray:
    return np.array([len(p) for p in vocabulary(path).pieces], np.int64)


def pair_base(path: str) -> int:
    """A pair of ids (a, b) is the number a * base + b."""
    return len(vocabulary(path).pieces)


@cache
def _names(path: str) -> np.ndarray:
    """Every id's text before a comma, a bar and a semicolon."""
    return np.array([f"{i}{mark}" for i in range(pair_base(path)) for mark in ",|;"], object)


def tokens(path: str, texts: list[str]) -> list[list[int] | None]:
    """Ids of each text; None where the joined bytes are not the space and the text."""
    own = vocabulary(path)
    piece = own.pieces.__getitem__
    return [ids if b"".join(map(piece, ids)) == f" {text}".encode() else None
            for text, ids in zip(texts, own.encode(texts), strict=True)]


def groups(start: np.ndarray, end: np.ndarray, side: np.ndarray) -> np.ndarray:
    """The group of each token, by coalescing intervals that overlap."""
    order = np.lexsort((side, start))
    reach = np.maximum.accumulate(end[order])
    first = np.append(True, start[order][1:] >= reach[:-1]) if len(order) else np.zeros(0, bool)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(first) - 1
    return group


def links(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of A and B of every pair that shares bytes; both sides cover the axis without gaps."""
    low = np.searchsorted(b_end, a_start, side="right")
    n = np.searchsorted(b_start, a_end, side="left") - low
    a = np.repeat(np.arange(len(n)), n)
    return a, np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)


def align(texts: list[str | None], path_a: str, path_b: str) -> list[list]:
    """Columns n_a, n_b, n_groups, n_links, groups, pairs, times of some texts."""
    real = [k for k, t in enumerate(texts) if t]
    given = [texts[k] for k in real]
    both = list(zip(real, tokens(path_a, given), tokens(path_b, given), strict=True))
    both = [(k, x, y) for k, x, y in both if x and y]
    at, n = np.array([k for k, _, _ in both], np.int64), len(texts)
    a = np.array([i for _, x, _ in both for i in x], np.int64)
    b = np.array([i for _, _, y in both for i in y], np.int64)
    n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in ([x for _, x, _ in both], [y for _, _, y in both]))
    doc = np.concatenate([np.repeat(np.arange(len(both)), n_a), np.repeat(np.arange(len(both)), n_b)])
    a_end, b_end = np.cumsum(_sizes(path_a)[a]), np.cumsum(_sizes(path_b)[b])
    a_start, b_start = a_end - _sizes(path_a)[a], b_end - _sizes(path_b)[b]
    side = np.repeat([0, 1], [len(a), len(b)])
    group = groups(np.append(a_start, b_start), np.append(a_end, b_end), side)
    # groups as text: A's ids, a bar, B's ids; a semicolon before the next group
    slot = group * 2 + side
    order = np.argsort(slot, kind="stable")
    after = np.append(slot[order][1:], -1)
    mark = np.where(after == slot[order], 0, np.where(after == slot[order] + 1, np.where(side[order] == 0, 1, 2), 2))
    ids, sides = np.append(a, b)[order], side[order]
    text = np.where(sides == 0, _names(path_a)[np.where(sides == 0, ids, 0) * 3 + mark],
                    _names(path_b)[np.where(sides == 1, ids, 0) * 3 + mark]).tolist()
    bound = np.append(0, np.cumsum(n_a + n_b)).tolist()
    spelled = [""] * n
    for k, place in enumerate(at.tolist()):
        spelled[place] = "".join(text[bound[k]:bound[k + 1]])[:-1]
    # links, and each document's distinct pairs of ids
    la, lb = links(a_start, a_end, b_start, b_end)
    span = pair_base(path_a) * pair_base(path_b)
    key, times = np.unique(doc[la] * span + a[la] * pair_base(path_b) + b[lb], return_counts=True)
    whole = np.zeros((4, n), np.int64)
    whole[0, at], whole[1, at] = n_a, n_b
    whole[2, at] = np.bincount(doc[order][np.append(True, np.diff(group[order]) > 0)] if len(order) else doc, minlength=len(at))
    whole[3, at] = np.bincount(doc[la], minlength=len(at))
    size = np.zeros(n, np.int64)
    size[at] = np.bincount(key // span, minlength=len(at))
    offsets = pa.array(np.append(0, np.cumsum(size)), pa.int32())
    return [*map(pa.array, whole), pa.array(spelled, pa.string()), pa.ListArray.from_arrays(offsets, pa.array(key % span)),
            pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int64)))]


_COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"]
_SCHEMA = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
           "pairs array<bigint>, times array<bigint>")


def alignments(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row doc_id, counts, ``groups`` (``a1,a2|b1;a3|b2,b3``), its distinct linked pairs and how often it has each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, limit=CHUNK_BYTES):
            done = align(chunk["text"].to_pylist(), path_a, path_b)
            yield pa.RecordBatch.from_arrays([chunk["doc_id"].combine_chunks(), *done], ["doc_id", *_COLUMNS])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, _SCHEMA)


def pair_counts(aligned: DataFrame, base: int) -> DataFrame:
    """Per pair the documents that hold it, and whether no other pair of its A id has more."""
    counted = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n_docs"))
    # an id of A meets at most as many ids as B has
    same = Window.partitionBy("id_a")
    counted = counted.withColumn("id_a", F.floor(F.col("pair") / base))
    return counted.select("pair", "n_docs", (F.col("n_docs") == F.max("n_docs").over(same)).alias("best"))


def scored(docs: DataFrame, path_a: str, path_b: str, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """Per row doc_id, counts, ``groups_sha256``, and over its links ``n_best`` and ``count_sum``."""
    spark, place, table = docs.sparkSession, scratch_dir(docs.sparkSession, "aligned"), scratch_dir(docs.sparkSession, "pairs")
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    found = alignments(docs, path_a, path_b).withColumn("row", F.monotonically_increasing_id())
    found.select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", digest, "pairs", "times").write.parquet(place)
    aligned = spark.read.parquet(place)
    pair_counts(aligned, pair_base(path_b)).write.parquet(table)
    counts = spark.read.parquet(table)
    if counts.count() <= broadcast_pairs:
        counts = F.broadcast(counts)
    else:
        counts = counts.hint("merge")
    held = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    held = held.select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times")).join(counts, "pair")
    sums = held.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                                   F.sum(F.col("n_docs") * F.col("times")).alias("count_sum"))
    joined = aligned.drop("pairs", "times").join(sums, "row", "left")
    return joined.select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
                         F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")


def op12_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark.read.parquet(f"{sf_dir}/documents.parquet"), *default_vocabularies())
