"""Substring dedup with repeated-phrase automata.

A window is 35 consecutive words of one document; every word in a window that also begins anywhere
else is removed.

1. *Seeds.* Among the 20 runs of 16 words in a window, the one with the smallest hash is its seed
   (the leftmost of equals). Equal windows have equal seeds, and only a tenth of all runs is the
   seed of any window. Seeds are counted over the whole corpus.
2. *Confirm.* Only a window whose seed occurs twice can recur. These windows' hashes are counted over the whole
   corpus; those counted twice are the recurring passages.
3. *Automata.* Each shard of documents compiles one Aho-Corasick automaton of the seeds of its
   recurring passages, two characters a word. Streaming all its documents through the automaton locates every
   occurrence; from each one the match is extended word by word along the passage in both
   directions, and what is 35 words or longer is removed. Stretches without the hash of any seed are passed over.

A phrase goes to the shards whose documents hold it, so each document is streamed once whatever the number of
automata, and an automaton is bounded by its shard's text. A passage that many documents
share costs one entry per shard. Counting uses 64-bit hashes; words are compared one by one in the automata.

Defined cases: a null or empty text has no words and keeps none; texts are taken whole; rows that
repeat a doc_id are documents of their own, and count as repeats of one another; a null doc_id is passed
through; windows are judged on the input; other columns are never looked at; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.packed import PACKED, SHARD_BYTES, Layout, Packer, among, answered, pack, sharded, with_answers
from clickloom.llm.text import Words, find_words, gram_hashes, gram_places, strings
from clickloom.session import scratch_dir

WINDOW, SEED = 35, 16

_RESULT = "doc_id bigint, n_words bigint, removed array<struct<begin: bigint, end: bigint>>, text string"
_SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))


def window_seeds(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All windows' starts, the text of each, where its seed begins, and all seed hashes."""
    starts, owner = gram_places(first, WINDOW)
    grams = gram_hashes(hashes, SEED)
    if not len(starts):
        return starts, owner, starts, grams
    # smallest of each run of 20 in log steps; hashes go first, ties to the left
    span = WINDOW - SEED + 1
    place, best, width = np.arange(len(grams)), grams, 1
    while width < span:
        step = min(width, span - width)
        a, b = best[:-step], best[step:]
        take = b < a
        place = np.concatenate([np.where(take, place[step:], place[:-step]), place[len(place) - step:]])
        best = np.concatenate([np.minimum(a, b), best[len(best) - step:]])
        width += step
    return starts, owner, place[starts], grams


def seed_keys(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    words = find_words(strings(texts))
    starts, owner, seed, grams = window_seeds(words.hashes, words.first)
    new = np.ones(len(seed), bool)
    new[1:] = seed[1:] != seed[:-1]
    places = seed[new]
    return grams[places], np.ones(len(places), np.int64), np.searchsorted(owner[new], np.arange(len(texts) + 1))


def twice(counts: np.ndarray) -> np.ndarray:
    """Counts beyond two tell nothing more."""
    return np.minimum(counts, 2)


def runs_of(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each run of true values."""
    edge = np.diff(np.concatenate([[0], marks.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def confirm(docs: DataFrame, seeds: DataFrame, layout: Layout) -> DataFrame:
    """Packed hashes of the windows whose seed occurs twice or more."""
    buckets = layout.buckets

    def run(shard: int, keys: np.ndarray, _, tables: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
        packer = Packer(buckets, twice)
        for table in tables:
            words = find_words(strings(table["text"]))
            starts, _owner, seed, grams = window_seeds(words.hashes, words.first)
            hashes = gram_hashes(words.hashes, WINDOW)[starts[among(grams[seed], keys)]]
            packer.add(shard, hashes, np.ones(len(hashes), np.int64))
        yield from packer.send()

    return with_answers(docs, seeds, layout, run, PACKED)


def spans_to_remove(tables: list[pa.Table], recurring: np.ndarray) -> Iterator[tuple[pa.Table, Words, np.ndarray]]:
    """Each chunk of a shard with its words and a mark on every word to remove.

    The shard's passages go into one automaton of their seeds; then all its texts stream through. Where no run of
    16 words has the hash of a seed the automaton could find nothing, so these stretches are passed over.
    """
    parts = [(table, find_words(strings(table["text"]))) for table in tables]
    found, seen, seeds = [], np.zeros(0, np.uint64), [np.zeros(0, np.uint64)]
    for _table, words in parts:
        starts, _, seed, grams = window_seeds(words.hashes, words.first)
        hashes = gram_hashes(words.hashes, WINDOW)[starts]
        hit = np.flatnonzero(among(hashes, recurring))
        seeds.append(np.unique(grams[seed[hit]]))
        # a passage is a run of windows that this shard has not had before
        hit = hit[~among(hashes[hit], seen)]
        fresh, at = np.unique(hashes[hit], return_index=True)
        seen = np.union1d(seen, fresh)
        begins = starts[hit[at]]
        seed_at = np.full(len(words.hashes), -1)
        seed_at[starts] = seed
        found.append((begins, seed_at, grams))
    sieve = np.unique(np.concatenate(seeds))
    # words as numbers: equal words, compared as bytes, have equal numbers; words too far from any seed have none
    numbers: dict[bytes, int] = {}
    texts, stretches = [], []
    for (_table, words), (_begins, _seed_at, grams) in zip(parts, found):
        near = np.flatnonzero(among(grams, sieve))
        stretches.append(covered(near, SEED, len(words.hashes)))
        wide = np.flatnonzero(covered(np.maximum(near - (WINDOW - SEED), 0), 2 * WINDOW - SEED, len(words.hashes)))
        raw = words.data.tobytes()
        ids = np.full(len(words.hashes), -2)
        ids[wide] = np.fromiter((numbers.setdefault(raw[s:e], len(numbers)) for s, e in zip(
            words.start[wide].tolist(), words.end[wide].tolist())), np.int64, len(wide))
        texts.append(ids)
    base = max(1, int(np.ceil(np.sqrt(len(numbers)))))
    automaton = ahocorasick.Automaton()
    store, size = [], 0
    for (begins, seed_at, _grams), ids in zip(found, texts):
        mine = np.zeros(len(ids), bool)
        mine[begins] = True
        for a, b in zip(*runs_of(mine)):
            passage = ids[a:b - 1 + WINDOW]
            store.append(passage)
            for place in np.unique(seed_at[a:b]).tolist():
                key = symbols(ids[place:place + SEED], base)
                known = automaton.get(key, None)
                where = size + place - a
                if known is None:
                    automaton.add_word(key, [where])
                else:
                    known.append(where)
            store.append(np.array([-1]))  # no match goes on from one passage to the next
            size += len(passage) + 1
    if size:
        automaton.make_automaton()
        passages = np.concatenate(store)
    for (table, words), ids, stretch in zip(parts, texts, stretches):
        marks = np.zeros(len(ids) + 1, np.int64)
        counts = np.append(0, np.cumsum(stretch))[words.first]
        for i in np.flatnonzero(np.diff(counts)).tolist() if size else ():
            a, b = int(words.first[i]), int(words.first[i + 1])
            if b - a >= WINDOW:
                mark_matches(automaton, base, passages, ids[a:b], stretch[a:b], marks[a:b + 1])
        yield table, words, np.cumsum(marks[:-1]) > 0


def covered(begins: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of ``n`` places lie in a run of ``size`` from one of the beginnings."""
    edge = np.bincount(begins, minlength=n + 1)[:n + 1] - np.bincount(np.minimum(begins + size, n), minlength=n + 1)
    return np.cumsum(edge[:n]) > 0


def symbols(ids: np.ndarray, base: int) -> str:
    """Two characters per word, of ranges of their own, so that a node has few children and no match begins inside a word."""
    out = np.empty((len(ids), 2), "<u4")
    out[:, 0], out[:, 1] = ids // base + 1, ids % base + base + 2
    return out.tobytes().decode("utf-32-le")


def mark_matches(automaton, base: int, passages: np.ndarray, ids: np.ndarray, stretch: np.ndarray, marks: np.ndarray) -> None:
    """Add 1 where a match of 35 words or more begins in a text and -1 after its end."""
    reached: dict[int, int] = {}  # by the distance of text and passage: how far a match has gone
    low = high = 0                # the last stretch that is removed
    for first, last in zip(*runs_of(stretch)):
        for end, places in automaton.iter(symbols(ids[first:last], base)):
            begin = int(first) + end // 2 - SEED + 1
            if low <= begin - (WINDOW - SEED) and begin + WINDOW <= high:
                continue  # every window that holds this seed is removed already
            for where in places:
                shift = where - begin
                if reached.get(shift, -1) > begin:
                    continue
                a, b = extend(passages, ids, begin, where)
                reached[shift] = b
                if b - a >= WINDOW:
                    marks[a] += 1
                    marks[b] -= 1
                    low, high = (min(a, low), max(b, high)) if a <= high and low <= b else (a, b)
                    if low <= begin - (WINDOW - SEED) and begin + WINDOW <= high:
                        break


def extend(passages: np.ndarray, ids: np.ndarray, begin: int, where: int) -> tuple[int, int]:
    """The longest stretch of a text around ``begin`` that reads as the passages do around ``where``."""
    a, b, reach = begin, begin + SEED, 64
    shift = where - begin
    while b < len(ids):
        n = min(reach, len(ids) - b, len(passages) - b - shift)
        same = ids[b:b + n] == passages[b + shift:b + shift + n]
        if n <= 0 or not same.all():
            b += int(np.argmin(same)) if n > 0 else 0
            break
        b, reach = b + n, reach * 2
    reach = 64
    while a > 0:
        n = min(reach, a, a + shift)
        same = ids[a - n:a] == passages[a + shift - n:a + shift]
        if n <= 0 or not same.all():
            a -= int(np.argmin(same[::-1])) if n > 0 else 0
            break
        a, reach = a - n, reach * 2
    return a, b


def in_parts(tables: Iterator[pa.Table]) -> Iterator[list[pa.Table]]:
    """A shard's chunks in lists of about a shard's usual bytes, so that one full of rows of one number is not held whole."""
    held, size = [], 0
    for table in tables:
        held.append(table)
        size += table.nbytes
        if size > 2 * SHARD_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def cut(docs: DataFrame, passages: DataFrame, layout: Layout) -> DataFrame:
    """Per document its number of words, the removed spans of them, and the text of those kept."""
    def run(_shard: int, keys: np.ndarray, _, tables: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
        for table, words, gone in chain.from_iterable(spans_to_remove(held, keys) for held in in_parts(tables)):
            raw, first = words.data.tobytes(), words.first.tolist()
            removed, kept = [], []
            for a, b in zip(first, first[1:]):
                begin, end = runs_of(gone[a:b])
                removed.append([{"begin": x, "end": y} for x, y in zip(begin.tolist(), end.tolist())])
                own = ~gone[a:b]
                spans = zip(words.start[a:b][own].tolist(), words.end[a:b][own].tolist())
                kept.append(b" ".join([raw[s:e] for s, e in spans]))
            yield pa.RecordBatch.from_arrays(
                [table["doc_id"].combine_chunks(), pa.array(np.diff(words.first)), pa.array(removed, _SPANS),
                 pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "removed", "text"])

    return with_answers(docs, passages, layout, run, _RESULT)


def cleaned(docs: DataFrame) -> DataFrame:
    """Per row ``doc_id``, ``n_words``, ``removed`` and ``text``: the spans [begin, end) of words that repeat, and
    the other words with one space between."""
    spark = docs.sparkSession
    layout = Layout.of(docs)
    rows = sharded(docs, layout)
    stored = lambda frame, label: (frame.write.parquet(place := scratch_dir(spark, label)), spark.read.parquet(place))[1]
    recurs = lambda counts: counts > 1
    seeds = stored(answered(pack(rows, layout, seed_keys, twice), recurs), "seeds")
    passages = stored(answered(confirm(rows, seeds, layout), recurs), "passages")
    return cut(rows, passages, layout)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per row of :func:`cleaned` its words, the number removed, and the SHA-256 of the text kept."""
    gone = F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, span: n + span["end"] - span["begin"])
    return cleaned(docs).select("doc_id", "n_words", gone.alias("n_removed"),
                                F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
