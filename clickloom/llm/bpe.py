"""Byte-pair encoding and decoding in batched numpy merge rounds.

A chunk's distinct words stand one after another in a single flat array of symbols. In each round
every neighbouring pair within a word is looked up by binary search among the sorted pair keys of
the merge table; each word then merges, all words at once, every occurrence of its lowest-ranked
pair, from left to right. Words that have no pair left drop out. A word that occurs again is looked
up, not encoded again.

The vocabulary file is read in each Python worker from a path that must exist on the workers; its
size is fixed, and nothing else is kept but the encodings of recent words, at most ``MEMORY`` of them.

Defined cases: a null text is an empty one, with no ids and an empty decoded text; texts are taken
whole whatever their length; every row gives a row, repeated ones too, null ids unchanged; other
columns are never looked at.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.text import chunks, strings

#: Distinct words, with what is written onto them, whose encodings a worker keeps.
MEMORY = 1_000_000

_NONE = np.iinfo(np.int64).max


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in vocabulary files of this kind."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    names = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [names[b] for b in range(256)]


def ragged(values: np.ndarray, first: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slices ``first[i]:first[i + 1]`` for each i of ``picks`` end to end, and their bounds."""
    size = first[picks + 1] - first[picks]
    bounds = np.zeros(len(picks) + 1, np.int64)
    np.cumsum(size, out=bounds[1:])
    at = np.arange(bounds[-1]) + np.repeat(first[picks] - bounds[:-1], size)
    return values[at], bounds


class Encoder:
    """A BPE vocabulary with word ends, and what a worker remembers of words it has met."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        self.special = {" " + t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = 1 + max([*self.vocab.values(), *self.special.values()])
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.parts = regex.compile("(" + "|".join(regex.escape(x[1:]) for x in self.special) + ")")
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([self.vocab[a] * self.size + self.vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([self.vocab[a + b] for a, b in pairs], np.int64)[order]
        names = byte_symbols()
        self.inner = np.array([self.vocab[c] for c in names], np.int64)
        self.last = np.array([self.vocab[c + self.end] for c in names], np.int64)
        self.shown = [b""] * self.size
        for text, i in [*self.vocab.items(), *self.special.items()]:
            self.shown[i] = text.lstrip(" ").encode()
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.zeros(0, np.int64)
        self.first = np.zeros(1, np.int64)

    def pieces(self, text: str) -> list[str]:
        """The normalised text cut at its blanks; no word goes across one.

        A special token's string is a piece of its own, marked by a blank before it.
        """
        if "<|" not in text:
            return self.plain(text)
        out = []
        for k, part in enumerate(self.parts.split(text)):
            out += [" " + part] if k % 2 else self.plain(part)
        return out

    @staticmethod
    def plain(text: str) -> list[str]:
        if not text.isascii():
            # capital sigma has one small form here, wherever it stands in a word
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower().replace("\n", " ").split(" ")

    def words(self, piece: str) -> list[str]:
        return [piece] if piece.startswith(" ") else self.pattern.findall(piece)

    def symbols(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The single-byte symbols of words without special ones, and each word's bounds."""
        raw = [w.encode() for w in words]
        bounds = np.zeros(len(raw) + 1, np.int64)
        np.cumsum([len(w) for w in raw], out=bounds[1:])
        data = np.frombuffer(b"".join(raw), np.uint8)
        out = self.inner[data]
        ends = bounds[1:] - 1
        out[ends] = self.last[data[ends]]
        return out, bounds

    def merge(self, symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All words merged as far as the table goes; no word may be empty."""
        count = len(bounds) - 1
        done_ids, done_word = [], []
        word = np.repeat(np.arange(count), np.diff(bounds))
        while len(symbols):
            key = symbols[:-1] * self.size + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            fits = (self.keys[at] == key) & (word[:-1] == word[1:])
            rank = np.where(fits, self.ranks[at], _NONE)
            rank = np.append(rank, _NONE)
            begin = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            size = np.diff(np.append(begin, len(word)))
            best = np.repeat(np.minimum.reduceat(rank, begin), size)
            live = best != _NONE
            done_ids.append(symbols[~live])
            done_word.append(word[~live])
            hit = live & (rank == best)
            # of pairs that overlap, as in a run of one symbol, every second one is merged
            run = np.flatnonzero(hit & ~np.append(False, hit[:-1]))
            where = np.flatnonzero(hit)
            since = where - run[np.searchsorted(run, where, side="right") - 1]
            left = where[since % 2 == 0]
            symbols = symbols.copy()
            symbols[left] = self.merged[at[left]]
            live[left + 1] = False
            symbols, word = symbols[live], word[live]
        ids = np.concatenate([*done_ids, np.zeros(0, np.int64)])
        owner = np.concatenate([*done_word, np.zeros(0, np.int64)])
        order = np.argsort(owner, kind="stable")
        out = np.zeros(count + 1, np.int64)
        np.cumsum(np.bincount(owner, minlength=count), out=out[1:])
        return ids[order], out

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of each word and its bounds among them; special ones may be anywhere."""
        special = np.array([w in self.special for w in words], bool)
        usual = [w for w in words if w not in self.special]
        ids, first = self.merge(*self.symbols(usual)) if usual else (np.zeros(0, np.int64), np.zeros(1, np.int64))
        if not special.any():
            return ids, first
        size = np.ones(len(words), np.int64)
        size[~special] = np.diff(first)
        bounds = np.append(0, np.cumsum(size))
        out, own = np.zeros(bounds[-1], np.int64), np.repeat(special, size)
        out[~own], out[own] = ids, [self.special[w] for w in words if w in self.special]
        return out, bounds

    def learn(self, pieces: list[str]) -> None:
        """Encode the pieces that are not known yet, all their words in one batch."""
        lists = [self.words(p) for p in pieces]
        words = {w: i for i, w in enumerate(dict.fromkeys(w for x in lists for w in x))}
        ids, first = self.encode_words(list(words))
        flat = np.array([words[w] for x in lists for w in x], np.int64)
        ids, inner = ragged(ids, first, flat)
        ends = inner[np.cumsum([len(x) for x in lists])]
        self.known.update(zip(pieces, range(len(self.known), len(self.known) + len(pieces))))
        self.ids = np.concatenate([self.ids, ids])
        self.first = np.concatenate([self.first, self.first[-1] + ends])

    def look_up(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all pieces of the texts, and each text's bounds among them."""
        lists = [self.pieces(t) for t in texts]
        bounds = np.zeros(len(lists) + 1, np.int64)
        np.cumsum([len(x) for x in lists], out=bounds[1:])
        flat = [p for x in lists for p in x]
        new = set(flat).difference(self.known)
        if len(self.known) + len(new) > MEMORY:
            self.forget()
            new = set(flat)
        if new:
            self.learn(sorted(new))
        return np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat)), bounds

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and each text's bounds among them."""
        picks, bounds = self.look_up(texts)
        ids, inner = ragged(self.ids, self.first, picks)
        return ids.astype("<u4"), inner[bounds]

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids: their symbols, special ones too, with one space between."""
        return b" ".join(map(self.shown.__getitem__, ids.tolist()))


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """Per row ``doc_id`` and ``ids``, the whole text's ids as little-endian 32-bit integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for chunk in chunks(batches):
            ids, bounds = bpe.encode(strings(chunk["text"]).to_pylist())
            raw, at = ids.tobytes(), (bounds * 4).tolist()
            packed = pa.array([raw[a:b] for a, b in zip(at, at[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([chunk["doc_id"].combine_chunks(), packed], ["doc_id", "ids"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, ids binary")


def decode(rows: DataFrame, path: str) -> DataFrame:
    """Per row ``doc_id``, ``ids`` and ``text``, what the ids stand for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for chunk in chunks(batches, "ids", 4_000_000):
            ids = chunk["ids"].combine_chunks()
            text = [bpe.decode(np.frombuffer(x or b"", "<u4")) for x in ids.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [chunk["doc_id"].combine_chunks(), ids, pa.array(text, pa.binary()).cast(pa.string())],
                ["doc_id", "ids", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids binary, text string")


def coded(docs: DataFrame, path: str) -> DataFrame:
    """Per row ``doc_id`` and ``ids``, their number, and the SHA-256 of them and of the text decoded from them."""
    return decode(encode(docs, path), path).select(
        "doc_id", "ids", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """What :func:`coded` gives without the ids."""
    return coded(docs, path).drop("ids")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_vocabulary())
