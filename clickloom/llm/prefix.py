"""Exact token counts at every prefix, by dynamic programming over prefixes.

A sequence of tokens is what byte-pair encoding makes of their joined bytes if and only if each
neighbouring pair is: two tokens fit if encoding their joined bytes gives those two again. So the
encoding of a prefix is that of a shorter prefix and one last token that fits the token before it,
and for each prefix just one such last token exists. The recurrence runs over all distinct prefixes
of a chunk's new words at once, one length after another, once with the last byte inside a word
(for prefixes to come) and once with it at a word's end (the count of that prefix as a text).
Whether two tokens fit is found once per pair and kept. Prefixes are told apart by the shorter prefix and the
last byte; a rolling hash only proposes a last token, whose bytes are then compared.

A text's table then answers any question about cuts and budgets without encoding again: its entry
k is the number of tokens of the first k code points of the normalised text (composed, small
letters). Tables are made on demand; the counting query takes their last entries.

Defined cases: a null or empty text has no tokens; long texts are counted whole; every row gives a
row, repeated ones too, null ids unchanged; other columns are never looked at. A cut inside a
special token's string leaves ordinary text, and is counted so.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.bpe import Encoder, byte_symbols, default_vocabulary, ragged
from clickloom.llm.text import chunks, strings

#: Pieces of text, and pairs of tokens, that a worker remembers.
MEMORY = 1_000_000
PAIRS = 4_000_000
#: Contractions that are cut in two words when their last letter is missing.
SPLIT_WHEN_CUT = ("'re", "'ve", "'ll")
LIMIT = 2048

_BASE = 0x9E3779B97F4A7C15


class PrefixCounter:
    """Tables of prefix counts for words, and what a worker remembers of them."""

    def __init__(self, path: str):
        self.bpe = bpe = Encoder(path)
        names = {c: b for b, c in enumerate(byte_symbols())}
        inner, final = {}, {}
        for text, i in bpe.vocab.items():
            ends = text.endswith(bpe.end)
            raw = bytes(names[c] for c in (text[:-len(bpe.end)] if ends else text))
            (final if ends else inner)[raw] = i
        self.longest = max(map(len, [*inner, *final]))
        self.powers = np.cumprod(np.append(np.uint64(1), np.full(self.longest, np.uint64(_BASE))), dtype=np.uint64)
        self.inner, self.final = self._lookup(inner), self._lookup(final)
        # each token's bytes, and these as symbols
        spelt = {i: raw for raw, i in [*inner.items(), *final.items()]}
        self.bytes = np.frombuffer(b"".join(spelt[i] for i in sorted(spelt)), np.uint8)
        self.bytes_first = np.cumsum([0, *(len(spelt.get(i, b"")) for i in range(bpe.size))])
        self.base, self.base_first = np.zeros(0, np.int64), np.zeros(bpe.size + 1, np.int64)
        parts = {i: bpe.inner[list(raw)] for raw, i in inner.items()}
        for raw, i in final.items():
            parts[i] = np.append(bpe.inner[list(raw[:-1])], bpe.last[raw[-1]])
        self.base_first[1:] = np.cumsum([len(parts.get(i, ())) for i in range(bpe.size)])
        self.base = np.concatenate([parts[i] for i in sorted(parts)])
        every = np.array(sorted(parts), np.int64)
        ids, first = bpe.merge(*ragged(self.base, self.base_first, every))
        self.alone = np.zeros(bpe.size, bool)
        self.alone[every] = (np.diff(first) == 1) & (ids[first[:-1]] == every)
        self.pair_keys, self.pair_fits = np.zeros(0, np.int64), np.zeros(0, bool)
        # lengths in the order in which last tokens are usually found
        self.lengths = sorted(range(1, self.longest + 1), key=lambda n: (n > 4, abs(n - 3)))
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.totals = np.zeros(0, np.int64)
        self.words: dict[str, int] = {}
        self.flat, self.first = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _lookup(self, tokens: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
        hashes = np.array([self.hash_of(raw) for raw in tokens], np.uint64)
        order = np.argsort(hashes)
        if (np.diff(hashes[order]) == 0).any():
            raise ValueError("two tokens of the vocabulary have one hash")
        return hashes[order], np.array(list(tokens.values()), np.int64)[order]

    @staticmethod
    def hash_of(raw: bytes) -> int:
        h = 0
        for b in raw:
            h = (h * _BASE + b + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    def fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether each pair of tokens is the encoding of its joined bytes."""
        keys = left * self.bpe.size + right
        known = np.searchsorted(self.pair_keys, keys)
        known = np.minimum(known, max(len(self.pair_keys) - 1, 0))
        new = np.unique(keys[self.pair_keys[known] != keys] if len(self.pair_keys) else keys)
        if len(new):
            a, b = new // self.bpe.size, new % self.bpe.size
            symbols, bounds = ragged(self.base, self.base_first, np.stack([a, b], 1).ravel())
            ids, first = self.bpe.merge(symbols, bounds[::2])
            fit = np.diff(first) == 2
            at = np.where(fit, first[:-1], 0)
            fit &= (ids[at] == a) & (ids[np.minimum(at + 1, len(ids) - 1)] == b)
            if len(self.pair_keys) + len(new) > PAIRS:
                self.pair_keys, self.pair_fits = self.pair_keys[:0], self.pair_fits[:0]
            place = np.searchsorted(self.pair_keys, new)
            self.pair_keys = np.insert(self.pair_keys, place, new)
            self.pair_fits = np.insert(self.pair_fits, place, fit)
            if len(self.pair_keys) == len(new):
                return self.fits(left, right)  # what was known has been let go
            known = np.searchsorted(self.pair_keys, keys)
        return self.pair_fits[known]

    def word_tables(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The counts of each word's prefixes of 1, 2, ... code points, as texts, and their bounds."""
        raw = [w.encode() for w in words]
        size = np.array([len(w) for w in raw], np.int64)
        order = np.argsort(-size, kind="stable")
        size = size[order]
        data = np.frombuffer(b"".join([raw[i] for i in order.tolist()]), np.uint8)
        start = np.cumsum(size) - size
        nodes = [np.zeros(len(order), np.int64)]    # of each word, the prefix it has at each length
        last, count = [np.full(1, -1)], [np.zeros(1, np.int64)]
        rolling = np.zeros(len(order), np.uint64)
        sums = [rolling]                            # hash of each word's prefix at each length
        final_counts = []
        for n in range(1, int(size.max(initial=0)) + 1):
            live = int(np.searchsorted(-size, -n, side="right"))
            rolling = sums[-1][:live] * np.uint64(_BASE) + data[start[:live] + n - 1] + np.uint64(1)
            sums.append(rolling)
            longer = nodes[-1][:live] << 8 | data[start[:live] + n - 1]
            _, pick, node = np.unique(longer, return_index=True, return_inverse=True)
            nodes.append(node)
            told = n, pick, data, start, sums, nodes, last, count
            token, total = self._last_token(*told, self.inner)
            last.append(token)
            count.append(total)
            final_counts.append(self._last_token(*told, self.final)[1][node])
        flat = np.zeros(len(data), np.int32)
        for n, values in enumerate(final_counts):
            flat[start[:len(values)] + n] = values
        # a code point's last byte carries its entry; words go back to the order they came in
        ends = np.append((data[1:] & 0xC0) != 0x80, True)
        begins = np.append(start, len(data))
        points = np.append(0, np.cumsum(ends))[begins]
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        flat, first = ragged(flat[ends], points, back)
        for i, word in enumerate(words):
            if word[0] == "'" and word in SPLIT_WHEN_CUT:
                flat[first[i] + 1] = 2
        return flat, first

    def _last_token(self, n, pick, data, start, sums, nodes, last, count, lookup):
        """For prefixes of ``n`` bytes, seen in the words ``pick``, the last token and the count."""
        hashes, ids = lookup
        token, total = np.full(len(pick), -1), np.zeros(len(pick), np.int64)
        open_ = np.arange(len(pick))
        for length in self.lengths:
            if length > n or not len(open_):
                continue
            word = pick[open_]
            key = sums[n][word] - sums[n - length][word] * self.powers[length]
            at = np.minimum(np.searchsorted(hashes, key), len(hashes) - 1)
            found = np.flatnonzero(hashes[at] == key)
            found = found[self._ends_with(ids[at[found]], data, start[word[found]] + n, length)]
            if not len(found):
                continue
            mine, before = ids[at[found]], nodes[n - length][word[found]]
            prior = last[n - length][before]
            ok = self.alone[mine] if n == length else prior >= 0
            if n != length and ok.any():
                ok[ok] = self.fits(prior[ok], mine[ok])
            hit = open_[found[ok]]
            token[hit], total[hit] = mine[ok], count[n - length][before[ok]] + 1
            open_ = np.setdiff1d(open_, hit, assume_unique=True)
        return token, total

    def _ends_with(self, tokens: np.ndarray, data: np.ndarray, end: np.ndarray, length: int) -> np.ndarray:
        """Whether each token is the ``length`` bytes of ``data`` before its end."""
        first = self.bytes_first[tokens]
        same = self.bytes_first[tokens + 1] - first == length
        for k in range(length):
            at = np.flatnonzero(same)
            same[at] = self.bytes[first[at] + k] == data[end[at] - length + k]
        return same

    def learn(self, pieces: list[str]) -> None:
        """Tables for the new words of the pieces, and each piece's count, its last entry."""
        lists = [self.bpe.words(p) for p in pieces]
        own = [w for w in dict.fromkeys(w for x in lists for w in x) if w not in self.words]
        usual = [w for w in own if w[0] != " "]
        flat, first = self.word_tables(usual) if usual else (np.zeros(0, np.int32), np.zeros(1, np.int64))
        special = len(own) - len(usual)
        self.words.update(zip([*usual, *(w for w in own if w[0] == " ")], range(len(self.words), len(self.words) + len(own))))
        self.flat = np.concatenate([self.flat, flat, np.ones(special, np.int32)])
        ends = np.append(first[1:], first[-1] + 1 + np.arange(special))
        self.first = np.concatenate([self.first, self.first[-1] + ends])
        picks = np.array([self.words[w] for x in lists for w in x], np.int64)
        sums = np.append(0, np.cumsum(self.flat[self.first[picks + 1] - 1]))
        stops = np.cumsum([len(x) for x in lists])
        self.known.update(zip(pieces, range(len(self.known), len(self.known) + len(pieces))))
        self.totals = np.concatenate([self.totals, sums[stops] - sums[np.append(0, stops[:-1])]])

    def piece_table(self, piece: str) -> np.ndarray:
        """The counts of a known piece's prefixes of 1, 2, ... code points."""
        out, done, at = np.zeros(len(piece), np.int64), 0, 0
        for w in self.bpe.words(piece):
            i, a = self.words[w], piece.index(w, at)
            out[at:a], at = done, a + len(w)
            out[a:at] = done + self.flat[self.first[i]:self.first[i + 1]]
            done = int(out[at - 1])
        out[at:] = done
        return out

    def number(self, pieces: list[str]) -> np.ndarray:
        new = set(pieces).difference(self.known)
        if len(self.known) + len(new) > MEMORY:
            self.forget()
            new = set(pieces)
        if new:
            self.learn(sorted(new))
        return np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))

    def totals_of(self, texts: list[str]) -> np.ndarray:
        """The last entry of each text's table."""
        lists = [self.bpe.pieces(t) for t in texts]
        size = np.array([len(x) for x in lists], np.int64)
        picks = self.number([p for x in lists for p in x])
        sums = np.append(0, np.cumsum(self.totals[picks]))
        ends = np.cumsum(size)
        return sums[ends] - sums[ends - size]

    def normal(self, text: str) -> str:
        parts = self.bpe.parts.split(text)
        return "".join(p if k % 2 else _small(p) for k, p in enumerate(parts))

    def table(self, text: str) -> np.ndarray:
        """The number of tokens of the first 0, 1, ... code points of the normalised text."""
        out, done, before = [np.zeros(1, np.int64)], 0, ""
        for k, part in enumerate(self.bpe.parts.split(text)):
            if k % 2:
                whole = self.bpe.pieces(before)
                base = done - int(self.totals[self.number(whole)].sum())
                cut = [base + int(self.totals_of([before + part[:i]])[0]) for i in range(1, len(part))]
                done += 1
                out.append(np.array([*cut, done], np.int64))
                before = ""
                continue
            pieces = self.bpe.plain(part)
            for j, (i, piece) in enumerate(zip(self.number(pieces).tolist(), pieces)):
                if j:
                    out.append(np.array([done], np.int64))  # the blank between two pieces
                out.append(self.piece_table(piece) + done)
                done += int(self.totals[i])
            before = pieces[-1]
        return np.concatenate(out)


def _small(text: str) -> str:
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()




@cache
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def prefix_tables(docs: DataFrame, path: str) -> DataFrame:
    """Per row ``doc_id``, the normalised ``text``, and ``counts``: its table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefixes = counter(path)
        for chunk in chunks(batches):
            texts = strings(chunk["text"]).to_pylist()
            yield pa.RecordBatch.from_arrays([
                chunk["doc_id"].combine_chunks(),
                pa.array([prefixes.normal(t) for t in texts], pa.string()),
                pa.array([prefixes.table(t).astype(np.int32) for t in texts], pa.list_(pa.int32())),
            ], ["doc_id", "text", "counts"])

    return _rows(docs).mapInArrow(run, "doc_id bigint, text string, counts array<int>")


def truncate(tables: DataFrame, budget: int) -> DataFrame:
    """The longest prefix of each text with at most ``budget`` tokens, from its stored table."""
    upto = F.array_max(F.filter(F.transform("counts", lambda n, i: F.when(n <= budget, i)), lambda i: i.isNotNull()))
    return tables.select("doc_id", F.substring("text", F.lit(1), upto).alias("text"),
                         F.get("counts", upto).alias("n_tokens"))


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """Per row its bytes, its tokens, and whether these are more than ``limit``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefixes = counter(path)
        for chunk in chunks(batches):
            texts = strings(chunk["text"])
            n = prefixes.totals_of(texts.to_pylist())
            yield pa.RecordBatch.from_arrays(
                [chunk["doc_id"].combine_chunks(), pc.cast(pc.binary_length(texts), pa.int64()), pa.array(n),
                 pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return _rows(docs).mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_vocabulary())
