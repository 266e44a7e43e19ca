"""Words and their hashes for many texts at once, in numpy.

A word is ``[^\\x20\\x09-\\x0D]+`` over the UTF-8 bytes. Hashes are 64 bits wide: the sum of a mixed
value of each byte with its place in the word, mixed again. (A polynomial modulo 2**64 would give words made
for it, such as a Thue-Morse sequence and its mirror, one hash.) Every function here works on one
chunk of texts inside a task; nothing is kept between chunks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that a task works on at once.
CHUNK_BYTES = 2_000_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEPS = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
                   0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F,
                   0xEB44ACCAB455D165, 0x9C6E6877736C46E3], dtype=np.uint64)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: ``mix(place << 8 | byte)`` for the first places of a word.
_PLACED = mix(np.arange(64 * 256, dtype=np.uint64))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) <= n:
        size = max(n + 1, CHUNK_BYTES)
        up, down = np.full(size, _BASE), np.full(size, _INVERSE)
        up[0] = down[0] = 1
        _powers = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    return _powers


@dataclass
class Words:
    """The words of some texts: byte spans in ``data``, hashes, and where each text's begin."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def words(self, i: int) -> list[bytes]:
        """The words of text ``i``."""
        a, b = self.first[i], self.first[i + 1]
        if a == b:
            return []
        base = int(self.start[a])
        text = self.data[base:self.end[b - 1]].tobytes()
        return [text[s - base:e - base]
                for s, e in zip(self.start[a:b].tolist(), self.end[a:b].tolist(), strict=True)]


def strings(column: pa.Array) -> pa.Array:
    """The column as one array of plain strings; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.type != pa.string():
        column = column.cast(pa.string())
    return pc.fill_null(column, "") if column.null_count else column


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array without nulls, and the offset of each text in them."""
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def find_words(column: pa.Array, lower: bool = False) -> Words:
    """The words of a string array without nulls; ``lower`` turns A-Z into a-z first."""
    data, at = text_bytes(column)
    if lower:
        data = _LOWER[data]
    n = len(data)
    inside = np.zeros(n + 2, dtype=bool)
    inside[1:-1] = ~_BLANK[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[at] = True
    start = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    end = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    return Words(data, start, end, word_hashes(data[inside[1:-1]], end - start), np.searchsorted(start, at))


def word_hashes(data: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A hash per word; ``data`` is the bytes of all words end to end, ``size`` how many each has, one at least."""
    if not len(size):
        return np.zeros(0, np.uint64)
    begin = np.cumsum(size) - size
    place = np.arange(len(data)) - np.repeat(begin, size)
    near = np.minimum(place, len(_PLACED) // 256 - 1) << 8 | data
    value = _PLACED[near]
    far = np.flatnonzero(place >= len(_PLACED) // 256)
    if len(far):
        value[far] = mix(place[far].astype(np.uint64) << np.uint64(8) | data[far])
    return mix(np.add.reduceat(value, begin) + size.astype(np.uint64) * _STEPS[7])


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of every run of ``size`` words, wherever texts begin or end."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    if size <= len(_STEPS):
        total = np.full(n, np.uint64(size))
        for k in range(size):
            total += hashes[k:k + n] * _STEPS[k]
        return mix(total)
    up, down = _powers_to(len(hashes))
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[:len(hashes)], out=sums[1:])
    return mix((sums[size:] - sums[:n]) * down[:n] + np.uint64(size))


def gram_places(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where a run of ``size`` words lies within one text, and that text's number."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    begin = np.cumsum(counts) - counts
    at = np.arange(len(owner)) - begin[owner] + first[:-1][owner]
    return at, owner


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = CHUNK_BYTES) -> Iterator[pa.Table]:
    """The batches cut into tables of about ``limit`` bytes of text; a longer text is alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        upto, a = np.cumsum(size), 0
        while a < batch.num_rows:
            done = upto[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(upto, done + limit, side="right")))
            yield pa.Table.from_batches([batch.slice(a, b - a)])
            a = b
