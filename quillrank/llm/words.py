"""Words of many texts at once, as numpy arrays over one byte buffer.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D (so Unicode
spaces stay inside words). :func:`scan` takes an Arrow string array and gives
the place, the text and the 64-bit hash of every word without a Python
object per word; n-gram hashes are built from word hashes by whole-array
arithmetic. Two different words or n-grams share a hash with a chance of
about 2**-64.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TABLE = np.random.Generator(np.random.PCG64(20260101)).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so invertible modulo 2**64
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
#: Bytes handled at once; a longer single text is one block of its own.
BLOCK = 1 << 16


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finalizer on uint64 (the published splitmix64 constants)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse, kept for the next call up to one block."""
    if len(_powers[0]) <= n:
        out = []
        for base in (_BASE, _INVERSE):
            p = np.full(n + 1, base, dtype=np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        if n <= 2 * BLOCK:
            _powers[:] = out
        return out[0], out[1]
    return _powers[0][: n + 1], _powers[1][: n + 1]


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span of ``data`` (equal bytes, equal hash)."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    p, inverse = _power(len(data))
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    parts = _TABLE.take(data)
    parts *= p[:-1]
    np.cumsum(parts, out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * _BASE)


@dataclass
class Words:
    """Words of a run of rows: ``row[i]`` to ``row[i + 1]`` are those of row i."""

    data: np.ndarray  # the bytes, lower-cased where asked for
    text: np.ndarray  # start of each row's bytes, and the end
    starts: np.ndarray
    ends: np.ndarray
    hash: np.ndarray
    row: np.ndarray

    def __len__(self) -> int:
        return len(self.row) - 1

    def of(self, i: int) -> np.ndarray:
        return self.hash[self.row[i] : self.row[i + 1]]

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the n-word windows of each row, and where each row's begin.

        A row with fewer than n words, but at least one, has one gram: all its
        words. A row without words has none.
        """
        count = np.diff(self.row)
        if not len(self.hash):
            return np.zeros(0, dtype=np.uint64), np.zeros(len(self.row), dtype=np.int64)
        h = gram_hash(self.hash, n)
        kept = np.where(count >= n, count - n + 1, np.minimum(count, 1))
        out = np.concatenate([[0], np.cumsum(kept)])
        index = np.repeat(self.row[:-1] - out[:-1], kept) + np.arange(out[-1])
        picked = h[np.minimum(index, len(h) - 1)] if len(h) else np.zeros(len(index), dtype=np.uint64)
        for i in np.flatnonzero((count > 0) & (count < n)):
            picked[out[i]] = whole_hash(self.of(i))
        return picked, out


def gram_hash(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each window of n word hashes, in order."""
    m = max(0, len(words) - n + 1)
    h = np.full(m, n, dtype=np.uint64)
    for k in range(n):
        h = mix(h * _BASE + words[k : k + m])
    return h


def whole_hash(words: np.ndarray) -> np.uint64:
    """Hash of one whole (short) word sequence; as gram_hash for len(words)."""
    return gram_hash(words, len(words))[0]


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    return (np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, dtype=np.uint8)), offsets


def scan(column: pa.Array, lower: bool = False, fold: np.ndarray | None = None):
    """Yield ``(first row, Words)`` over blocks of about ``BLOCK`` bytes; a null text is an empty one.

    ``lower`` makes A-Z small; ``fold`` maps bytes by a table of 256 before words are cut.
    """
    fold = _LOWER if lower and fold is None else fold
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    data, offsets = _buffers(column)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + BLOCK, side="right")) - 1)
        last = min(last, n)
        a, b = int(offsets[first]), int(offsets[last])
        block = data[a:b]
        if fold is _LOWER:  # by arithmetic, which takes a quarter of the time of looking every byte up
            block = block + ((block - np.uint8(65) < 26).view(np.uint8) << 5)
        elif fold is not None:
            block = fold[block]
        text = offsets[first : last + 1] - a
        edge = np.ones(len(block) + 2, dtype=bool)
        np.logical_or(block == 0x20, block - np.uint8(9) < 5, out=edge[1:-1])
        begins = edge[:-1] & ~edge[1:]
        stops = ~edge[:-1] & edge[1:]
        cuts = text[1:-1]  # a word ends where its row ends, whatever byte follows
        cuts = cuts[(cuts > 0) & (cuts < len(block))]
        cuts = cuts[~edge[cuts] & ~edge[cuts + 1]]
        begins[cuts] = stops[cuts] = True
        starts, ends = np.flatnonzero(begins), np.flatnonzero(stops)
        row = np.searchsorted(starts, text)
        yield first, Words(block, text, starts, ends, span_hash(block, starts, ends), row)
        first = last
