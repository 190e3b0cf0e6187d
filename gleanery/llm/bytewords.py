"""Words of Arrow texts as numpy arrays: positions and 64-bit hashes, without a Python loop over words.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]``; in UTF-8 that is the same as a run of characters.
A null text is an empty text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_TABLE = np.random.default_rng(20240229).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _TABLE.copy()
_FOLDED[65:91] = _TABLE[97:123]
_CHUNK = 1 << 20


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out, dtype=np.uint64)


_UP, _DOWN = _powers(_BASE, _CHUNK), _powers(_INVERSE, _CHUNK)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    return x


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and the offsets of its rows; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        empty = pa.scalar(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "", column.type)
        column = column.fill_null(empty)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    _, offsets, data = column.buffers()
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def row_slices(offsets: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``limit`` bytes each; a longer row is alone."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield at, to
        at = to


@dataclass
class Words:
    """``start``/``end``: byte places in the buffer; ``first``: index of each row's first word, with one more at the end."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def find_words(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = SPACE) -> Words:
    """The words of all rows; ``breaks`` tells for each byte whether it stands between words."""
    inside = np.zeros(len(data) + 2, bool)
    np.logical_not(breaks[data], out=inside[1:-1])
    starts = inside[1:-1] & ~inside[:-2]
    edges = offsets[1:-1]
    edges = edges[edges < len(data)]
    starts[edges] = inside[1:-1][edges]  # a word never runs on into the next row
    ends = inside[1:-1] & ~inside[2:]
    cut = edges[edges > 0] - 1
    ends[cut] = inside[1:-1][cut]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return Words(start, end, np.searchsorted(start, offsets))


def word_hashes(data: np.ndarray, words: Words, fold: bool = False) -> np.ndarray:
    """64-bit hashes of the words' bytes; ``fold`` reads A-Z as a-z. Equal words have equal hashes everywhere."""
    table = _FOLDED if fold else _TABLE
    out = np.empty(len(words.start), np.uint64)
    at = 0
    while at < len(words.start):
        base = words.start[at]
        to = max(at + 1, np.searchsorted(words.end, base + _CHUNK, side="right"))
        span = data[base : words.end[to - 1]]
        n = len(span)
        up, down = (_UP[:n], _DOWN) if n <= _CHUNK else (_powers(_BASE, n), _powers(_INVERSE, n))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(table[span] * up, out=sums[1:])
        s, e = words.start[at:to] - base, words.end[at:to] - base
        out[at:to] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64)
        at = to
    return mix(out)


def windows(hashes: np.ndarray, words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (word index) and hashes of all runs of ``width`` words within one row."""
    n = len(hashes)
    if n < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    left = np.repeat(words.first[1:], np.diff(words.first)) - np.arange(n)  # words from here to the row's end
    total = np.zeros(n - width + 1, np.uint64)
    for k in range(width):
        total *= np.uint64(0xD6E8FEB86659FD93)
        total += hashes[k : n - width + 1 + k]
    at = np.flatnonzero(left[: n - width + 1] >= width)
    return at, mix(total[at])
