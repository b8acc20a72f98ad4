"""Words, word hashes and shingles of whole text columns, in numpy.

A string column arrives as one byte buffer with offsets. Everything here works on slices of
such a buffer (whole texts, a few megabytes together), so the memory of a task is bounded by
its longest text and not by its number of rows.

A hash is a polynomial over the bytes modulo 2^64 with a finishing mix. Equal words have equal
hashes; of a billion different words, two share one with a chance of about one in forty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS = {_BASE: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def word_bytes(separators: Iterator[int]) -> np.ndarray:
    """Flag per byte: true inside a word."""
    flags = np.ones(256, bool)
    flags[list(separators)] = False
    return flags


# White space ends a word.
SPACED = word_bytes([0x20, *range(0x09, 0x0E)])
# Only letters, digits and bytes of other alphabets are inside a word.
PLAIN = word_bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64; the table is kept and doubled as longer texts come."""
    table = _POWERS[base]
    while len(table) < n:
        step = np.uint64(pow(base, len(table), 1 << 64))
        table = np.concatenate([table, table * step])
    _POWERS[base] = table
    return table[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the public 64-bit finaliser)."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


@dataclass
class Slice:
    """Whole texts of rows ``first`` to ``first + len(null) - 1`` of a batch."""

    first: int
    data: np.ndarray
    offsets: np.ndarray
    null: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.null)


def slices(column: pa.Array, most_bytes: int = SLICE_BYTES) -> Iterator[Slice]:
    """The column in runs of whole texts of about ``most_bytes``; a longer text comes alone."""
    column = column.cast(pa.large_string())
    null = np.asarray(column.is_null())
    _, offsets, data = column.buffers()
    n = len(column)
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    low = 0
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + most_bytes, side="right")) - 1
        high = min(n, max(high, low + 1))
        start, stop = int(offsets[low]), int(offsets[high])
        yield Slice(low, data[start:stop], offsets[low:high + 1] - start, null[low:high])
        low = high


@dataclass
class Words:
    """Words of a slice in order: byte ranges, hashes, and each row's range of words."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray

    def rows(self) -> np.ndarray:
        """Row of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Sums of byte times power up to each position; see :func:`range_hashes`."""
    terms = data.astype(np.uint64)
    terms += np.uint64(1)
    terms *= _powers(_BASE, len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(terms, out=sums[1:])
    return sums


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash per byte range, the same wherever the bytes stand."""
    return mix((sums[ends] - sums[starts]) * _powers(_INVERSE, len(sums))[starts])


def split_words(part: Slice, inside: np.ndarray, lower: bool = True) -> Words:
    """Maximal runs of ``inside`` bytes in each text; A-Z become a-z first."""
    data = LOWER[part.data] if lower else part.data
    flags = np.zeros(len(data) + 2, bool)
    flags[1:-1] = inside[data]
    within, before, after = flags[1:-1], flags[:-2].copy(), flags[2:].copy()
    edges = part.offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    before[edges] = False
    after[edges - 1] = False
    starts = np.flatnonzero(within & ~before)
    ends = np.flatnonzero(within & ~after) + 1
    bounds = np.searchsorted(starts, part.offsets)
    return Words(starts, ends, range_hashes(prefix_hashes(data), starts, ends), bounds)


def shingle_sets(words: Words, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of ``width`` consecutive words per row, ascending, and each row's bounds.

    A row with fewer words, but not none, has the whole sequence as its one shingle.
    """
    n = len(words.hashes)
    factor = np.uint64(_BASE)
    counts = np.diff(words.bounds)
    rolled = np.zeros(max(n - width + 1, 0), np.uint64)
    for k in range(width):
        rolled *= factor
        rolled += words.hashes[k:k + len(rolled)]
    rolled = mix(rolled)
    sets, bounds = [], np.zeros(len(counts) + 1, np.int64)
    for row, count in enumerate(counts):
        low, high = words.bounds[row], words.bounds[row + 1]
        if count >= width:
            found = np.sort(rolled[low:high - width + 1])
            if len(found) > 1:
                found = found[np.concatenate(([True], found[1:] != found[:-1]))]
        elif count:
            total = np.uint64(count)
            with np.errstate(over="ignore"):
                for value in words.hashes[low:high]:
                    total = total * factor + value
            found = mix(np.array([total], np.uint64))
        else:
            found = np.zeros(0, np.uint64)
        sets.append(found)
        bounds[row + 1] = bounds[row] + len(found)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), bounds
