"""An FM-index over a sequence of symbols, searched for many phrases at once, in numpy."""

from __future__ import annotations

import numpy as np

SAMPLE = 16


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array by doubling. Symbol 0 ends a piece; earlier ends sort first, so suffixes differ."""
    n = len(text)
    ends = text == 0
    rank = text.astype(np.int64) + int(ends.sum())
    rank[ends] = np.arange(int(ends.sum()))
    order = np.argsort(rank, kind="stable")
    step = 1
    while True:
        sorted_rank = rank[order]
        fresh = np.concatenate(([True], sorted_rank[1:] != sorted_rank[:-1]))
        dense = np.empty(n, np.int64)
        dense[order] = np.cumsum(fresh) - 1
        if fresh.all():
            return order
        ahead = np.zeros(n, np.int64)
        ahead[:n - step] = dense[step:] + 1
        rank = dense * (n + 1) + ahead
        order = np.argsort(rank, kind="stable")
        step *= 2


class Wavelet:
    """Wavelet matrix: rank of a symbol before a position, and the symbol at a position."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.depth = max(1, int(size - 1).bit_length())
        self.zeros_before, self.zeros, self.bits = [], [], []
        current = symbols
        for level in reversed(range(self.depth)):
            bit = (current >> level) & 1
            before = np.zeros(len(current) + 1, np.int32)
            np.cumsum(1 - bit, out=before[1:])
            self.bits.append(bit.astype(bool))
            self.zeros_before.append(before)
            self.zeros.append(int(before[-1]))
            current = np.concatenate([current[bit == 0], current[bit == 1]])
        # Where each symbol's run starts in the last level.
        self.starts = self._down(np.arange(size), np.zeros(size, np.int64))

    def _down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k, level in enumerate(reversed(range(self.depth))):
            before = self.zeros_before[k][at]
            at = np.where((symbols >> level) & 1, self.zeros[k] + at - before, before)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self._down(symbols, at) - self.starts[symbols]

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols at positions, and how many equal ones stand before each."""
        symbols = np.zeros(len(at), np.int64)
        for k in range(self.depth):
            bit = self.bits[k][at]
            before = self.zeros_before[k][at]
            symbols = symbols * 2 + bit
            at = np.where(bit, self.zeros[k] + at - before, before)
        return symbols, at - self.starts[symbols]


class FmIndex:
    """Index of ``text`` over symbols 1 .. size-1; each piece ends with a 0, the last one too."""

    def __init__(self, text: np.ndarray, size: int):
        order = suffix_order(text)
        self.wavelet = Wavelet(text[order - 1].astype(np.int64), size)
        self.below = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=size))))
        # Sampled rows: every SAMPLE-th position and each start of a piece, so no walk leaves its piece.
        kept = order % SAMPLE == 0
        kept |= text[order - 1] == 0
        self.sampled = kept
        self.sample_of = np.cumsum(kept) - 1
        self.samples = order[kept]
        self.n = len(text)

    def search(self, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of the phrases ``symbols[start:start + length]``, by backward search."""
        low, high = np.zeros(len(starts), np.int64), np.full(len(starts), self.n, np.int64)
        alive = np.arange(len(starts))
        for step in range(int(lengths.max(initial=0))):
            alive = alive[(lengths[alive] > step) & (low[alive] < high[alive])]
            if not len(alive):
                break
            symbol = symbols[starts[alive] + lengths[alive] - 1 - step]
            for edge in (low, high):
                edge[alive] = self.below[symbol] + self.wavelet.rank(symbol, edge[alive])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows, by walking back to a sampled one."""
        at, steps = rows.copy(), np.zeros(len(rows), np.int64)
        walking = np.flatnonzero(~self.sampled[at])
        while len(walking):
            symbol, before = self.wavelet.access(at[walking])
            at[walking] = self.below[symbol] + before
            steps[walking] += 1
            walking = walking[~self.sampled[at[walking]]]
        return self.samples[self.sample_of[at]] + steps
