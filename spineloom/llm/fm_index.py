"""An FM-index over integer symbols, built and searched with NumPy.

The text is a row of symbols in which 0 ends a run; ends of runs differ from each other, so no match crosses one. The index is
the Burrows-Wheeler transform in a wavelet matrix (one bit vector with counted ranks per bit of the alphabet), the
first row of every symbol, and the text positions of a sample of the rows.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 16


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes in order, by prefix doubling; only suffixes that still tie are sorted again."""
    n = text.size
    ends = text == 0
    first = text.astype(np.int64) + int(ends.sum())
    first[ends] = np.arange(ends.sum())
    order = np.argsort(first, kind="stable")
    ranked = first[order]
    fresh = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    width = 1
    while True:
        starts = np.flatnonzero(fresh)
        sizes = np.diff(np.concatenate((starts, [n])))
        tied = np.repeat(sizes > 1, sizes)
        rows = np.flatnonzero(tied)
        if not rows.size:
            return order
        at = order[rows]
        # A tied suffix is longer than width: it ties over width symbols, the last of which would else be its own end.
        keys = rank[at + width]
        again = np.lexsort((keys, rank[at]))
        at, keys = at[again], keys[again]
        order[rows] = at
        group = rank[at]
        new = np.concatenate(([True], (group[1:] != group[:-1]) | (keys[1:] != keys[:-1])))
        fresh[rows] |= new
        rank[at] = np.maximum.accumulate(np.where(new, rows, 0))
        width *= 2


class WaveletMatrix:
    """Rank of symbols: the bits of all symbols, highest first, each level a stable split of the one above by its bit."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.n_bits = max(1, int(n_symbols - 1).bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        level = symbols.astype(np.int64)
        for bit in range(self.n_bits - 1, -1, -1):
            up = (level >> bit) & 1 == 1
            self.ones.append(np.concatenate(([0], np.cumsum(up))).astype(np.int32))
            self.zeros.append(int(up.size - self.ones[-1][-1]))
            level = np.concatenate((level[~up], level[up]))
        # Where each symbol begins on the last level.
        self.begin = np.searchsorted(self._reversed(level), self._reversed(np.arange(n_symbols)))

    def _reversed(self, symbols: np.ndarray) -> np.ndarray:
        """The last level is in the order of the symbols' bits read backwards."""
        out = np.zeros_like(symbols)
        for bit in range(self.n_bits):
            out |= ((symbols >> bit) & 1) << (self.n_bits - 1 - bit)
        return out

    def rank(self, symbols: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its row."""
        at = rows
        for k, ones in enumerate(self.ones):
            up = (symbols >> (self.n_bits - 1 - k)) & 1 == 1
            before = ones[at]
            at = np.where(up, self.zeros[k] + before, at - before)
        return at - self.begin[symbols]

    def access(self, rows: np.ndarray) -> np.ndarray:
        """The symbol in each row."""
        at, out = rows, np.zeros(rows.size, np.int64)
        for k, ones in enumerate(self.ones):
            before = ones[at]
            up = ones[at + 1] > before
            out = (out << 1) | up
            at = np.where(up, self.zeros[k] + before, at - before)
        return out


class FMIndex:
    def __init__(self, text: np.ndarray, n_symbols: int):
        """``text``: symbols below ``n_symbols``, the last one 0."""
        order = suffix_array(text)
        self.bwt = WaveletMatrix(text[order - 1], n_symbols)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=n_symbols))))[:-1]
        opens = np.concatenate(([True], text[:-1] == 0))
        sampled = opens | (np.arange(text.size) % SAMPLE == 0)
        self.sampled = sampled[order]
        self.sample_rank = np.concatenate(([0], np.cumsum(self.sampled)))
        self.positions = order[self.sampled]
        self.size = text.size

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last-plus-one row of each phrase (rows of ``phrases``, right-aligned): backward search of all."""
        lo, hi = np.zeros(lengths.size, np.int64), np.full(lengths.size, self.size, np.int64)
        for step in range(1, phrases.shape[1] + 1):
            live = np.flatnonzero((lengths >= step) & (lo < hi))
            if not live.size:
                break
            symbols = phrases[live, -step]
            lo[live] = self.first[symbols] + self.bwt.rank(symbols, lo[live])
            hi[live] = self.first[symbols] + self.bwt.rank(symbols, hi[live])
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: step back until a sampled row is met."""
        at, steps = rows.copy(), np.zeros(rows.size, np.int64)
        live = np.flatnonzero(~self.sampled[at])
        while live.size:
            symbols = self.bwt.access(at[live])
            at[live] = self.first[symbols] + self.bwt.rank(symbols, at[live])
            steps[live] += 1
            live = live[~self.sampled[at[live]]]
        return self.positions[self.sample_rank[at]] + steps
