"""FM-index over integer sequences: wavelet-matrix ranks, vectorised backward search, sampled positions.

Symbol 0 is the terminator; it ends every run and never occurs in a phrase. Terminators sort by position, so the
suffix sort ends after log2(longest run) doublings however often a run repeats.
"""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; each 0 counts as a symbol of its own, ordered by position."""
    n = len(text)
    stops = np.flatnonzero(text == 0)
    rank = text.astype(np.int64) + len(stops)
    rank[stops] = np.arange(len(stops))
    order = np.argsort(rank, kind="stable")
    k = 1
    while True:
        sorted_rank = rank[order]
        changed = np.empty(n, dtype=bool)
        if n:
            changed[0] = True
        np.not_equal(sorted_rank[1:], sorted_rank[:-1], out=changed[1:])
        dense = np.cumsum(changed) - 1
        rank = np.empty(n, dtype=np.int64)
        rank[order] = dense
        if n == 0 or dense[-1] == n - 1:
            return order
        following = np.zeros(n, dtype=np.int64)
        following[: n - k] = rank[k:] + 1
        rank = rank * (n + 1) + following
        order = np.argsort(rank, kind="stable")
        k *= 2


class WaveletMatrix:
    """rank and access on a sequence of symbols below 2 ** levels."""

    def __init__(self, symbols: np.ndarray, levels: int) -> None:
        self.levels = levels
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        rest = symbols.astype(np.int64)
        for level in range(levels - 1, -1, -1):
            bits = (rest >> level) & 1
            counts = np.zeros(len(rest) + 1, dtype=np.int32)
            np.cumsum(bits, out=counts[1:])
            self.ones.append(counts)
            self.zeros.append(int(len(rest) - counts[-1]))
            rest = np.concatenate([rest[bits == 0], rest[bits == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before position `at`."""
        start = np.zeros_like(at)
        for i, level in enumerate(range(self.levels - 1, -1, -1)):
            one = ((symbol >> level) & 1).astype(bool)
            a, b = self.ones[i][start], self.ones[i][at]
            start = np.where(one, a + self.zeros[i], start - a)
            at = np.where(one, b + self.zeros[i], at - b)
        return at - start

    def access(self, at: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(at)
        for i in range(self.levels):
            ones = self.ones[i]
            bit = ones[at + 1] - ones[at]
            symbol = symbol * 2 + bit
            at = np.where(bit == 1, ones[at] + self.zeros[i], at - ones[at])
        return symbol


class FMIndex:
    def __init__(self, text: np.ndarray, symbols: int, every: int = 32) -> None:
        """text: runs of symbols from 1 to `symbols`, each ended by a 0."""
        order = suffix_order(text)
        before = np.where(order > 0, text[order - 1], 0)
        self.n = len(text)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols + 1))]).astype(np.int64)
        self.tree = WaveletMatrix(before, max(1, int(symbols).bit_length()))
        # a run's first position is always sampled, so that no walk crosses a terminator
        sampled = (order % every == 0) | (before == 0)
        self.sample_rank = np.concatenate([[0], np.cumsum(sampled)])
        self.samples = order[sampled]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row interval of each phrase; phrases stand right-aligned in the columns."""
        width = phrases.shape[1]
        low, high = np.zeros(len(phrases), dtype=np.int64), np.full(len(phrases), self.n, dtype=np.int64)
        for step in range(width):
            live = np.flatnonzero((step < lengths) & (low < high))
            if not len(live):
                break
            symbol = phrases[live, width - 1 - step]
            low[live] = self.first[symbol] + self.tree.rank(symbol, low[live])
            high[live] = self.first[symbol] + self.tree.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows, by walking to the nearest sampled one."""
        found = np.empty(len(rows), dtype=np.int64)
        left, row, steps = np.arange(len(rows)), rows.astype(np.int64), 0
        while len(left):
            known = self.sample_rank[row + 1] > self.sample_rank[row]
            found[left[known]] = self.samples[self.sample_rank[row[known]]] + steps
            left, row = left[~known], row[~known]
            if len(left):
                symbol = self.tree.access(row)
                row = self.first[symbol] + self.tree.rank(symbol, row)
            steps += 1
        return found
