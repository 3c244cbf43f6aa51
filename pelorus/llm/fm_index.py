"""An FM-index over a sequence of word ids: suffix array, wavelet-matrix ranks, backward search, sampled positions.

All operations are vectorised over many patterns or rows at once.
"""

from __future__ import annotations

import numpy as np


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Order of all suffixes by prefix doubling; the end of the sequence sorts first."""
    n = len(seq)
    _, rank = np.unique(seq, return_inverse=True)
    rank = rank.astype("int64")
    order = np.argsort(rank, kind="stable")
    step = 1
    while n:
        second = np.zeros(n, "int64")
        second[: n - step] = rank[step:] + 1 if step < n else 0
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.empty(n, "int64")
        new[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        rank = new
        if rank[order[-1]] == n - 1:
            break
        step *= 2
    return order


class WaveletMatrix:
    """Ranks of symbols in a sequence, one bit level at a time."""

    def __init__(self, seq: np.ndarray):
        self.bits = max(1, int(seq.max(initial=0)).bit_length())
        self.levels: list[np.ndarray] = []
        self.zeros: list[int] = []
        self.planes: list[np.ndarray] = []
        current = seq
        for level in range(self.bits - 1, -1, -1):
            bit = (current >> level) & 1
            self.planes.append(bit.astype("u1"))
            self.levels.append(np.concatenate([[0], np.cumsum(bit)]))
            self.zeros.append(int(len(bit) - bit.sum()))
            current = np.concatenate([current[bit == 0], current[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        low, high = np.zeros_like(at), at.copy()
        for i, (ones, zeros) in enumerate(zip(self.levels, self.zeros, strict=True)):
            bit = (symbol >> (self.bits - 1 - i)) & 1
            low = np.where(bit == 1, zeros + ones[low], low - ones[low])
            high = np.where(bit == 1, zeros + ones[high], high - ones[high])
        return high - low

    def access(self, at: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(at)
        for plane, ones, zeros in zip(self.planes, self.levels, self.zeros, strict=True):
            bit = plane[at]
            symbol = symbol << 1 | bit
            at = np.where(bit == 1, zeros + ones[at], at - ones[at])
        return symbol


class FMIndex:
    """Over ``seq`` of symbols >= 1; symbol 0 is kept for the end."""

    def __init__(self, seq: np.ndarray, sample: int = 8):
        text = np.concatenate([np.asarray(seq, "int64"), [0]])
        order = suffix_array(text)
        self.n = len(text)
        self.last = WaveletMatrix(text[order - 1])
        self.start = np.concatenate([[0], np.cumsum(np.bincount(text))])
        marked = order % sample == 0
        self.marked = marked
        self.before = np.concatenate([[0], np.cumsum(marked)])
        self.places = order[marked]

    def find(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of patterns, which are right-aligned rows of ``patterns``."""
        low, high = np.zeros(len(patterns), "int64"), np.full(len(patterns), self.n, "int64")
        width = patterns.shape[1]
        for k in range(width):
            live = np.flatnonzero((lengths > k) & (low < high))
            if not len(live):
                break
            symbol = patterns[live, width - 1 - k]
            known = symbol < len(self.start) - 1
            high[live[~known]] = low[live[~known]]
            live, symbol = live[known], symbol[known]
            low[live] = self.start[symbol] + self.last.rank(symbol, low[live])
            high[live] = self.start[symbol] + self.last.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: step backwards to a sampled row and add the steps."""
        out, rows, todo, steps = np.zeros(len(rows), "int64"), rows.copy(), np.arange(len(rows)), 0
        while len(todo):
            at = rows[todo]
            done = self.marked[at]
            out[todo[done]] = self.places[self.before[at[done]]] + steps
            todo, at = todo[~done], at[~done]
            symbol = self.last.access(at)
            rows[todo] = self.start[symbol] + self.last.rank(symbol, at)
            steps += 1
        return out
