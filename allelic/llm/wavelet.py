"""Rank structures over small alphabets, answered for many places at once."""

from __future__ import annotations

import numpy as np


class BitRanks:
    """Number of ones before a place of a bit vector: a count per 64-bit word
    and the ones of the last word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, "<u8")
        self.words.view(np.uint8)[:len(packed)] = packed
        self.before = np.zeros(len(self.words) + 1, np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])

    @property
    def ones(self) -> int:
        return int(self.before[-1])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)

    def select(self, nth: np.ndarray) -> np.ndarray:
        """The place of each ``nth`` one (from 0), by bisection on ranks."""
        return bisect_rank(self.rank, nth + 1, np.zeros_like(nth), np.full_like(nth, 64 * len(self.words) - 1)) - 1


def bisect_rank(rank, wanted: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each query the smallest place in (low, high] whose rank is at least
    ``wanted``; ``rank`` never falls, and reaches it at ``high``."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = np.flatnonzero(high - low > 1)
        if not len(open_):
            return high
        middle = (low[open_] + high[open_]) >> 1
        reached = rank(middle) >= wanted[open_]
        high[open_[reached]] = middle[reached]
        low[open_[~reached]] = middle[~reached]


class WaveletMatrix:
    """A sequence of symbols below 2^``levels``, one bit vector per level from
    the highest bit; each level is ordered by the bits above, zeros first."""

    def __init__(self, symbols: np.ndarray, levels: int):
        self.levels: list[tuple[BitRanks, int]] = []
        for level in range(levels - 1, -1, -1):
            bits = (symbols >> level) & 1 == 1
            ranks = BitRanks(bits)
            self.levels.append((ranks, len(symbols) - ranks.ones))
            symbols = np.concatenate([symbols[~bits], symbols[bits]])
        self.size = len(symbols)

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` before each place."""
        first, last = np.zeros(1, np.int64), at
        for depth, (ranks, zeros) in enumerate(self.levels):
            if symbol >> (len(self.levels) - 1 - depth) & 1:
                first, last = zeros + ranks.rank(first), zeros + ranks.rank(last)
            else:
                first, last = first - ranks.rank(first), last - ranks.rank(last)
        return last - first
