"""Compressed FM-index over word numbers: suffix sorting, wavelet matrix, backward search.

Symbol 0 separates stretches and matches nothing.  The Burrows-Wheeler transform is kept as a
wavelet matrix of packed bits with a running count per 64 bits.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order, by prefix doubling; every 0 is smaller than all other
    symbols and different from every other 0."""
    n = len(text)
    zero = text == 0
    rank = np.where(zero, np.cumsum(zero) - 1, text.astype(np.int64) + int(zero.sum()))
    width = 1
    while True:
        second = np.zeros(n, np.int64)
        second[:max(0, n - width)] = rank[width:] + 1
        key = rank * (int(rank.max(initial=0)) + 2) + second if n else rank
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])]) if n else np.zeros(0, np.int64)
        rank = np.empty(n, np.int64)
        rank[order] = new
        if not n or new[-1] == n - 1:
            return order
        width *= 2


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.levels = max(1, int(n_symbols - 1).bit_length())
        self.bits, self.counts, self.zeros = [], [], []
        rest = symbols.astype(np.int64)
        n = len(rest)
        for level in range(self.levels - 1, -1, -1):
            bit = (rest >> level) & 1
            packed = np.zeros((n >> 6) + 1, np.uint64)
            raw = np.packbits(bit.astype(np.uint8), bitorder="little")
            packed.view(np.uint8)[:len(raw)] = raw
            self.bits.append(packed)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)[:-1]]).astype(np.int32))
            self.zeros.append(int(n - bit.sum()))
            rest = np.concatenate([rest[bit == 0], rest[bit == 1]])
        self.first = np.searchsorted(_bit_reversed(rest, self.levels), _bit_reversed(np.arange(n_symbols), self.levels))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position."""
        at = at.astype(np.int64)
        for k, level in enumerate(range(self.levels - 1, -1, -1)):
            word = at >> 6
            below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.counts[k][word] + np.bitwise_count(self.bits[k][word] & below)
            at = np.where((symbol >> level) & 1, self.zeros[k] + ones, at - ones)
        return at - self.first[symbol]


def _bit_reversed(values: np.ndarray, levels: int) -> np.ndarray:
    out = np.zeros(len(values), np.int64)
    for level in range(levels):
        out |= ((values >> level) & 1) << (levels - 1 - level)
    return out


class FMIndex:
    def __init__(self, text: np.ndarray):
        order = suffix_array(text)
        n_symbols = int(text.max(initial=0)) + 1
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols))])
        self.transform = WaveletMatrix(text[order - 1], n_symbols)       # position 0 follows the last

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals after putting a symbol in front of the matched strings."""
        both = self.transform.rank(np.concatenate([symbol, symbol]), np.concatenate([lo, hi])) + np.tile(self.starts[symbol], 2)
        return both[:len(lo)], both[len(lo):]

    def matching(self, query: np.ndarray, ends: np.ndarray, longest: int, least: int = 2) -> np.ndarray:
        """Matching statistics: for every end position the length, at most ``longest``, of the
        longest string ending there that occurs at least ``least`` times in the text."""
        out = np.zeros(len(ends), np.int64)
        live = np.arange(len(ends))
        at = ends.astype(np.int64)
        symbol = query[at]
        known = (symbol > 0) & (symbol < len(self.starts) - 1)
        live, at, symbol = live[known], at[known], symbol[known]
        lo, hi = self.starts[symbol], self.starts[symbol + 1]
        for length in range(1, longest + 1):
            stay = hi - lo >= least
            live, at, lo, hi = live[stay], at[stay], lo[stay], hi[stay]
            out[live] = length
            if length == longest or not len(live):
                break
            at = at - 1
            symbol = np.where(at >= 0, query[at], 0)
            known = (symbol > 0) & (symbol < len(self.starts) - 1)
            live, at, lo, hi, symbol = live[known], at[known], lo[known], hi[known], symbol[known]
            lo, hi = self.extend(symbol, lo, hi)
        return out
