"""A compressed FM-index over number sequences: wavelet matrix, backward search, matching statistics."""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)


class _Bits:
    """A bit vector in 64-bit words with a count per word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.r_[0, np.cumsum(np.bitwise_count(self.words), dtype=np.int64)].astype(np.int32)

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before position ``i``."""
        at = i >> 6
        low = self.words[at] & ((_ONE << (i & 63).astype(np.uint64)) - _ONE)
        return self.before[at] + np.bitwise_count(low)


class WaveletMatrix:
    """Rank of any symbol below ``2**levels``, one bit vector per level."""

    def __init__(self, symbols: np.ndarray, levels: int):
        self.levels, self.bits, self.zeros = levels, [], []
        for level in range(levels - 1, -1, -1):
            bit = (symbols >> level & 1).astype(bool)
            self.bits.append(_Bits(bit))
            self.zeros.append(int(len(bit) - bit.sum()))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])

    def descend(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Where position ``i`` ends up when the matrix is read along ``symbol``; ranks are differences of these."""
        for k, (bits, zeros) in enumerate(zip(self.bits, self.zeros, strict=True)):
            ones = bits.rank(i)
            i = np.where(symbol >> (self.levels - 1 - k) & 1, zeros + ones, i - ones)
        return i


class FMIndex:
    """Index of sequences of symbols 1..; 0 stands after each sequence.

    Rows are sorted by their first ``2 * 2**k > window`` symbols, which makes the intervals of all patterns up to
    ``window + 1`` symbols exact.
    """

    def __init__(self, text: np.ndarray, window: int):
        n = len(text)
        self.n, self.window = n, window
        rank = np.unique(text, return_inverse=True)[1]
        depth, at_window = 1, None
        while depth <= window:
            if depth * 2 > window:  # windows as two overlapping halves
                at_window = rank * (n + 1) + _shifted(rank, window - depth)
            rank = np.unique(rank * (n + 1) + _shifted(rank, depth), return_inverse=True)[1]
            depth *= 2
        self.rows = np.argsort(rank, kind="stable")
        self.wavelet = WaveletMatrix(text[self.rows - 1], max(int(text.max(initial=0)).bit_length(), 1))
        symbols = np.arange(int(text.max(initial=0)) + 2)
        self.smaller = np.searchsorted(np.sort(text), symbols)
        self.base = self.wavelet.descend(symbols[:-1], np.zeros(len(symbols) - 1, np.int64))
        key = at_window[self.rows]
        first = np.r_[True, key[1:] != key[:-1]] if n else np.zeros(0, bool)
        #: rows where the first ``window`` symbols change, as ranks and places: the parent interval of that depth
        self.window_of = np.cumsum(first) - 1
        self.window_start = np.append(np.flatnonzero(first), n)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of ``symbol`` followed by the pattern whose interval is given."""
        shift = self.smaller[symbol] - self.base[symbol]
        return shift + self.wavelet.descend(symbol, low), shift + self.wavelet.descend(symbol, high)

    def matching_windows(self, text: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Matching statistics at depth ``window`` of the sequences ``text[start:start + length]``, all in step from the right.

        Gives each place whose next ``window`` symbols stay in its sequence and occur in the index, and the number of
        the interval of all their occurrences.  Once a match has that depth it is held there: one symbol is added on the left
        and the interval widened to its parent.  The sequences must occur in the index, so no match breaks off.
        """
        order = np.argsort(-length, kind="stable")
        start, length = start[order], length[order]
        low, high = np.zeros(len(start), np.int64), np.full(len(start), self.n, np.int64)
        places, found = [], []
        for step in range(1, int(length.max(initial=0)) + 1):
            active = int(np.searchsorted(-length, -step, side="right"))
            at = start[:active] + length[:active] - step
            low, high = self.extend(text[at], low[:active], high[:active])
            if (low >= high).any():
                raise AssertionError("a sequence is not in the index")
            if step >= self.window:
                inside = self.window_of[low]
                places.append(at)
                found.append(inside)
                low, high = self.window_start[inside], self.window_start[inside + 1]
        return (np.concatenate(places), np.concatenate(found)) if places else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _shifted(rank: np.ndarray, by: int) -> np.ndarray:
    """Rank of the place ``by`` further on, plus one; 0 beyond the end."""
    out = np.zeros(len(rank), np.int64)
    out[: max(len(rank) - by, 0)] = rank[by:] + 1
    return out
