"""Elias-Fano coding of monotone sequences in numpy, with batched access and successor search."""

from __future__ import annotations

import numpy as np

WORD = 64
_ONE = np.uint64(1)
# Place of the k-th set bit within each byte (rows: byte, columns: k).
_IN_BYTE = np.array([([i for i in range(8) if b >> i & 1] + [8] * 8)[:8] for b in range(256)], np.uint8)


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """``width`` bits of each value, one after the other, in 64-bit words (and one word to spare)."""
    words = np.zeros(len(values) * width // WORD + 2, np.uint64)
    if width:
        at = np.arange(len(values), dtype=np.uint64) * np.uint64(width)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        np.bitwise_or.at(words, word, values << shift)
        spill = shift + np.uint64(width) > WORD
        np.bitwise_or.at(words, word[spill] + 1, values[spill] >> (np.uint64(WORD) - shift[spill]))
    return words


class EliasFano:
    """A non-decreasing sequence of n unsigned numbers below a universe, in about 2 + log2(universe / n) bits each.

    Low bits are packed; high parts are unary: for each value h of the high
    part as many ones as elements have it, then a zero. Counts of zeros before
    each 64-bit word serve to select.
    """

    def __init__(self, low: np.ndarray, high: np.ndarray, zeros: np.ndarray, n: int, width: int):
        self.low, self.high, self.zeros, self.n, self.width = low, high, zeros, n, width

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        n = len(values)
        width = max(0, (universe // max(n, 1)).bit_length() - 1)
        top = (values >> np.uint64(width)).astype(np.int64)
        size = n + (universe >> width) + 2
        bits = np.zeros(-(-size // WORD) * WORD, np.uint8)
        bits[np.arange(n) + top] = 1
        high = np.packbits(bits, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(high).astype(np.int64)
        zeros = np.r_[0, np.cumsum(WORD - ones)].astype(np.uint32 if size < 1 << 32 else np.uint64)
        return cls(_packed(values & np.uint64((1 << width) - 1), width), high, zeros, n, width)

    def arrays(self) -> list[np.ndarray]:
        return [self.low, self.high, self.zeros]

    def _starts(self, top: np.ndarray) -> np.ndarray:
        """Index of the first element whose high part is top or more (zeros before it: top)."""
        k = top - 1  # the k-th zero ends the elements with high part k
        word = np.maximum(np.searchsorted(self.zeros, np.maximum(k, 0), side="right") - 1, 0)
        rest = np.maximum(k, 0) - self.zeros[word].astype(np.int64)
        inverse = ~self.high[np.minimum(word, len(self.high) - 1)]
        place = np.zeros(len(top), np.int64)
        found = np.zeros(len(top), bool)
        for i in range(8):
            byte = ((inverse >> np.uint64(8 * i)) & np.uint64(0xFF)).astype(np.int64)
            here = np.bitwise_count(byte.astype(np.uint8)).astype(np.int64)
            hit = ~found & (rest < here)
            place[hit] = 8 * i + _IN_BYTE[byte[hit], rest[hit]]
            rest[~found & ~hit] -= here[~found & ~hit]
            found |= hit
        return np.where(k < 0, 0, word * WORD + place - k)

    def _lows(self, index: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(index), np.uint64)
        at = index.astype(np.uint64) * np.uint64(self.width)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        wide = self.low[word] >> shift
        carry = np.where(shift > 0, self.low[word + 1] << ((np.uint64(WORD) - shift) & np.uint64(63)), np.uint64(0))
        return (wide | carry) & np.uint64((1 << self.width) - 1)

    def successor(self, values: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each value the first index in [low, high) whose element is not below it (else high), and whether it is equal."""
        top = (values >> np.uint64(self.width)).astype(np.int64)
        left, end = np.maximum(self._starts(top), low), np.minimum(self._starts(top + 1), high)
        wanted = values & np.uint64((1 << self.width) - 1)
        right = np.maximum(end, left)
        while (open_ := left < right).any():
            middle = (left + right) // 2
            below = np.zeros(len(values), bool)
            below[open_] = self._lows(middle[open_]) < wanted[open_]
            left = np.where(open_ & below, middle + 1, left)
            right = np.where(open_ & ~below, middle, right)
        equal = left < end
        equal[equal] = self._lows(left[equal]) == wanted[equal]
        return np.minimum(left, high), equal

    def values(self, index: np.ndarray) -> np.ndarray:
        """Elements by index."""
        ones = np.r_[0, np.cumsum(np.bitwise_count(self.high).astype(np.int64))]
        word = np.searchsorted(ones, index, side="right") - 1
        rest = index - ones[word]
        bits = self.high[word]
        place, found = np.zeros(len(index), np.int64), np.zeros(len(index), bool)
        for i in range(8):
            byte = ((bits >> np.uint64(8 * i)) & np.uint64(0xFF)).astype(np.int64)
            here = np.bitwise_count(byte.astype(np.uint8)).astype(np.int64)
            hit = ~found & (rest < here)
            place[hit] = 8 * i + _IN_BYTE[byte[hit], rest[hit]]
            rest[~found & ~hit] -= here[~found & ~hit]
            found |= hit
        top = word * WORD + place - index
        return (top.astype(np.uint64) << np.uint64(self.width)) | self._lows(index)
