"""Elias-Fano coded monotone sequences over raw bytes, read with NumPy where they lie.

A value is cut into low bytes, kept as they are, and a high part, kept in unary: bit i + high(i) is
set for element i. Look-ups take arrays of positions or values, so a memory-mapped file serves
many queries at once and only the pages they touch are read.
"""

from __future__ import annotations

import numpy as np

HEAD = 4  # numbers in front: elements, low bytes, words of the unary part, largest value


def encode(values: np.ndarray) -> bytes:
    """A non-decreasing sequence of uint64."""
    n = len(values)
    top = int(values[-1]) if n else 0
    low = 0
    while n and (top >> (8 * low)) > 2 * n:
        low += 1
    high = (values >> np.uint64(8 * low)).astype(np.int64) if low < 8 else np.zeros(n, np.int64)
    size = n + (int(high[-1]) if n else 0) + 1
    words = -(-size // 64)
    bits = np.zeros(words * 64, np.uint8)
    bits[np.arange(n) + high] = 1
    unary = np.packbits(bits, bitorder="little")
    lows = np.ascontiguousarray(values, dtype="<u8").view(np.uint8).reshape(n, 8)[:, :low]
    head = np.array([n, low, words, top], dtype="<u8")
    body = head.tobytes() + unary.tobytes() + np.ascontiguousarray(lows).tobytes()
    return body + bytes(-len(body) % 8)


class EliasFano:
    """A sequence at ``at`` in a byte buffer; ``end`` is where the next one begins."""

    def __init__(self, data: np.ndarray, at: int = 0) -> None:
        head = data[at : at + 8 * HEAD].view("<u8")
        self.n, self.low, words, self.top = (int(x) for x in head)
        start = at + 8 * HEAD
        self.words = data[start : start + 8 * words].view("<u8")
        start += 8 * words
        self.lows = data[start : start + self.n * self.low].reshape(self.n, self.low)
        size = 8 * HEAD + 8 * words + self.n * self.low
        self.end = at + size + (-size % 8)
        ones = np.bitwise_count(self.words).astype(np.int64)
        self._ones = np.concatenate([[0], np.cumsum(ones)])
        self._zeros = np.arange(words + 1) * 64 - self._ones

    def _select(self, rank: np.ndarray, before: np.ndarray, flip: bool) -> np.ndarray:
        """Position of the bit with ``rank`` of its kind in front of it."""
        word = np.searchsorted(before, rank, side="right") - 1
        word = np.minimum(word, len(self.words) - 1)
        left = rank - before[word]
        value = self.words[word]
        if flip:
            value = ~value
        place = np.zeros(len(rank), np.int64)
        for width in (32, 16, 8, 4, 2, 1):
            part = value & np.uint64((1 << width) - 1)
            inside = np.bitwise_count(part).astype(np.int64)
            beyond = left >= inside
            left = np.where(beyond, left - inside, left)
            value = np.where(beyond, value >> np.uint64(width), part)
            place += np.where(beyond, width, 0)
        return word * 64 + place

    def _low(self, index: np.ndarray) -> np.ndarray:
        out = np.zeros(len(index), np.uint64)
        for byte in range(self.low):
            out |= self.lows[index, byte].astype(np.uint64) << np.uint64(8 * byte)
        return out

    def access(self, index: np.ndarray) -> np.ndarray:
        """Values at positions below n."""
        high = (self._select(index, self._ones, False) - index).astype(np.uint64)
        shift = np.uint64(8 * self.low)
        return (high << shift if self.low < 8 else np.zeros(len(index), np.uint64)) | self._low(index)

    def find(self, values: np.ndarray, start: np.ndarray | None = None, stop: np.ndarray | None = None) -> np.ndarray:
        """Position of each value, -1 where absent; searched in [start, stop) if these are given."""
        if not self.n:
            return np.full(len(values), -1, np.int64)
        values = values.astype(np.uint64)
        fits = values <= np.uint64(self.top)
        asked = np.where(fits, values, np.uint64(0))
        high = (asked >> np.uint64(8 * self.low)).astype(np.int64) if self.low < 8 else np.zeros(len(values), np.int64)
        # Elements with this high part lie between the zero bits around it.
        first = np.where(high > 0, self._select(np.maximum(high - 1, 0), self._zeros, True) - high + 1, 0)
        after = np.minimum(self._select(high, self._zeros, True) - high, self.n)
        if start is not None:
            first, after = np.maximum(first, start), np.minimum(after, stop)
        after = np.maximum(after, first)
        wanted = asked & np.uint64((1 << (8 * self.low)) - 1) if self.low < 8 else asked
        left, right = first.copy(), after.copy()
        for _ in range(int((after - first).max(initial=0)).bit_length()):
            middle = (left + right) >> 1
            searching = left < right
            less = searching & (self._low(np.minimum(middle, self.n - 1)) < wanted)
            left = np.where(less, middle + 1, left)
            right = np.where(searching & ~less, middle, right)
        found = (left < after) & fits
        found &= self._low(np.minimum(left, self.n - 1)) == wanted
        return np.where(found, left, -1)
