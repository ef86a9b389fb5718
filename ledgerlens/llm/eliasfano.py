"""Elias-Fano lists: ascending numbers in about 2 + log2(range / count) bits each.

A number's lower bits stand in a row; its upper bits are told in unary: bit
(upper + place) is set. Lists lie in files and are read where they lie.
"""

from __future__ import annotations

import numpy as np

_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)
# Place of the k-th set bit of a byte.
_SELECT = np.array(
    [[([i for i in range(8) if b >> i & 1] + [0] * 8)[k] for k in range(8)] for b in range(256)], np.uint8
)
_U = np.uint64


def _packed_bits(bits: np.ndarray) -> np.ndarray:
    """Bits as bytes, the first lowest, with room for a whole word behind them."""
    data = np.packbits(bits, bitorder="little")
    return np.concatenate((data, np.zeros(16 - len(data) % 8, np.uint8)))


class EliasFano:
    """An ascending list; made by `build`, kept as `arrays`, asked in whole arrays."""

    def __init__(self, head: np.ndarray, low: np.ndarray, high: np.ndarray, ones: np.ndarray) -> None:
        self.head, self.low, self.high, self.ones = head, low, high, ones
        self.n, self.shift = int(head[0]), int(head[1])
        # Lower bits are read as the word that begins at their byte.
        self.words = np.lib.stride_tricks.as_strided(
            low.view(np.uint8)[:8].view("<u8"), (max(1, len(low) - 8),), (1,), writeable=False
        )
        self.zeros = np.arange(len(ones), dtype=np.int64) * 64 - ones

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        # A word read at any bit of a byte holds 57 lower bits for sure.
        shift = min(57, max(0, (top // max(n, 1)).bit_length() - 1))
        upper = (values >> _U(shift)).astype(np.int64)
        bits = np.zeros(n + (top >> shift) + 2, np.uint8)
        bits[upper + np.arange(n)] = 1
        high = _packed_bits(bits)
        high = high[: len(high) // 8 * 8].view("<u8")
        ones = np.concatenate(([0], np.cumsum(_ones(high))))[:-1].astype("<i8")
        lows = ((values[:, None] >> np.arange(shift, dtype=np.uint64)) & _U(1)).astype(np.uint8)
        return cls(np.array([n, shift], "<i8"), _packed_bits(lows.ravel()), high, ones)

    @property
    def arrays(self) -> list[np.ndarray]:
        return [self.head, self.low, self.high, self.ones]

    def _lower(self, at: np.ndarray) -> np.ndarray:
        bit = at * self.shift
        word = self.words[bit >> 3]
        return (word >> (bit & 7).astype(np.uint64)) & _U((1 << self.shift) - 1)

    def _select(self, before: np.ndarray, k: np.ndarray, flip: bool) -> np.ndarray:
        """Place of the k-th one (or zero, if flip); ``before``: how many stand before each word."""
        word = np.searchsorted(before, k, "right") - 1
        data = self.high[word]
        data = (~data if flip else data).view(np.uint8).reshape(-1, 8)
        counts = np.cumsum(_ONES[data], axis=1, dtype=np.int64)
        rest = k - before[word]
        byte = (counts <= rest[:, None]).sum(axis=1)
        row = np.arange(len(k))
        rest = rest - np.where(byte > 0, counts[row, np.maximum(byte - 1, 0)], 0)
        return word * 64 + byte * 8 + _SELECT[data[row, byte], rest]

    def get(self, at: np.ndarray) -> np.ndarray:
        """The numbers at these places."""
        if not len(at):
            return np.array([], np.uint64)
        at = at.astype(np.int64)
        upper = (self._select(self.ones, at, False) - at).astype(np.uint64)
        return (upper << _U(self.shift)) | self._lower(at)

    def find(self, values: np.ndarray) -> np.ndarray:
        """Places of these numbers, -1 for those that aren't in the list.

        The unary part leads to the few numbers with the same upper bits, among
        which the lower bits are searched.
        """
        found = np.full(len(values), -1, np.int64)
        if not self.n or not len(values):
            return found
        values = values.astype(np.uint64)
        top = self.get(np.array([self.n - 1]))[0]
        inside = np.flatnonzero(values <= top)
        upper = (values[inside] >> _U(self.shift)).astype(np.int64)
        lower = values[inside] & _U((1 << self.shift) - 1)
        left = np.where(upper > 0, self._select(self.zeros, np.maximum(upper - 1, 0), True) - upper + 1, 0)
        end = self._select(self.zeros, upper, True) - upper
        right = end.copy()
        while (open_ := np.flatnonzero(left < right)).size:
            middle = (left[open_] + right[open_]) >> 1
            less = self._lower(middle) < lower[open_]
            left[open_] = np.where(less, middle + 1, left[open_])
            right[open_] = np.where(less, right[open_], middle)
        hit = np.flatnonzero(left < end)
        hit = hit[self._lower(left[hit]) == lower[hit]]
        found[inside[hit]] = left[hit]
        return found


def _ones(words: np.ndarray) -> np.ndarray:
    return _ONES[words.view(np.uint8).reshape(-1, 8)].sum(axis=1, dtype=np.int64)
