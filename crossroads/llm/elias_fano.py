"""Elias-Fano coding of sorted distinct 64-bit numbers, searched where it lies, many numbers at a time.

The low bits of each number are packed; the high bits are a bit array in which number i sets bit
high + i. The zeros of that array delimit the numbers with equal high bits, so a search jumps to that
short range (a directory counts the zeros before each word) and looks only at low bits there.
"""

from __future__ import annotations

import numpy as np

U = np.uint64


#: Of each byte and rank the place of that one.
_IN_BYTE = np.zeros((256, 8), np.uint8)
for _b in range(256):
    _places = [i for i in range(8) if _b >> i & 1]
    _IN_BYTE[_b, :len(_places)] = _places
_IN_BYTE = _IN_BYTE.ravel()
_EACH, _TOPS = U(0x0101010101010101), U(0x8080808080808080)


def _select_in_word(word: np.ndarray, r: np.ndarray) -> np.ndarray:
    """The place of the r-th one in each word: the bytes before it by running counts of all eight at once, then a table."""
    r = r.astype(np.uint64)
    ones = word - ((word >> U(1)) & U(0x5555555555555555))
    ones = (ones & U(0x3333333333333333)) + ((ones >> U(2)) & U(0x3333333333333333))
    ones = ((ones + (ones >> U(4))) & U(0x0F0F0F0F0F0F0F0F)) * _EACH
    at = np.bitwise_count((((r * _EACH) | _TOPS) - ones) & _TOPS).astype(np.uint64) << U(3)
    r -= ((ones << U(8)) >> at) & U(255)
    return (at + _IN_BYTE[(((word >> at) & U(255)) << U(3)) | r]).astype(np.int64)


def encode(x: np.ndarray, universe: int) -> dict[str, np.ndarray]:
    """Arrays that ``EliasFano`` reads: ``ef_head`` (count, low bits), ``ef_low``, ``ef_high``, ``ef_zeros``."""
    n = len(x)
    low_bits = min(56, max(0, (max(1, universe) // max(1, n)).bit_length() - 1))
    low = np.zeros(n * low_bits // 8 + 16, np.uint8)
    for at in range(0, n, 1 << 16):  # a multiple of 8 numbers ends on a whole byte
        part = (x[at:at + (1 << 16), None] >> np.arange(low_bits, dtype=np.uint64)) & U(1)
        packed = np.packbits(part.astype(np.uint8).ravel(), bitorder="little")
        low[at * low_bits // 8:at * low_bits // 8 + len(packed)] = packed
    high = (x >> U(low_bits)).astype(np.int64) + np.arange(n)
    size = (int(high[-1]) if n else 0) // 64 + 2
    bits = np.zeros(size * 64, np.uint8)
    bits[high] = 1
    words = np.packbits(bits, bitorder="little").view(np.uint64)
    zeros = 64 - np.bitwise_count(words).astype(np.int64)
    return {"ef_head": np.array([n, low_bits], np.int64), "ef_low": low, "ef_high": words, "ef_zeros": np.cumsum(zeros) - zeros}


class EliasFano:
    def __init__(self, arrays: dict[str, np.ndarray]):
        self.n, self.low_bits = (int(v) for v in arrays["ef_head"])
        low = arrays["ef_low"]
        self.low = np.ndarray((len(low) - 7,), "<u8", low, strides=(1,))  # eight bytes from any byte on
        self.high, self.zeros = arrays["ef_high"], arrays["ef_zeros"]
        self.high_bytes = np.ndarray((max(0, len(self.high) * 8 - 7),), "<u8", self.high, strides=(1,))
        self.mask = U((1 << self.low_bits) - 1)

    def _low(self, i: np.ndarray) -> np.ndarray:
        bit = i * self.low_bits
        return (self.low[bit >> 3] >> (bit & 7).astype(np.uint64)) & self.mask

    def _before_zero(self, j: np.ndarray) -> np.ndarray:
        """How many numbers precede the j-th zero."""
        word = np.searchsorted(self.zeros, j, side="right") - 1
        return word * 64 + _select_in_word(~self.high[word], j - self.zeros[word]) - j

    def _bucket(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places from and to which the numbers with these high bits lie: after a zero, up to the next one."""
        lo = np.where(h > 0, self._before_zero(np.maximum(h - 1, 0)), 0)
        bit = lo + h
        byte = np.minimum(bit >> 3, len(self.high_bytes) - 1)
        shift = (bit - (byte << 3)).astype(np.uint64)
        seen = self.high_bytes[byte] >> shift
        ones = np.bitwise_count(seen & ~(seen + U(1))).astype(np.int64)
        hi = lo + ones
        # The eight bytes looked at may end before the run does.
        long = np.flatnonzero(ones + shift.astype(np.int64) >= 64)
        if len(long):
            hi[long] = self._before_zero(h[long])
        return lo, hi

    def find(self, x: np.ndarray) -> np.ndarray:
        """The place of each number, -1 where it is not in the sequence."""
        out = np.full(len(x), -1, np.int64)
        if not self.n or not len(x):
            return out
        h = (x >> U(self.low_bits)).astype(np.int64)
        ok = np.flatnonzero(h < len(self.high) * 64 - self.n - 1)
        h, low = h[ok], x[ok] & self.mask
        lo, end = self._bucket(h)
        open_ = np.flatnonzero(lo < end)
        a, b, want = lo[open_], end[open_], low[open_]
        while len(open_):
            middle = (a + b) >> 1
            less = self._low(middle) < want
            a, b = np.where(less, middle + 1, a), np.where(less, b, middle)
            if not (more := a < b).all():
                lo[open_] = a
                open_, a, b, want = open_[more], a[more], b[more], want[more]
        hit = lo < end
        hit[hit] = self._low(lo[hit]) == low[hit]
        out[ok[hit]] = lo[hit]
        return out
