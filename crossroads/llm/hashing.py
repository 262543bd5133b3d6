"""Rolling hashes of byte spans and word windows, computed for a whole block of text at once.

A span's hash is a polynomial over random 64-bit byte values modulo 2**64, taken from prefix sums
and finished by a mixer, so any span costs one subtraction and one product. Seeds are fixed: every
task on every machine gives the same hashes.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_BYTES = np.random.default_rng(20240229).integers(0, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = U(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class _Powers:
    """base**i and base**-i, grown to the longest block seen by this worker."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) >= n:
            return
        n = max(n, 1 << 20)
        inverse = pow(_BASE, -1, 1 << 64)
        self.up = np.multiply.accumulate(np.r_[U(1), np.full(n - 1, U(_BASE))])
        self.down = np.multiply.accumulate(np.r_[U(1), np.full(n - 1, U(inverse))])


_POWERS = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(29))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(32))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """The sums from which ``span_hash`` takes the hash of any span of ``data`` (bytes)."""
    _POWERS.reach(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * _POWERS.up[:len(data)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Equal spans have equal hashes wherever they lie; the length is part of the hash."""
    return mix((sums[end] - sums[start]) * _POWERS.down[start] + (end - start).astype(np.uint64) * U(0xA24BAED4963EE407))


def words(data: np.ndarray, doc_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """start, end and document number of each word; words never reach over a document's end."""
    gap = np.ones(len(data) + 1, bool)
    gap[:-1] = _SPACE[data]
    first = ~gap[:-1]
    first[1:] &= gap[:-2]
    last = ~gap[:-1] & gap[1:]
    inner = doc_starts[(doc_starts > 0) & (doc_starts < len(data))]
    first[inner] = ~gap[inner]
    last[inner - 1] = ~gap[inner - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(doc_starts, start, side="right") - 1


def window_hash(word_hashes: np.ndarray, k: int) -> np.ndarray:
    """The hash of every ``k`` consecutive words, also across documents: the caller masks those."""
    n = max(0, len(word_hashes) - k + 1)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = h * _WORD_BASE + word_hashes[j:j + n]
    return mix(h)
