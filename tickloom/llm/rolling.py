"""Hashes of any slice of a byte array, from one running sum."""

from __future__ import annotations

import numpy as np
import xxhash

#: A random odd-looking 64-bit number for each byte value.
LETTER = np.array([xxhash.xxh64_intdigest(bytes([b]), 11) for b in range(256)], np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS = {_BASE: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}


def _powers(base: int, n: int) -> np.ndarray:
    """First n powers modulo 2**64, kept for the next text."""
    if len(_POWERS[base]) < n:
        size = 1 << (n - 1).bit_length()
        _POWERS[base] = np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(size - 1, base, np.uint64))])
    return _POWERS[base][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class SliceHashes:
    """Polynomial hashes, modulo 2**64 and mixed, of slices of one byte array."""

    def __init__(self, raw: np.ndarray):
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(LETTER[raw] * _powers(_BASE, len(raw)), dtype=np.uint64)])
        self.inverse = _powers(_INVERSE, len(raw) + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.inverse[starts])
