"""Vectorised 64-bit hashing of bytes: one prefix sum serves every range of a text."""

from __future__ import annotations

import numpy as np

U = np.uint64
BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)
_powers = [np.ones(1, U), np.ones(1, U)]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer, element by element."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


#: A random 64-bit number for each byte.
BYTES = mix((np.arange(256, dtype=U) + U(1)) * U(BASE))


def _power(n: int, which: int) -> np.ndarray:
    have = _powers[which]
    if len(have) < n:
        have = np.full(1 << (n - 1).bit_length(), U(_INVERSE if which else BASE))
        have[0] = 1
        _powers[which] = have = np.multiply.accumulate(have)
    return have[:n]


class Ranges:
    """Hashes of ranges of some bytes: equal bytes, equal hashes, wherever they stand."""

    def __init__(self, data: np.ndarray) -> None:
        self.sums = np.zeros(len(data) + 1, U)
        np.cumsum(BYTES[data] * _power(len(data), 0), out=self.sums[1:])

    def of_size(self, k: int) -> np.ndarray:
        """The hash of every run of k bytes."""
        sums = self.sums
        return mix((sums[k:] - sums[: len(sums) - k]) * _power(len(sums) - k, 1))

    def between(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The hashes of [start, end), also different for different sizes."""
        moved = (self.sums[ends] - self.sums[starts]) * _power(len(self.sums), 1)[starts]
        return mix(moved + (ends - starts).astype(U) * U(BASE))
