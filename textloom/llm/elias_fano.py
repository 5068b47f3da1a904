"""Elias-Fano coding of non-decreasing numbers, with select over sampled blocks.

Of n numbers up to u each keeps its low log2(u / n) bits as they are; the high bits are written in
unary into one bit string of at most 3n + 1 bits. The i-th number's high part is the place of the
i-th one less i; every STEP-th one's place is kept (32 bits), so that select looks at one block.
"""

from __future__ import annotations

import struct

import numpy as np

#: Ones between two samples of the select structure.
STEP = 256
HEAD = struct.Struct("<QBQ")


def encoded(values: np.ndarray) -> bytes:
    """The numbers (unsigned 64 bits, non-decreasing, fewer than 2**30) as bytes."""
    values = np.asarray(values, np.uint64)
    n = len(values)
    most = int(values[-1]) if n else 0
    width = max(0, (most // n).bit_length() - 1) if n else 0
    low = (values[:, None] >> np.arange(width, dtype=np.uint64) & np.uint64(1)).astype(np.uint8)
    places = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
    high = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
    high[places] = 1
    bits = np.packbits(high, bitorder="little").tobytes()
    return HEAD.pack(n, width, len(bits)) + bits + places[::STEP].astype("<u4").tobytes() + np.packbits(low.ravel(), bitorder="little").tobytes()


class EliasFano:
    """Random access to encoded numbers: nothing but the asked blocks is decoded."""

    def __init__(self, data: bytes | memoryview, at: int = 0) -> None:
        self.n, self.width, size = HEAD.unpack_from(data, at)
        at += HEAD.size
        take = lambda kind, many: np.frombuffer(data, kind, many, at)
        self.high = take(np.uint8, size)
        at += size
        self.samples = take("<u4", -(-self.n // STEP))
        at += 4 * len(self.samples)
        self.low = take(np.uint8, -(-self.n * self.width // 8))
        self.end = at + len(self.low)

    def select(self, i: np.ndarray) -> np.ndarray:
        """The places of the i-th ones; i rises."""
        blocks, out = i // STEP, np.empty(len(i), np.int64)
        for block in np.unique(blocks).tolist():
            first = int(self.samples[block])
            last = int(self.samples[block + 1]) if block + 1 < len(self.samples) else 8 * len(self.high)
            bits = np.unpackbits(self.high[first // 8 : -(-last // 8)], bitorder="little")
            ones = np.flatnonzero(bits[first % 8 :]) + first
            mine = slice(*np.searchsorted(blocks, [block, block + 1]))
            out[mine] = ones[i[mine] % STEP]
        return out

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        """The i-th numbers; i rises."""
        i = np.asarray(i, np.int64)
        high = (self.select(i) - i).astype(np.uint64) << np.uint64(self.width)
        bit = (i * self.width)[:, None] + np.arange(self.width)
        low = (self.low[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(np.uint64) << np.arange(self.width, dtype=np.uint64)
        return high | np.bitwise_or.reduce(low, axis=1, initial=np.uint64(0))
