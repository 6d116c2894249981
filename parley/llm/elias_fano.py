"""Elias-Fano coding of a non-decreasing sequence.

Layout, little-endian: count and universe (8 bytes each), low bits a value (1 byte), then the low
bits packed, the high parts as a unary bit string, and the bit position of every 256th one.
"""

from __future__ import annotations

import numpy as np

EVERY = 256


class EliasFano:
    def __init__(self, data: bytes | memoryview) -> None:
        self.count, self.universe = (int(x) for x in np.frombuffer(data, "<u8", 2))
        self.low_bits = data[16]
        low_size = -(-self.count * self.low_bits // 8)
        self._high_bits = self.count + (self.universe >> self.low_bits) + 1
        high_size = -(-self._high_bits // 8)
        self._low = np.frombuffer(data, np.uint8, low_size, 17)
        self._high = np.frombuffer(data, np.uint8, high_size, 17 + low_size)
        self._marks = np.frombuffer(data, "<u4", -(-self.count // EVERY), 17 + low_size + high_size)

    @staticmethod
    def encode(values: np.ndarray, universe: int) -> bytes:
        """``values``: non-decreasing, from 0 to ``universe``."""
        values = np.asarray(values, np.uint64)
        n = len(values)
        low_bits = max(0, (universe // n).bit_length() - 1) if n else 0
        low = np.zeros((n, low_bits), np.uint8)
        for k in range(low_bits):
            low[:, k] = (values >> np.uint64(k)) & np.uint64(1)
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(n + (universe >> low_bits) + 1, np.uint8)
        high[ones] = 1
        return b"".join(
            [
                np.array([n, universe], "<u8").tobytes(),
                bytes([low_bits]),
                np.packbits(low.reshape(-1), bitorder="little").tobytes(),
                np.packbits(high, bitorder="little").tobytes(),
                ones[::EVERY].astype("<u4").tobytes(),
            ]
        )

    def select(self, i: int) -> int:
        """The ``i``-th value (from 0), by the nearest mark before it."""
        if not 0 <= i < self.count:
            raise IndexError(i)
        at, left = int(self._marks[i // EVERY]), i % EVERY
        while True:
            byte = at >> 3
            chunk = np.unpackbits(self._high[byte : byte + 64], bitorder="little")
            chunk[: at & 7] = 0
            ones = np.flatnonzero(chunk)
            if left < len(ones):
                position = 8 * byte + int(ones[left])
                break
            left -= len(ones)
            at = 8 * (byte + 64)
        first = i * self.low_bits
        bits = np.unpackbits(self._low[first >> 3 : (first + self.low_bits + 7) >> 3], bitorder="little")
        bits = bits[first & 7 : (first & 7) + self.low_bits]
        return (position - i) << self.low_bits | sum(int(b) << k for k, b in enumerate(bits))

    def values(self) -> np.ndarray:
        """All values at once."""
        ones = np.flatnonzero(np.unpackbits(self._high, bitorder="little", count=self._high_bits))
        out = (ones - np.arange(self.count)) << self.low_bits
        bits = np.unpackbits(self._low, bitorder="little", count=self.count * self.low_bits)
        for k, column in enumerate(bits.reshape(self.count, self.low_bits).T):
            out |= column.astype(np.int64) << k
        return out
