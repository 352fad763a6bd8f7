"""Elias-Fano coding of non-decreasing integers, in numpy.

n values below u take about n * (2 + log2(u / n)) bits: the low bits of each
value are packed, the high bits are a unary bit vector. ``select`` finds the
i-th value from a sparse directory (one 32-bit entry for SAMPLE ones) and a scan
of a few words, so no table of 64-bit offsets is ever stored or built.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256
_HEAD = struct.Struct("<QBQQ")


class EliasFano:
    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, directory: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.directory = n, low_bits, low, high, directory
        self._low_bytes, self._high_bytes = low.tobytes(), high.tobytes()

    @classmethod
    def encode(cls, values) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (max(top, 1) // max(n, 1)).bit_length() - 1)
        if low_bits:
            shifts = np.arange(low_bits, dtype=np.uint64)
            low = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        else:
            low = np.zeros(0, np.uint8)
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        bits[ones] = 1
        return cls(n, low_bits, low, np.packbits(bits, bitorder="little"), (ones[::SAMPLE]).astype(np.uint32))

    def _low(self, i: int) -> int:
        if not self.low_bits:
            return 0
        first, last = i * self.low_bits, (i + 1) * self.low_bits
        piece = int.from_bytes(self._low_bytes[first // 8 : (last + 7) // 8], "little")
        return (piece >> (first % 8)) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """The i-th value."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.directory[i // SAMPLE]), i % SAMPLE
        byte, skip = at // 8, at % 8
        word = int.from_bytes(self._high_bytes[byte : byte + 8], "little") >> skip << skip
        while (here := word.bit_count()) <= left:
            left -= here
            byte += 8
            word = int.from_bytes(self._high_bytes[byte : byte + 8], "little")
        one = byte * 8
        for half in (32, 16, 8):
            first = word & ((1 << half) - 1)
            if (here := first.bit_count()) <= left:
                left, word, one = left - here, word >> half, one + half
            else:
                word = first
        for _ in range(left):
            word &= word - 1
        one += (word & -word).bit_length() - 1
        return ((one - i) << self.low_bits) | self._low(i)

    def decode(self) -> np.ndarray:
        """All values, as uint64."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))
        values = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits and self.n:
            bits = np.unpackbits(self.low, bitorder="little", count=self.n * self.low_bits).reshape(self.n, self.low_bits)
            values |= (bits.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(1, dtype=np.uint64)
        return values

    def to_bytes(self) -> bytes:
        head = _HEAD.pack(self.n, self.low_bits, len(self.low), len(self.high))
        return head + self.low.tobytes() + self.high.tobytes() + self.directory.astype("<u4").tobytes()

    @classmethod
    def from_bytes(cls, data, at: int = 0) -> tuple[EliasFano, int]:
        n, low_bits, n_low, n_high = _HEAD.unpack_from(data, at)
        at += _HEAD.size
        low = np.frombuffer(data, np.uint8, n_low, at)
        high = np.frombuffer(data, np.uint8, n_high, at + n_low)
        at += n_low + n_high
        directory = np.frombuffer(data, "<u4", -(-n // SAMPLE), at)
        return cls(n, low_bits, low, high, directory), at + 4 * len(directory)
