"""Elias-Fano encoding of a non-decreasing sequence, with select.

Of each value the low bits are stored as they are; the high bits as one set bit per value, placed at
high part plus rank. That takes about 2 + log2(range / count) bits a value. ``select`` finds the
i-th set bit from a sampled table of 32-bit positions and a scan over at most the bits between two samples.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 512
HEAD = struct.Struct("<QQBxxxxxxxQQQ")


class EliasFano:
    def __init__(self, n: int, universe: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.universe, self.low_bits = n, universe, low_bits
        self.low, self.high, self.samples = low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        """values: non-negative, non-decreasing, 64-bit."""
        v = np.asarray(values, "<u8")
        n, universe = len(v), int(v[-1]) + 1 if len(v) else 1
        if n and (np.diff(v.view("<i8")) < 0).any():
            raise ValueError("the values must not decrease")
        bits = max(0, (universe // n).bit_length() - 1) if n else 0
        places = (v >> np.uint64(bits)).astype("<i8") + np.arange(n)
        if n and places[-1] >> 32:
            raise ValueError("too many values for 32-bit positions")
        upper = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        upper[places] = 1
        digits = ((v[:, None] >> np.arange(bits, dtype="<u8")) & np.uint64(1)).astype(np.uint8)
        return cls(
            n,
            universe,
            bits,
            np.packbits(digits.ravel(), bitorder="little"),
            np.packbits(upper, bitorder="little"),
            places[::SAMPLE].astype("<u4"),
        )

    def _low(self, i: int) -> int:
        if not self.low_bits:
            return 0
        first = i * self.low_bits
        taken = self.low[first // 8 : (first + self.low_bits + 7) // 8].tobytes()
        return (int.from_bytes(taken, "little") >> (first % 8)) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """The i-th value."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        block = i // SAMPLE
        start = int(self.samples[block])
        stop = int(self.samples[block + 1]) + 1 if block + 1 < len(self.samples) else len(self.high) * 8
        byte = start // 8
        ones = np.flatnonzero(np.unpackbits(self.high[byte : (stop + 7) // 8], bitorder="little"))
        ones = ones[ones >= start - 8 * byte]
        place = 8 * byte + int(ones[i - block * SAMPLE])
        return ((place - i) << self.low_bits) | self._low(i)

    def decode(self) -> np.ndarray:
        """All values."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        upper = (ones - np.arange(self.n)).astype("<u8") << np.uint64(self.low_bits)
        digits = np.unpackbits(self.low, bitorder="little")[: self.n * self.low_bits].reshape(self.n, self.low_bits)
        return upper | (digits.astype("<u8") << np.arange(self.low_bits, dtype="<u8")).sum(axis=1, dtype="<u8")

    def to_bytes(self) -> bytes:
        parts = [a.tobytes() for a in (self.low, self.high, self.samples)]
        return HEAD.pack(self.n, self.universe, self.low_bits, *map(len, parts)) + b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, universe, bits, *sizes = HEAD.unpack_from(data)
        at, parts = HEAD.size, []
        for size, kind in zip(sizes, ("u1", "u1", "<u4"), strict=True):
            parts.append(np.frombuffer(data, kind, size // np.dtype(kind).itemsize, at))
            at += size
        return cls(n, universe, bits, *parts)
