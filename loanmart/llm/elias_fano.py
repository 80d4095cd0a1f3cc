"""Elias-Fano coding of ascending numbers: about two bits a value beside its low bits, with select."""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256  # every so many-th one of the high bits has its place stored
_HEAD = struct.Struct("<qqqqq")  # values, low width, bytes of low bits, bytes of high bits, samples


def encode(values: np.ndarray) -> bytes:
    """Ascending values, not negative, repeats allowed."""
    values = np.asarray(values, np.uint64)
    n = len(values)
    if not n:
        return _HEAD.pack(0, 0, 0, 0, 0)
    top = int(values[-1])
    width = max(0, (top // n).bit_length() - 1)
    low_bits = ((values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    low = np.packbits(low_bits.reshape(-1), bitorder="little")
    ones = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
    high_bits = np.zeros(int(ones[-1]) + 1, np.uint8)
    high_bits[ones] = 1
    high = np.packbits(high_bits, bitorder="little")
    samples = ones[::SAMPLE].astype("<i8")
    head = _HEAD.pack(n, width, len(low), len(high), len(samples))
    return head + low.tobytes() + high.tobytes() + samples.tobytes()


class Sequence:
    """Reads an encoded sequence without unpacking it."""

    def __init__(self, data: bytes):
        self.n, self.width, low, high, samples = _HEAD.unpack_from(data)
        at = _HEAD.size
        self.low = np.frombuffer(data, np.uint8, low, at)
        self.high = np.frombuffer(data, np.uint8, high, at + low)
        self.samples = np.frombuffer(data, "<i8", samples, at + low + high)

    def __len__(self) -> int:
        return self.n

    def _place(self, i: int) -> int:
        """Place of the ``i``-th one among the high bits, from the last stored place before it."""
        at = int(self.samples[i // SAMPLE])
        left = i % SAMPLE
        byte, skip = at // 8, at % 8
        first = int(self.high[byte]) >> skip << skip
        while True:
            have = first.bit_count()
            if left < have:
                for _ in range(left):
                    first &= first - 1
                return 8 * byte + (first & -first).bit_length() - 1
            left -= have
            byte += 1
            first = int(self.high[byte])

    def select(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        low = 0
        for b in range(self.width):
            at = i * self.width + b
            low |= (int(self.low[at // 8]) >> at % 8 & 1) << b
        return (self._place(i) - i << self.width) | low

    def all(self) -> np.ndarray:
        if not self.n:
            return np.zeros(0, np.uint64)
        bits = np.unpackbits(self.low, bitorder="little", count=self.n * self.width)
        weights = np.uint64(1) << np.arange(self.width, dtype=np.uint64)
        low = (bits.reshape(self.n, self.width) * weights).sum(axis=1, dtype=np.uint64)
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        return ((ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.width)) | low
