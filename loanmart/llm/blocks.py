"""Arrow text as numpy bytes, in blocks of bounded size, and hashes of words and byte windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

_random = np.random.Generator(np.random.PCG64(20240607))
_BYTE_VALUES = _random.integers(1, 2**63, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)  # odd, 5 modulo 8: long multiplicative order
_INVERSE = np.uint64(pow(int(_STEP), -1, 2**64))
_MIX_A, _MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words in which every bit depends on all bits."""
    values = (values ^ (values >> np.uint64(30))) * _MIX_A
    values = (values ^ (values >> np.uint64(27))) * _MIX_B
    return values ^ (values >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows of a binary or string array, and where each row starts (one more for the end)."""
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    if data is None or offsets[0] == offsets[-1]:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``BLOCK_BYTES`` of text each, at least one row; rows are whole."""
    return sized_blocks(batches, column, BLOCK_BYTES)


def sized_blocks(batches: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(column))
        at = 0
        while at < batch.num_rows:
            upto = int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1
            upto = min(max(upto, at + 1), batch.num_rows)
            yield batch.slice(at, upto - at)
            at = upto


def byte_class(inside: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(inside)] = True
    return table


SPACES = bytes([32, *range(9, 14)])
NOT_SPACE = ~byte_class(SPACES)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Words:
    """The words of a block: byte range, row and hash of each; ``first[r]:first[r + 1]`` are those of row ``r``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = NOT_SPACE):
        size = len(data)
        word = inside[data]
        before, after = np.zeros(size, bool), np.zeros(size, bool)
        before[1:], after[:-1] = word[:-1], word[1:]
        before[offsets[:-1][offsets[:-1] < size]] = False
        after[offsets[1:][offsets[1:] > 0] - 1] = False
        self.start = np.flatnonzero(word & ~before)
        self.end = np.flatnonzero(word & ~after) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        self.data = data

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word's bytes."""
        size = len(self.data)
        if not len(self.start):
            return np.zeros(0, np.uint64)
        powers, inverse = _powers(size + 1)
        total = np.zeros(size + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[self.data] * powers[:size], out=total[1:])
        plain = (total[self.end] - total[self.start]) * inverse[self.start]
        return mix(plain + (self.end - self.start).astype(np.uint64))


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(size: int) -> list[np.ndarray]:
    """Powers of the step and of its inverse, at least ``size`` of each."""
    if len(_POWERS[0]) < size:
        size = max(size, BLOCK_BYTES + 1)
        for i, base in enumerate((_STEP, _INVERSE)):
            grown = np.full(size, base, np.uint64)
            grown[0] = 1
            _POWERS[i] = np.multiply.accumulate(grown)
    return _POWERS


def window_hashes(hashes: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Hash of every ``length`` neighbouring values; one for each place where a window fits."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, seed, np.uint64)
    for i in range(length):
        out *= _STEP
        out += hashes[i : i + n]
    return mix(out)


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each maximal run of bytes marked ``inside``; runs end where rows do."""
    size = len(inside)
    before, after = np.zeros(size, bool), np.zeros(size, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[offsets[:-1][offsets[:-1] < size]] = False
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    return start, np.flatnonzero(inside & ~after) + 1, np.searchsorted(offsets, start, "right") - 1


def cut_out(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.StringArray:
    """The texts of some spans, which do not overlap and are in order."""
    edge = np.zeros(len(data) + 1, np.int8)
    edge[start] += 1
    edge[end] -= 1  # one span may begin where another ends
    places = np.zeros(len(start) + 1, np.int32)
    np.cumsum(end - start, out=places[1:])
    taken = data[np.cumsum(edge[:-1], dtype=np.int8).view(bool)]
    return pa.StringArray.from_buffers(len(start), pa.py_buffer(places), pa.py_buffer(taken))
