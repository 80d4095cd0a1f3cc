"""A bit table of fixed size that lets every key of a set through, and few others.

Tasks use it to leave out rows that cannot matter before they are shuffled. It may let too much through, never too
little, so results do not depend on it. Its size follows the number of keys up to ``MAX_BITS``; beyond that it
leaves out less and less.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

MAX_BITS = 27  # a table of 16 MB
COUNTED_BITS = 34
SLICE_BITS = 26  # a task counts in an array of 64 MB


def table_bits(keys: int) -> int:
    """Bits of a key used as an index, for some 1 % of strangers let through as long as the table may grow."""
    return min(MAX_BITS, max(16, (64 * keys).bit_length()))


class Sieve:
    """Broadcast bit table over the leading bits of 64-bit keys; ``passes(keys)`` in tasks."""

    def __init__(self, table, bits: int):
        self.table, self.bits = table, bits

    def passes(self, keys: np.ndarray) -> np.ndarray:
        at = keys >> np.uint64(64 - self.bits)
        return (self.table.value[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _collected(cells: DataFrame, bits: int) -> Sieve:
    """Sieve from ``cell long, mask long``: 64 bits of the table each. At most ``2 ** (bits - 6)`` rows reach the driver."""
    words = np.zeros(1 << (bits - 6), np.uint64)
    got = cells.groupBy("cell").agg(F.bit_or("mask").alias("mask")).toArrow()
    words[got["cell"].to_numpy()] = got["mask"].to_numpy().view(np.uint64)
    return Sieve(cells.sparkSession.sparkContext.broadcast(words.view(np.uint8)), bits)


def of_keys(keys: DataFrame, column: str, rows: int) -> Sieve:
    """Sieve that lets the (well mixed) long keys of a column through."""
    bits = table_bits(rows)
    at = F.shiftrightunsigned(column, 64 - bits)
    cells = keys.select(at.alias("at")).selectExpr("shiftright(at, 6) AS cell", "shiftleft(1L, cast(at % 64 AS int)) AS mask")
    return _collected(cells, bits)


def zip_sorted(values: np.ndarray) -> bytes:
    """Sorted unsigned numbers as the compressed bytes of their differences, those of one weight together."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(len(values), steps.dtype.itemsize).T)
    return np.int64(len(values)).tobytes() + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unzip_sorted(blob, kind) -> np.ndarray:
    blob = memoryview(blob)
    size, width = int(np.frombuffer(blob[:8], np.int64)[0]), np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(blob[8:], decompressed_size=size * width, codec="zstd", asbytes=True), np.uint8)
    return np.cumsum(np.ascontiguousarray(planes.reshape(width, size).T).view(kind)[:, 0], dtype=kind)


def counted_bits(rows: int) -> int:
    """Leading bits of a key that are told apart when counting ``rows`` of them."""
    return min(COUNTED_BITS, max(20, (32 * rows).bit_length()))


def pack(keys: np.ndarray, bits: int, slice_bits: int = SLICE_BITS):
    """``slice int, keys binary`` batches of one task's keys: each slice has its keys' bits, zipped.

    Keys may repeat; their number is what is counted. Sorted, so that a slice is one stretch.
    """
    low = min(bits, slice_bits)
    at = np.sort(keys >> np.uint64(64 - bits))
    slices, starts = np.unique(at >> np.uint64(low), return_index=True)
    inside = (at & np.uint64((1 << low) - 1)).astype(np.uint32)
    ends = [*starts[1:], len(at)]
    yield pa.RecordBatch.from_arrays(
        [pa.array(slices.astype(np.int32)), pa.array([zip_sorted(inside[a:b]) for a, b in zip(starts, ends)], pa.binary())],
        ["slice", "keys"],
    )


def of_frequent(packed: DataFrame, bits: int, least: int, rows: int, slice_bits: int = SLICE_BITS) -> Sieve:
    """Sieve that lets every key through that was packed at least ``least`` times.

    Keys are counted by their leading ``bits`` in arrays of fixed size, one slice of the key range at a time; keys that
    share them are counted together, which can only raise a count. ``slice_bits`` are those the keys were packed with.
    """
    low, kept = min(bits, slice_bits), min(bits, table_bits(max(1, rows // (4 * least))))

    def run(batches):
        def cells():
            hot = np.flatnonzero(counts >= least).astype(np.uint64) | np.uint64(now << low)
            at = np.unique(hot >> np.uint64(bits - kept))
            cell, first = np.unique(at >> np.uint64(6), return_index=True)
            if not len(cell):
                return None
            masks = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first)
            return pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int64)), pa.array(masks.view(np.int64))], ["cell", "mask"])

        now, counts = None, None
        for batch in batches:
            for one, blob in zip(batch.column("slice").to_pylist(), batch.column("keys")):
                if one != now:
                    if now is not None and (out := cells()) is not None:
                        yield out
                    now, counts = one, np.zeros(1 << low, np.uint8)
                keys, times = np.unique(unzip_sorted(blob.as_buffer(), np.uint32), return_counts=True)
                counts[keys] = np.minimum(counts[keys] + times, least)
        if now is not None and (out := cells()) is not None:
            yield out

    if not 0 < least < 256:
        raise ValueError("counts are kept in bytes")
    slices = 1 << (bits - low)
    ordered = packed.repartition(slices, "slice").sortWithinPartitions("slice")
    return _collected(ordered.mapInArrow(run, "cell long, mask long"), kept)
