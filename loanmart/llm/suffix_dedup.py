"""Repeated byte strings by a sparse suffix array.

A string of ``length`` bytes is repeated if it starts at two places. Instead of sorting the suffixes at
all places, each window of ``length`` bytes is assigned the suffix in it whose leading token (the hash
of its first bytes) is least; equal windows choose the same place, so only windows of suffixes with
equal leading tokens can be equal. These suffixes are range-partitioned by leading tokens with sampled
splitters, buckets are sorted locally by multikey quicksort and compared across boundaries
(``sorted_runs``). That is done three times, each time only with what is left undecided:

1. suffixes, with all their windows together as the longer token: equal ones are repeated as a whole;
2. of the different suffixes, stretches of neighbouring windows: what all of a stretch have in
   common must be shared, and stretches that are equal as a whole are repeated as a whole;
3. of the rest, single windows.

Strings are compared by 64-bit hashes of their bytes. A suffix shared by many documents is spread
over many buckets; no pairs are formed. Memory follows the block of text, not the document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loanmart.llm import blocks as B
from loanmart.llm.shared import forget, utf8, written
from loanmart.llm.sorted_runs import mark

LEAD = 32  # bytes of a suffix's leading token
STRETCH = 32  # neighbouring windows decided together
PIECE = 1 << 20  # bytes of a long document looked at together


class Prefix:
    """Prefix sums over bytes: the hash of any byte range at once."""

    def __init__(self, data: np.ndarray):
        size = len(data)
        self.powers, self.inverse = B._powers(size + 1)
        self.total = np.zeros(size + 1, np.uint64)
        np.cumsum(B._BYTE_VALUES[data] * self.powers[:size], out=self.total[1:])

    def hash(self, start: np.ndarray, end: np.ndarray, salt=0) -> np.ndarray:
        salt = np.asarray(salt, np.int64).astype(np.uint64)
        plain = (self.total[end] - self.total[start]) * self.inverse[start]
        return B.mix(B.mix(plain + (end - start).astype(np.uint64)) + salt)


def choose(prefix: Prefix, offsets: np.ndarray, length: int, lead: int):
    """Runs of windows with the same least leading token: ``row, first, last, chosen`` places."""
    size, width = len(prefix.total) - 1, length - lead + 1
    none = np.zeros(0, np.int64)
    if size < length:
        return none, none, none, none
    at = np.arange(size - lead + 1)
    leading = B.mix((prefix.total[lead:] - prefix.total[:-lead]) * prefix.inverse[: len(at)])
    bits = np.uint64(int(size).bit_length())
    least = (leading >> bits << bits) | at.astype(np.uint64)
    span = 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    chosen = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    room = np.maximum(np.diff(offsets) - length + 1, 0)  # windows stay within their document
    row = np.repeat(np.arange(len(room)), room)
    if not len(row):
        return none, none, none, none
    start = np.arange(len(row)) - np.repeat(np.cumsum(room) - room, room) + offsets[row]
    chosen = chosen[start]
    new = np.ones(len(start), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return row[first], start[first], start[last], chosen[first]


def _pieces(batches, length: int):
    """Blocks of whole documents, and pieces of long ones that share ``length - 1`` bytes.

    Yields the block's rows, their byte offsets, the bytes, and where the block starts in its document.
    """
    for block in B.blocks(batches, "text"):
        data, offsets = B.text_bytes(block.column("text"))
        if len(data) <= 2 * PIECE:
            yield block, offsets, data, 0
            continue
        for row in range(block.num_rows):
            one = data[offsets[row] : offsets[row + 1]]
            for at in range(0, max(len(one) - length + 1, 1), PIECE):
                part = one[at : at + PIECE + length - 1]
                yield block.slice(row, 1), np.array([0, len(part)]), part, at


def _suffixes(docs: DataFrame, length: int) -> DataFrame:
    """``lead, whole, doc, tag, first, place, windows``: a row for each run of windows with one suffix."""

    def run(batches):
        for block, offsets, data, base in _pieces(batches, length):
            prefix = Prefix(data)
            row, first, last, chosen = choose(prefix, offsets, length, LEAD)
            if not len(row):
                continue
            origin = offsets[row]
            doc, tag = (block.column(c).to_numpy(zero_copy_only=False)[row] for c in ("doc", "tag"))
            columns = {
                "lead": prefix.hash(chosen, chosen + LEAD).view(np.int64),
                "whole": prefix.hash(first, last + length, chosen - first).view(np.int64),
                "doc": doc, "tag": tag, "first": first - origin + base,
                "place": chosen - first, "windows": last - first + 1,
            }
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], list(columns))

    return docs.mapInArrow(run, ", ".join(f"{c} long" for c in SUFFIX))


SUFFIX = ["lead", "whole", "doc", "tag", "first", "place", "windows"]


def _regions(docs: DataFrame, undecided: DataFrame, length: int) -> DataFrame:
    """The bytes under the windows of undecided suffixes: ``doc, tag, first, lead, place, data``."""
    listed = undecided.groupBy("doc", "tag").agg(F.collect_list(F.struct("first", "windows", "place", "lead")).alias("runs"))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, min(256, batch.num_rows - at))
                data, offsets = B.text_bytes(part.column("text"))
                runs = part.column("runs")
                fields = [runs.flatten().field(i).to_numpy(zero_copy_only=False) for i in range(4)]
                counts = np.asarray(runs.value_lengths())
                row = np.repeat(np.arange(part.num_rows), counts)
                start = fields[0] + offsets[row]
                end = start + fields[1] + length - 1
                view = memoryview(data)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc": part.column("doc").to_numpy(zero_copy_only=False)[row],
                        "tag": part.column("tag").to_numpy(zero_copy_only=False)[row],
                        "first": fields[0], "lead": fields[3], "place": fields[2],
                        "data": pa.array([view[s:e].tobytes() for s, e in zip(start.tolist(), end.tolist())], pa.binary()),
                    }
                )

    joined = docs.join(listed, ["doc", "tag"]).select("doc", "tag", "text", "runs")
    return joined.mapInArrow(run, "doc long, tag long, first long, lead long, place long, data binary")


def _stretches(regions: DataFrame, length: int) -> DataFrame:
    """``common, whole, doc, tag, first, windows, region``: aligned to the suffix, so equal windows fall in equal stretches."""

    def run(batches):
        for block in B.blocks(batches, "data"):
            data, offsets = B.text_bytes(block.column("data"))
            prefix = Prefix(data)
            n = np.diff(offsets) - length + 1
            place, lead, first = (block.column(c).to_numpy(zero_copy_only=False) for c in ("place", "lead", "first"))
            row = np.repeat(np.arange(len(n)), n)
            s = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)  # window within its region
            back = place[row] - s  # the suffix starts so far after the window
            stretch = np.floor_divide(back, STRETCH)
            new = np.ones(len(s), bool)
            new[1:] = (row[1:] != row[:-1]) | (stretch[1:] != stretch[:-1])
            a = np.flatnonzero(new)
            size = np.diff(np.append(a, len(s)))
            r, s0, low = row[a], s[a], stretch[a] * STRETCH
            origin = offsets[r]
            begin = origin + s0
            core = origin + place[r] - low  # start of the last window the whole stretch may have
            columns = {
                "common": prefix.hash(core, core - (STRETCH - 1) + length, lead[r] + low),
                "whole": prefix.hash(begin, begin + size - 1 + length, back[a]),
                "doc": block.column("doc").to_numpy(zero_copy_only=False)[r],
                "tag": block.column("tag").to_numpy(zero_copy_only=False)[r],
                "first": first[r] + s0, "windows": size, "region": first[r],
            }
            yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns.values()], list(columns))

    return regions.mapInArrow(run, ", ".join(f"{c} long" for c in STRETCHES))


SINGLE = ["window", "doc", "tag", "first"]
STRETCHES = ["common", "whole", "doc", "tag", "first", "windows", "region"]


def _single(regions: DataFrame, undecided: DataFrame, length: int) -> DataFrame:
    """``window, doc, tag, first`` for every window of the undecided stretches."""
    listed = undecided.groupBy("doc", "tag", "region").agg(F.collect_list(F.struct("first", "windows")).alias("runs"))

    def run(batches):
        for block in B.blocks(batches, "data"):
            data, offsets = B.text_bytes(block.column("data"))
            prefix = Prefix(data)
            runs = block.column("runs")
            begin, size = (runs.flatten().field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            row = np.repeat(np.arange(block.num_rows), np.asarray(runs.value_lengths()))
            within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            row, begin = np.repeat(row, size), np.repeat(begin, size) + within
            region = block.column("region").to_numpy(zero_copy_only=False)[row]
            at = begin - region + offsets[row]
            columns = {
                "window": prefix.hash(at, at + length).view(np.int64),
                "doc": block.column("doc").to_numpy(zero_copy_only=False)[row],
                "tag": block.column("tag").to_numpy(zero_copy_only=False)[row],
                "first": begin,
            }
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], list(columns))

    named = regions.withColumnRenamed("first", "region").select("doc", "tag", "region", "data")
    joined = named.join(listed, ["doc", "tag", "region"])
    return joined.mapInArrow(run, "window long, doc long, tag long, first long")


def _rest(docs: DataFrame, repeated: DataFrame, length: int) -> DataFrame:
    """Each row with ``n_bytes, n_removed, n_spans`` and ``kept``: the bytes no repeated window covers."""
    listed = repeated.groupBy("doc", "tag").agg(
        F.collect_list(F.col("first") * 4096 + F.col("windows")).alias("runs")
    )

    def run(batches):
        for batch in batches:
            texts, runs = batch.column("text"), batch.column("runs")
            for at in range(0, batch.num_rows, 64):
                out = [_cut(t, r, length) for t, r in zip(texts.slice(at, 64).to_pylist(), runs.slice(at, 64).to_pylist())]
                part = batch.slice(at, 64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        *(pa.array([o[i] for o in out], pa.int64()) for i in range(3)),
                        pa.array([o[3] for o in out], pa.binary()),
                    ],
                    ["id", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    joined = docs.join(listed, ["doc", "tag"], "left").select("id", "text", "runs")
    kind = dict(docs.dtypes)["id"]
    return joined.mapInArrow(run, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")


def _cut(text: bytes, runs: list[int] | None, length: int):
    if not runs:
        return len(text), 0, 0, text
    packed = np.sort(np.array(runs, np.int64))
    start, end = packed // 4096, packed // 4096 + packed % 4096 + length - 1
    reach = np.maximum.accumulate(end)
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > reach[:-1]  # touching runs are one
    first = np.flatnonzero(new)
    start, end = start[first], reach[np.append(first[1:], len(reach)) - 1]
    kept, at = [], 0
    for s, e in zip(start.tolist(), end.tolist()):
        kept.append(text[at:s])
        at = e
    kept.append(text[at:])
    return len(text), int((end - start).sum()), len(start), b"".join(kept)


def remove_repeats(docs: DataFrame, id_col: str, text_col: str, length: int) -> DataFrame:
    """``id_col, n_bytes, n_removed, n_spans, kept`` for each row: its bytes without any byte covered
    by a ``length``-byte string that also starts elsewhere, in another document or the same.

    Ids are whole numbers. Rows with equal ids and different texts are different documents; rows equal in both count as
    one document, and each gets its result. Null texts are empty; nothing is found in texts
    shorter than ``length``, and an empty table gives an empty result. Other columns are not looked at.
    """
    if not LEAD + STRETCH <= length <= 2048:
        raise ValueError("length must be from 64 to 2048 bytes")
    text = utf8(text_col)
    frame = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("doc"),
        F.xxhash64(text).alias("tag"), text.alias("text"),
    )
    texts = frame.drop("id")
    undecided = "mixed AND NOT earlier"  # one of each kind
    suffixes = mark(_suffixes(texts, length), SUFFIX, outer=1, inner=2)
    regions = written(_regions(texts, suffixes.where(undecided), length))
    stretches = mark(_stretches(regions, length), STRETCHES, outer=1, inner=2)
    single = mark(_single(regions, stretches.where(undecided), length), SINGLE, outer=1, inner=1)
    forget(regions)
    found = (
        suffixes.where("earlier OR later").select("doc", "tag", "first", "windows")
        .union(stretches.where("earlier OR later").select("doc", "tag", "first", "windows"))
        .union(single.select("doc", "tag", "first", F.lit(1).cast("long").alias("windows")))
    )
    return _rest(frame, found, length).withColumnRenamed("id", id_col)


def digest(kept: DataFrame) -> DataFrame:
    return kept.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
