"""SimHash near-duplicates: deletion-variant signatures, an equality join, verification, components.

Fingerprints that differ in at most ``d`` bits are cut into ``d // 2 + 1`` segments, so that one
segment differs in at most one bit. Each segment is indexed once for each of its bits with that bit
left out; two fingerprints to be linked share at least one such variant, and whoever shares one is
verified by counting differing bits. Nothing is sampled, and the candidates are complete.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from loanmart.llm.blocks import blocks
from loanmart.llm.components import components
from loanmart.llm.shared import utf8, written

BITS = 64
MEMBERS = 2048  # of one variant that are compared in one task; larger groups are dealt in pairs of parts
_LANES = np.uint64(0x0001000100010001)
_LANE_MAX = 65535


def _shingle_hashes(text: bytes, length: int) -> list[int]:
    words = text.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= length:
        return [xxhash.xxh64_intdigest(joined, 42)]
    ends, at = [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[:-length])]
    view, digest = memoryview(joined), xxhash.xxh64_intdigest
    return [digest(view[s:e], 42) for s, e in zip(starts, ends[length - 1 :])]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprint of each run of ``counts`` hashes: the bits set in over half of them."""
    out = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    # sixteen counters of 16 bits share a word, so a run is first summed in pieces they can hold
    pieces = -(-counts[some] // _LANE_MAX)
    first = np.repeat(np.cumsum(counts[some]) - counts[some], pieces)
    nth = np.arange(len(first)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    cuts, runs = first + nth * _LANE_MAX, np.cumsum(pieces) - pieces
    total = counts[some]
    found = np.zeros(len(some), np.uint64)
    for k in range(16):
        sums = np.add.reduceat((hashes >> np.uint64(k)) & _LANES, cuts)
        for lane in range(4):
            ones = np.add.reduceat((sums >> np.uint64(16 * lane)) & np.uint64(_LANE_MAX), runs)
            bit = (2 * ones.astype(np.int64) > total).astype(np.uint64)
            found |= bit << np.uint64(16 * lane + k)
    out[some] = found
    return out


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``(id, fingerprint)`` for every row, the 64 bits as a signed long; zero for texts without words."""

    def run(batches):
        for block in blocks(batches, "text"):
            each = [_shingle_hashes(t, shingle) for t in block.column("text").to_pylist()]
            counts = np.array([len(h) for h in each], np.int64)
            values = majority(np.array([x for h in each for x in h], np.uint64), counts)
            yield pa.RecordBatch.from_arrays(
                [block.column("id"), pa.array(values.view(np.int64))], ["id", "fingerprint"]
            )

    kind = dict(docs.dtypes)[id_col]
    frame = docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("text"))
    return frame.mapInArrow(run, f"id {kind}, fingerprint long")


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """Lowest bit and width of each segment."""
    n = max_bits // 2 + 1
    at = [BITS * i // n for i in range(n + 1)]
    return [(lo, hi - lo) for lo, hi in zip(at, at[1:])]


def variants(prints: DataFrame, max_bits: int) -> DataFrame:
    """``(segment, bits, f)``: each fingerprint under each segment with one of its bits left out.

    ``segment`` numbers the left-out bit over all segments, ``bits`` are the others of its segment.
    """
    masks, lows = [], []
    for low, width in _segments(max_bits):
        whole = ((1 << width) - 1) << low
        masks += [whole & ~(1 << bit) & (2**64 - 1) for bit in range(low, low + width)]
        lows += [low] * width
    masks_, n = np.array(masks, np.uint64), len(masks)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                f = batch.column(0).slice(at, 4096).to_numpy(zero_copy_only=False)
                bits = (f.view(np.uint64)[:, None] & masks_[None, :]).reshape(-1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.tile(np.arange(n, dtype=np.int32), len(f))),
                        pa.array(bits.view(np.int64)),
                        pa.array(np.repeat(f, n)),
                    ],
                    ["segment", "bits", "f"],
                )

    return prints.select("fingerprint").mapInArrow(run, "segment int, bits long, f long")


def _linked(values: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges that connect what is connected within one group, a forest: each value is met once."""
    edges, rest = [], values
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            centre = queue.pop()
            near = np.bitwise_count(rest ^ centre) <= max_bits
            found, rest = rest[near], rest[~near]
            if len(found):
                edges.append((np.full(len(found), centre), found))
                queue.extend(found)
    return edges


def _group_edges(max_bits: int):
    def of(keys: np.ndarray, f: np.ndarray):
        """Edges within runs of equal keys."""
        cut = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
        first = np.concatenate([[0], cut])
        size = np.diff(np.append(first, len(f)))
        out = []
        small = np.flatnonzero((size > 1) & (size <= 16))
        for d in range(1, 16):  # small groups at once: every pair at distance d in its group
            small = small[size[small] > d]
            if not len(small):
                break
            n = size[small] - d
            a = np.repeat(first[small], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            near = np.bitwise_count(f[a] ^ f[a + d]) <= max_bits
            out.append((f[a[near]], f[a[near] + d]))
        for i in np.flatnonzero(size > 16):
            out += _linked(np.unique(f[first[i] : first[i] + size[i]]), max_bits)
        if not out:
            return None
        a, b = (np.concatenate([x[i] for x in out]).view(np.int64) for i in (0, 1))
        pairs = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)], 1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    def run(batches):
        held_keys, held_f = np.zeros((0, 4), np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            keys = np.concatenate([held_keys, np.stack([c.astype(np.int64) for c in columns[:4]], 1)])
            f = np.concatenate([held_f, columns[4].view(np.uint64)])
            last = np.flatnonzero(np.any(keys != keys[-1], axis=1))
            done = last[-1] + 1 if len(last) else 0  # the last group may go on in the next batch
            if done and (edges := of(keys[:done], f[:done])) is not None:
                yield edges
            held_keys, held_f = keys[done:], f[done:]
        if len(held_f) and (edges := of(held_keys, held_f)) is not None:
            yield edges

    return run


def links(prints: DataFrame, max_bits: int) -> DataFrame:
    """Verified edges ``(a, b)`` between distinct fingerprints, enough to connect all that is linked.

    A variant shared by over ``MEMBERS`` fingerprints is dealt into parts, and each two parts meet
    in a task of their own, so no task holds more than two parts.
    """
    each = variants(prints, max_bits)
    crowded = written(
        each.groupBy("segment", "bits").count().where(F.col("count") > MEMBERS)
        .select("segment", "bits", F.ceil(F.col("count") / F.lit(MEMBERS)).cast("int").alias("parts"))
    )
    dealt = each.join(crowded, ["segment", "bits"], "left")
    part = F.pmod(F.xxhash64("f"), F.col("parts")).cast("int")
    other = F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), F.col("parts") - 1)))
    cells = (
        dealt.select("segment", "bits", "f", F.coalesce(part, F.lit(-1)).alias("part"), other.alias("other"))
        .where("part < 0 OR part <> other")
        .select("segment", "bits", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "f")
    )
    together = ["segment", "bits", "low", "high"]
    return (
        cells.repartition(*together).sortWithinPartitions(*together)
        .mapInArrow(_group_edges(max_bits), "a long, b long")
    )


def groups(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int) -> DataFrame:
    """One row per row of ``docs``: ``id_col, fingerprint (long), component_id``.

    ``component_id`` is the smallest id reachable over links of at most ``max_bits`` differing bits.
    Null, empty and blank texts have fingerprint zero and are linked like any other. Rows with equal
    ids stay separate rows; a null id gets a row too but names a component only if all its ids are null.
    Other columns are not looked at. An empty table gives an empty result.
    """
    prints = written(fingerprints(docs, id_col, text_col, shingle))
    distinct = written(prints.groupBy("fingerprint").agg(F.min("id").alias("first_id")))
    rooted = components(links(distinct, max_bits))
    own = distinct.join(rooted, distinct.fingerprint == rooted.node, "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root"), "first_id"
    )
    least = own.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = own.join(least, "root").select("fingerprint", "component_id")
    return prints.join(classes, "fingerprint").select(F.col("id").alias(id_col), "fingerprint", "component_id")


def one_of_each(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int) -> DataFrame:
    """One row of each group: that with the smallest id, nulls first, then by a hash of the text; all columns."""
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("tag"))
    found = groups(docs.withColumn("_key", key), "_key", text_col, shingle, max_bits)
    firsts = written(found.where(F.col("_key") == F.col("component_id")).select("_key.id", "_key.tag").distinct())
    keyed = docs.withColumns({"_id": key["id"], "_tag": key["tag"]})
    same = Window.partitionBy("_id", "_tag").orderBy("_tag")
    single = keyed.withColumn("_nth", F.row_number().over(same)).where("_nth = 1")
    return single.join(firsts, F.col("_id").eqNullSafe(firsts["id"]) & (F.col("_tag") == firsts["tag"]), "left_semi").drop("_id", "_tag", "_nth")
