"""Benchmark passages inside documents: size-partitioned MinHash containment search, verified exactly.

An item of ``n`` distinct shingles is contained if at least ``ceil(threshold * n)`` of them are in the
document. Then, of any ``n - ceil(threshold * n) + 1`` shingles of the item, one is in the document; the
sketch of an item is that many least hashes of its shingles. Items are partitioned by size (powers
of two), which fixes the sketch length of a partition, so a short item inside a long document is found
without a similarity bound that its size could never reach, and none is missed. Documents
meet sketches in an equality join; what they share with an item is then counted exactly.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from loanmart.llm import blocks as B
from loanmart.llm.shared import utf8, written

SHINGLE = 5
THRESHOLD = 0.8
FILTER_BITS = 23  # the filter sent to tasks has 2 ** 23 bits (1 MB) however many items there are


def needed(n: int, threshold: float) -> int:
    return max(1, math.ceil(round(threshold * n, 9)))


def sketch_length(n: int, threshold: float) -> int:
    """For the size partition of ``n``: enough for its largest size."""
    most = (1 << n.bit_length()) - 1
    return min(n, most - needed(most, threshold) + 1)


def _shingles(data: np.ndarray, offsets: np.ndarray):
    """Row and hash of every shingle of lower-cased words."""
    words = B.Words(B.LOWER[data], offsets)
    hashes = B.window_hashes(words.hashes(), SHINGLE)
    inside = words.row[: len(hashes)] == words.row[SHINGLE - 1 :] if len(hashes) else np.zeros(0, bool)
    return words.row[: len(hashes)][inside], hashes[inside]


def sketches(items: DataFrame, id_col: str, text_col: str, threshold: float) -> DataFrame:
    """``hash, item``: the sketch of each item. Items with fewer words than a shingle have none."""

    def run(batches):
        for block in B.blocks(batches, "text"):
            row, hashes = _shingles(*B.text_bytes(block.column("text")))
            for i in np.unique(row):
                own = np.unique(hashes[row == i])
                least = own[: sketch_length(len(own), threshold)]
                item = pa.array([block.column("item")[int(i)].as_py()] * len(least), block.column("item").type)
                yield pa.RecordBatch.from_arrays([pa.array(least.view(np.int64)), item], ["hash", "item"])

    frame = items.select(F.col(id_col).alias("item"), utf8(text_col).alias("text"))
    return frame.mapInArrow(run, f"hash long, item {dict(items.dtypes)[id_col]}").distinct()


def _filter(table: DataFrame) -> bytes:
    """Bits of the sketch hashes; its size is fixed, more items only let more shingles pass."""
    size, mask = 1 << FILTER_BITS, (1 << FILTER_BITS) - 1
    places = table.select(F.col("hash").bitwiseAND(mask).alias("at")).distinct()
    # at most 2 ** 23 distinct places, packed to bytes before they reach the driver
    bit = F.expr("bit_or(shiftleft(1, CAST(at & 7 AS INT)))")
    packed = places.groupBy(F.shiftright("at", 3).alias("byte")).agg(bit.alias("bits"))
    found = packed.toPandas()
    out = np.zeros(size // 8, np.uint8)
    out[found["byte"].to_numpy()] = found["bits"].to_numpy()
    return out.tobytes()


def candidates(docs: DataFrame, table: DataFrame) -> DataFrame:
    """``doc, tag, item`` for documents that share a sketch hash with an item."""
    bits, mask = _filter(table), np.uint64((1 << FILTER_BITS) - 1)

    def run(batches):
        passing = np.frombuffer(bits, np.uint8)
        for block in B.blocks(batches, "text"):
            row, hashes = _shingles(*B.text_bytes(block.column("text")))
            at = (hashes & mask).astype(np.int64)
            ok = (passing[at >> 3] >> (at & 7)) & 1 > 0
            row, hashes = row[ok], hashes[ok]
            yield pa.RecordBatch.from_arrays(
                [block.column("doc").take(pa.array(row)), block.column("tag").take(pa.array(row)), pa.array(hashes.view(np.int64))],
                ["doc", "tag", "hash"],
            )

    kind = dict(docs.dtypes)["doc"]
    seen = docs.select("doc", "tag", "text").mapInArrow(run, f"doc {kind}, tag long, hash long")
    return seen.join(table, "hash").select("doc", "tag", "item").distinct()


def _words(text: str) -> Column:
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lowered, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))


def _distinct_shingles(words: str) -> Column:
    windows = F.transform(
        F.sequence(F.lit(1), F.size(words) - (SHINGLE - 1)), lambda i: F.array_join(F.slice(F.col(words), i, SHINGLE), " ")
    )
    return F.when(F.size(words) >= SHINGLE, F.array_distinct(windows)).otherwise(F.array().cast("array<string>"))


def find(docs: DataFrame, id_col: str, text_col: str, items: DataFrame, item_col: str, item_text: str, threshold: float = THRESHOLD) -> DataFrame:
    """``id_col, item_col, n_shingles, n_found`` for each document and each item it contains.

    Words are lower-cased (A-Z) runs of anything but ASCII white space, shingles are five words. Items
    with fewer words have no shingle and are contained nowhere; null texts have no words. Rows of ``docs``
    equal in id and text give one result, as do items with one id; equal ids with different texts
    are looked at each, and reported once with the larger count. Empty tables give an empty result.
    """
    frame = docs.select(F.col(id_col).alias("doc"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("tag"), utf8(text_col).alias("text"))
    table = written(sketches(items, item_col, item_text, threshold))
    pairs = written(candidates(frame, table))
    passages = items.select(F.col(item_col).alias("item"), F.coalesce(item_text, F.lit("")).alias("w")).select(
        "item", _words("w").alias("w")
    ).select("item", _distinct_shingles("w").alias("own"))
    listed = pairs.join(passages, "item").groupBy("doc", "tag").agg(F.collect_list(F.struct("item", "own")).alias("items"))
    match = frame["doc"].eqNullSafe(listed["doc"]) & (frame["tag"] == listed["tag"])
    read = frame.join(listed, match).select(frame["doc"], frame["text"].cast("string").alias("t"), "items")
    held = read.select("doc", _words("t").alias("w"), "items").select("doc", _distinct_shingles("w").alias("has"), "items")
    counted = held.select(
        "doc",
        F.inline(F.transform("items", lambda x: F.struct(
            x["item"].alias("item"), F.size(x["own"]).cast("long").alias("n_shingles"),
            F.size(F.array_intersect(x["own"], F.col("has"))).cast("long").alias("n_found"),
        ))),
    ).groupBy("doc", "item").agg(F.max("n_shingles").alias("n_shingles"), F.max("n_found").alias("n_found"))
    enough = F.col("n_found") >= F.greatest(F.lit(1), F.ceil(F.round(F.lit(threshold) * F.col("n_shingles"), 9)))
    return counted.where(enough).select(F.col("doc").alias(id_col), F.col("item").alias(item_col), "n_shingles", "n_found")
