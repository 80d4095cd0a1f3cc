"""Repeated word sequences by recompression.

Every round names globally, by a hash of what is named, first each run of one symbol and then each
pair of neighbours whose sides (a random half of all symbols is left, the rest right) allow it. A
symbol is settled within a sequence of words if those words alone force it; equal sequences then
have the same settled symbols at the same places, whatever surrounds them. Each window of words is
assigned its least settled symbol of the highest round; equal windows choose equal symbols, so

1. symbols are brought together with all their windows by a distributed sort (``sorted_runs``): symbols
   met once have no repeated window, and equal stretches of windows are repeats of the first;
2. the windows of shared symbols with different surroundings are compared one by one, by the symbol
   sequence they have after the rounds and by an independent hash of their words.

Names and sequences are compared by 64-bit hashes, windows by two of them. Nothing is sampled, no pairs are
formed, and a symbol shared by many documents is spread over many buckets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loanmart.llm import blocks as B
from loanmart.llm.shared import utf8
from loanmart.llm.sorted_runs import mark

ROUNDS = 2
PIECE = 1 << 20  # bytes of a long document looked at together
_NEVER = np.int64(1 << 40)


class Symbols:
    """A sequence of names with the words each spans and the words that settle it.

    ``left`` and ``right`` are the first word and the one after the last; words ``need_left`` to ``need_right``
    force the symbol to be there. At a document's ends a symbol is never settled by words alone.
    """

    def __init__(self, names: np.ndarray, row: np.ndarray):
        at = np.arange(len(names))
        self.names, self.row = names, row
        self.left, self.right = at, at + 1
        self.need_left, self.need_right = at, at + 1

    def _joined(self, first: np.ndarray, names: np.ndarray, need_left: np.ndarray, need_right: np.ndarray) -> Symbols:
        """Symbols from groups of neighbours that start at ``first``."""
        out = object.__new__(Symbols)
        out.names, out.row = names, self.row[first]
        out.left = self.left[first]
        out.right = np.append(self.left[first[1:]], self.right[-1])
        out.need_left, out.need_right = need_left, need_right
        return out

    def runs(self, salt: int) -> Symbols:
        """Names each maximal run; known only together with what stands before and after it."""
        n = len(self.names)
        new = np.ones(n, bool)
        new[1:] = (self.names[1:] != self.names[:-1]) | (self.row[1:] != self.row[:-1])
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, n))
        last = first + size - 1
        names = self.names[first]
        long = size > 1
        names = np.where(long, B.mix(B.mix(names + np.uint64(salt)) + size.astype(np.uint64)), names)
        need_left = np.full(len(first), -_NEVER)
        inner = (first > 0) & (self.row[np.maximum(first - 1, 0)] == self.row[first])
        need_left[inner] = np.minimum(self.need_left[first[inner] - 1], self.need_left[first[inner]])
        need_right = np.full(len(first), _NEVER)
        inner = (last < n - 1) & (self.row[np.minimum(last + 1, n - 1)] == self.row[first])
        need_right[inner] = np.maximum(self.need_right[last[inner] + 1], self.need_right[last[inner]])
        return self._joined(first, names, need_left, need_right)

    def pairs(self, salt: int) -> Symbols:
        """Names each left symbol followed by a right one; a single symbol is known with the neighbour it could have joined."""
        n = len(self.names)
        left_side = (B.mix(self.names ^ np.uint64(salt)) & np.uint64(1)).astype(bool)
        pair = np.zeros(n, bool)
        pair[:-1] = left_side[:-1] & ~left_side[1:] & (self.row[1:] == self.row[:-1])
        second = np.zeros(n, bool)
        second[1:] = pair[:-1]
        first = np.flatnonzero(~second)
        paired = pair[first]
        after = np.minimum(first + 1, n - 1)
        names = np.where(
            paired, B.mix(B.mix(self.names[first] + np.uint64(salt)) * np.uint64(3) + self.names[after]), self.names[first]
        )
        need_left, need_right = self.need_left[first].copy(), self.need_right[first].copy()
        need_left[paired] = np.minimum(need_left[paired], self.need_left[after[paired]])
        need_right[paired] = np.maximum(need_right[paired], self.need_right[after[paired]])
        alone = np.flatnonzero(~paired)
        i = first[alone]
        ahead = left_side[i]
        has_next = (i < n - 1) & (self.row[np.minimum(i + 1, n - 1)] == self.row[i])
        has_last = (i > 0) & (self.row[np.maximum(i - 1, 0)] == self.row[i])
        nxt, prev = np.minimum(i + 1, n - 1), np.maximum(i - 1, 0)
        need_right[alone] = np.where(
            ahead, np.where(has_next, np.maximum(self.need_right[i], self.need_right[nxt]), _NEVER), need_right[alone]
        )
        need_left[alone] = np.where(
            ahead, need_left[alone], np.where(has_last, np.minimum(self.need_left[i], self.need_left[prev]), -_NEVER)
        )
        return self._joined(first, names, need_left, need_right)


def rounds(hashes: np.ndarray, row: np.ndarray) -> list[Symbols]:
    """The words and the symbols after each round."""
    levels = [Symbols(hashes, row)]
    for i in range(ROUNDS if len(hashes) else 0):
        levels.append(levels[-1].runs(2 * i + 1).pairs(2 * i + 2))
    return levels


def choose(levels: list[Symbols], first: np.ndarray, length: int):
    """For each window the word where its least settled symbol of the highest round starts, and that round.

    ``first[r]:first[r + 1]`` are the words of row ``r``. Returns windows' ``start, row, chosen, level``.
    """
    room = np.maximum(np.diff(first) - length + 1, 0)
    row = np.repeat(np.arange(len(room)), room)
    start = np.arange(len(row)) - np.repeat(np.cumsum(room) - room, room) + first[row]
    chosen, level = np.full(len(start), -1), np.zeros(len(start), np.int64)
    open_ = np.arange(len(start))
    size, bits = len(levels[0].names), np.uint64(max(1, len(levels[0].names)).bit_length())
    most = ~np.uint64(0)
    for i in range(len(levels) - 1, -1, -1):
        symbols = levels[i]
        rank = np.full(size, most)
        rank[symbols.left] = (B.mix(symbols.names) >> bits << bits) | symbols.left.astype(np.uint64)
        before, after = np.full(size, _NEVER), np.full(size, _NEVER)
        before[symbols.left] = symbols.left - symbols.need_left
        after[symbols.left] = symbols.need_right - symbols.left
        before, after = np.minimum(before, 1000).astype(np.int16), np.minimum(after, 1000).astype(np.int16)
        least = np.full(len(open_), most)
        s = start[open_]
        for d in range(length):
            at = s + d
            ok = (before[at] <= d) & (after[at] <= length - d)
            np.minimum(least, np.where(ok, rank[at], most), out=least)
        found = least != most
        chosen[open_[found]] = (least[found] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        level[open_[found]] = i
        open_ = open_[~found]
        if not len(open_):
            break
    return start, row, chosen, level


def _pieces(batches, length: int, extra: tuple = ()):
    """Blocks of whole documents; pieces of long ones, which share ``length - 1`` words.

    Yields the block, its words, and the number of words before it in its document.
    """
    for block in B.blocks(batches, "text"):
        data, offsets = B.text_bytes(block.column("text"))
        if len(data) <= 2 * PIECE:
            yield block, B.Words(data, offsets), 0
            continue
        for row in range(block.num_rows):
            one = data[offsets[row] : offsets[row + 1]]
            words = B.Words(one, np.array([0, len(one)]))
            n, at = len(words.start), 0
            while True:
                end = at + int(np.searchsorted(words.start[at:], words.start[at] + PIECE)) if n else 0
                part = one[words.start[at] : words.end[min(end + length - 1, n) - 1]] if n else one[:0]
                yield block.slice(row, 1), B.Words(part, np.array([0, len(part)])), at
                at = end
                if at > n - length:
                    break


class Sums:
    """Hash of any stretch of words at once."""

    def __init__(self, hashes: np.ndarray):
        powers, self.inverse = B._powers(len(hashes) + 1)
        self.total = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * powers[: len(hashes)], out=self.total[1:])

    def hash(self, start, end, salt=0) -> np.ndarray:
        salt = np.asarray(salt, np.int64).astype(np.uint64)
        plain = (self.total[end] - self.total[start]) * self.inverse[start]
        return B.mix(B.mix(plain + (end - start).astype(np.uint64)) + salt)


SYMBOL = ["symbol", "whole", "doc", "tag", "first", "windows"]


def _symbols(docs: DataFrame, length: int) -> DataFrame:
    """A row for each run of windows that chose the same symbol."""

    def run(batches):
        for block, words, base in _pieces(batches, length):
            hashes = words.hashes()
            levels = rounds(hashes, words.row)
            start, row, chosen, level = choose(levels, words.first, length)
            if not len(start):
                continue
            new = np.ones(len(start), bool)
            new[1:] = (chosen[1:] != chosen[:-1]) | (level[1:] != level[:-1]) | (row[1:] != row[:-1])
            a = np.flatnonzero(new)
            z = np.append(a[1:], len(start)) - 1
            names = np.zeros(len(a), np.uint64)
            for i, symbols in enumerate(levels):
                at = np.zeros(len(hashes), np.int64)
                at[symbols.left] = np.arange(len(symbols.left))
                mine = level[a] == i
                own = at[chosen[a[mine]]]
                # the words that settle the symbol are in every window, so they say more than its name
                known = Sums(hashes).hash(symbols.need_left[own], symbols.need_right[own], i)
                names[mine] = B.mix(symbols.names[own] + known)
            whole = Sums(hashes).hash(start[a], start[z] + length, chosen[a] - start[a])
            doc, tag = (block.column(c).to_numpy(zero_copy_only=False)[row[a]] for c in ("doc", "tag"))
            columns = [names.view(np.int64), whole.view(np.int64), doc, tag, start[a] - words.first[row[a]] + base, z - a + 1]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], SYMBOL)

    return docs.mapInArrow(run, ", ".join(f"{c} long" for c in SYMBOL))


def signatures(hashes: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Hash of the symbols that each window alone, cut out of its document, has after the rounds."""
    out = np.zeros(len(starts), np.uint64)
    for at in range(0, len(starts), 1 << 14):
        own = starts[at : at + (1 << 14)]
        words = hashes[(own[:, None] + np.arange(length)).reshape(-1)]
        last = rounds(words, np.repeat(np.arange(len(own)), length))[-1]
        first = np.searchsorted(last.row, np.arange(len(own) + 1))
        out[at : at + len(own)] = Sums(last.names).hash(first[:-1], first[1:], 7)
    return out


WINDOW = ["sequence", "check", "doc", "tag", "first"]


def _windows(docs: DataFrame, undecided: DataFrame, length: int) -> DataFrame:
    """Every window of undecided symbols."""
    listed = undecided.groupBy("doc", "tag").agg(F.collect_list(F.struct("first", "windows")).alias("runs"))

    def run(batches):
        for block in B.blocks(batches, "text"):
            data, offsets = B.text_bytes(block.column("text"))
            words = B.Words(data, offsets)
            hashes = words.hashes()
            runs = block.column("runs")
            begin, size = (runs.flatten().field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            row = np.repeat(np.arange(block.num_rows), np.asarray(runs.value_lengths()))
            within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            row, begin = np.repeat(row, size), np.repeat(begin, size) + within
            start = begin + words.first[row]
            columns = [
                signatures(hashes, start, length).view(np.int64),
                Sums(hashes).hash(start, start + length).view(np.int64),
                block.column("doc").to_numpy(zero_copy_only=False)[row],
                block.column("tag").to_numpy(zero_copy_only=False)[row],
                begin,
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], WINDOW)

    joined = docs.join(listed, ["doc", "tag"]).select("doc", "tag", "text", "runs")
    return joined.mapInArrow(run, ", ".join(f"{c} long" for c in WINDOW))


def _cut(text: bytes, runs: list[int] | None, length: int):
    words = text.split()
    if not runs:
        return len(words), 0, b" ".join(words)
    packed = np.array(runs, np.int64)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, packed // 4096, 1)
    np.add.at(change, packed // 4096 + packed % 4096 + length - 1, -1)
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return len(words), len(words) - len(kept), b" ".join([words[i] for i in kept.tolist()])


def _rest(docs: DataFrame, repeated: DataFrame, length: int) -> DataFrame:
    listed = repeated.groupBy("doc", "tag").agg(F.collect_list(F.col("first") * 4096 + F.col("windows")).alias("runs"))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                out = [_cut(t, r, length) for t, r in zip(part.column("text").to_pylist(), part.column("runs").to_pylist())]
                counts = (pa.array([o[i] for o in out], pa.int64()) for i in (0, 1))
                kept = pa.array([o[2] for o in out], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("id"), *counts, kept], ["id", "n_words", "n_removed", "kept"])

    joined = docs.join(listed, ["doc", "tag"], "left").select("id", "text", "runs")
    return joined.mapInArrow(run, f"id {dict(docs.dtypes)['id']}, n_words long, n_removed long, kept binary")


def remove_repeats(docs: DataFrame, id_col: str, text_col: str, length: int) -> DataFrame:
    """``id_col, n_words, n_removed, kept`` for each row: its words, joined by a space, without those
    covered by a window of ``length`` words that starts earlier too (smaller id, or same document and earlier).

    Words are runs of anything but ASCII white space. Ids are whole numbers, null before all others. Rows
    with equal ids and different texts are different documents in the order of a hash of the text; rows equal in both
    count as one document, and each gets its result. Null texts have no words, and an empty table gives
    an empty result. Other columns are not looked at.
    """
    text = utf8(text_col)
    frame = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("doc"),
        F.xxhash64(text).alias("tag"), text.alias("text"),
    )
    texts = frame.drop("id")
    symbols = mark(_symbols(texts, length), SYMBOL, outer=1, inner=2)
    single = mark(_windows(texts, symbols.where("mixed AND NOT earlier"), length), WINDOW, outer=2, inner=2)
    found = symbols.where("earlier").select("doc", "tag", "first", "windows").union(
        single.where("earlier").select("doc", "tag", "first", F.lit(1).cast("long").alias("windows"))
    )
    return _rest(frame, found, length).withColumnRenamed("id", id_col)


def digest(kept: DataFrame) -> DataFrame:
    return kept.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
