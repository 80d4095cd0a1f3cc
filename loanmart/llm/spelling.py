"""Grouping of spelling variants: words one edit apart, each joined to a far more frequent neighbour.

Letters are hashed to ``SYMBOLS`` symbols. A word's reduced form is at most one edit away from that of every word at
most one edit away from it, and the full one-edit neighbourhood of a reduced form is small, as there are few
symbols to replace or insert. So the neighbourhoods of all reduced words are equality-joined with the reduced vocabulary,
and what meets is verified on the original strings. Neighbourhoods are rows of 64-bit hashes, of which a sieve
drops those that no reduced word has before anything is shuffled. A reduced form shared by over ``CROWD`` words is
not expanded: words that reach it meet its words over shared one-letter deletions of the originals, groups that the
alphabet and the word length bound.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from loanmart.llm import blocks as B
from loanmart.llm import sieve
from loanmart.llm.shared import utf8, written

SYMBOLS = 8
CROWD = 256
BLOCK_BYTES = 8 << 20  # text a task looks at together
CELLS = 1 << 20  # hashes or code points a task holds at once, for words up to that length
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LETTER = B.byte_class(bytes([*range(65, 91), *range(97, 123)]))
_LEAD = 0xC3  # first byte of U+00C0 to U+00FF


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def _crc32(data: np.ndarray, start: np.ndarray, end: np.ndarray, before: np.ndarray) -> np.ndarray:
    """CRC-32 of each span, going on from the CRC-32 of what stands before it."""
    order = np.argsort(start - end, kind="stable")
    at, size = start[order], (end - start)[order]
    state = ~before[order].astype(np.uint32)
    live = len(order)
    for step in range(min(64, int(size[0]) if live else 0)):
        live = int(np.searchsorted(-size, -step, "left"))
        head = state[:live]
        state[:live] = _CRC[(head ^ data[at[:live] + step]) & 255] ^ (head >> 8)
    state = ~state
    for i in range(int(np.searchsorted(-size, -64, "left"))):
        state[i] = zlib.crc32(data[at[i] + 64 : at[i] + size[i]].tobytes(), int(state[i]))
    out = np.empty_like(state)
    out[order] = state
    return out


def vocabulary(docs: DataFrame, id_col: str, text_col: str, slip: int | None = None, min_length: int = 6, least: int = 5) -> DataFrame:
    """``word, n`` of all runs of letters (A-Z, a-z, U+00C0 to U+00FF), A-Z lower-cased, found ``least`` times or more.

    ``slip`` plants typing slips to be found again: where it divides the CRC-32 of ``<id>:<run>``, the code point at that
    CRC-32 modulo the run's length is left out. Words have ``min_length`` code points or more. Null and empty
    texts have no words, a null id reads as an empty one, repeated rows count each, other columns are not looked at.
    """

    def run(batches):
        for block in B.sized_blocks(batches, "text", BLOCK_BYTES):
            data, offsets = B.text_bytes(block.column("text"))
            if not len(data):
                continue
            data = B.LOWER[data]
            lead = data == _LEAD
            letter = _LETTER[data] | lead
            letter[1:] |= lead[:-1]
            start, end, row = B.spans(letter, offsets)
            doubles = np.zeros(len(data) + 1, np.int64)
            np.cumsum(lead, out=doubles[1:])
            length = end - start - (doubles[end] - doubles[start])
            w = np.flatnonzero(length >= min_length)
            start, end, row, length = start[w], end[w], row[w], length[w]
            broken = []
            if slip:
                heads = np.array([zlib.crc32(h.as_py()) for h in block.column("head")], np.uint32)
                crc = _crc32(data, start, end, heads[row])
                for i in np.flatnonzero((crc % slip == 0) & (length > min_length)):
                    word = data[start[i] : end[i]].tobytes().decode()
                    at = int(crc[i]) % len(word)
                    broken.append(word[:at] + word[at + 1 :])
                whole = np.flatnonzero(crc % slip != 0)
                start, end = start[whole], end[whole]
            words = pa.concat_arrays([B.cut_out(data, start, end), pa.array(broken, pa.string())])
            counts = words.value_counts()
            yield pa.RecordBatch.from_arrays([counts.field(0), counts.field(1)], ["word", "n"])

    head = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":")).cast("binary")
    found = docs.select(head.alias("head"), utf8(text_col).alias("text")).mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _symbols(words: np.ndarray, length: int, symbols: int) -> np.ndarray:
    """Symbols 1 to ``symbols`` of words that have ``length`` code points each, a row a word."""
    points = words.astype(f"<U{length}").view(np.uint32).reshape(len(words), length).astype(np.uint64)
    return B.mix(points * _BASE) % np.uint64(symbols) + np.uint64(1)


def _prefixes(symbols: np.ndarray, powers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Polynomial hashes of the first ``i`` symbols, and of those from ``i`` on, for every ``i``."""
    m, length = symbols.shape
    before, after = np.zeros((m, length + 1), np.uint64), np.zeros((m, length + 1), np.uint64)
    for i in range(length):
        before[:, i + 1] = before[:, i] * _BASE + symbols[:, i]
    for i in range(length - 1, -1, -1):
        after[:, i] = symbols[:, i] * powers[length - 1 - i] + after[:, i + 1]
    return before, after


def _powers(n: int) -> np.ndarray:
    powers = np.full(n, _BASE, np.uint64)
    powers[:1] = 1
    return np.multiply.accumulate(powers)


def _by_length(batch: pa.RecordBatch, cells: int):
    """Places and texts of the words of a batch, those of one length together, few enough for ``cells`` cells."""
    lengths = pc.utf8_length(batch.column("word")).to_numpy()
    words = np.array(batch.column("word").to_pylist() + [""], object)[:-1]
    for length in np.unique(lengths):
        places = np.flatnonzero(lengths == length)
        step = max(1, cells // (int(length) + 1))
        for at in range(0, len(places), step):
            yield places[at : at + step], words[places[at : at + step]], int(length)


def _reduced(symbols: int):
    """Adds ``key``, the hash of the reduced form."""

    def run(batches):
        for batch in batches:
            keys = np.zeros(batch.num_rows, np.uint64)
            for places, words, length in _by_length(batch, CELLS):
                before, _ = _prefixes(_symbols(words, length, symbols), _powers(length + 1))
                keys[places] = B.mix(before[:, -1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys.view(np.int64))], [*batch.schema.names, "key"])

    return run


def _neighbourhoods(known: sieve.Sieve, symbols: int):
    """The words with the hash of each form at most one edit from their own reduced form, if ``known`` lets it through."""

    def run(batches):
        for batch in batches:
            for places, words, length in _by_length(batch, CELLS // (2 * symbols)):
                powers = _powers(length + 2)
                before, after = _prefixes(_symbols(words, length, symbols), powers)
                keys = [before[:, -1:], before[:, :-1] * powers[:length][::-1] + after[:, 1:]]
                for symbol in range(1, symbols + 1):
                    added = before * _BASE + np.uint64(symbol)
                    keys.append(added[:, :-1] * powers[:length][::-1] + after[:, 1:])
                    keys.append(added * powers[: length + 1][::-1] + after)
                keys = np.sort(B.mix(np.concatenate(keys, axis=1)), axis=1)
                wanted = known.passes(keys)
                wanted[:, 1:] &= keys[:, 1:] != keys[:, :-1]
                row, column = np.nonzero(wanted)
                picked = batch.take(pa.array(places[row]))
                yield pa.RecordBatch.from_arrays(
                    [*picked.columns, pa.array(keys[row, column].view(np.int64))], [*batch.schema.names, "key"]
                )

    return run


def _deletions(batches):
    """The words with the hashes of themselves and of themselves without one code point."""
    for batch in batches:
        for places, words, length in _by_length(batch, CELLS):
            points = words.astype(f"<U{length}").view(np.uint32).reshape(len(words), length).astype(np.uint64)
            powers = _powers(length + 2)
            before, after = _prefixes(points + np.uint64(1), powers)
            keys = np.concatenate([before[:, -1:], before[:, :-1] * powers[:length][::-1] + after[:, 1:]], axis=1)
            keys = np.sort(B.mix(keys), axis=1)
            wanted = np.ones(keys.shape, bool)
            wanted[:, 1:] = keys[:, 1:] != keys[:, :-1]
            row, column = np.nonzero(wanted)
            picked = batch.take(pa.array(places[row]))
            yield pa.RecordBatch.from_arrays([*picked.columns, pa.array(keys[row, column].view(np.int64))], ["word", "n", "part"])


def near_words(vocab: DataFrame, symbols: int = SYMBOLS, crowd: int = CROWD) -> DataFrame:
    """``word, n, near, near_n``: all ordered pairs of words of a table ``word, n`` that are exactly one edit apart."""
    columns = "word string, n long, key long"
    reduced = written(vocab.mapInArrow(_reduced(symbols), columns))
    known = sieve.of_keys(reduced, "key", reduced.count())
    reach = written(vocab.mapInArrow(_neighbourhoods(known, symbols), columns))
    crowded = written(reduced.groupBy("key").count().where(F.col("count") > crowd).select("key"))
    others = reduced.select(F.col("word").alias("near"), F.col("n").alias("near_n"), "key")
    verified = F.levenshtein("word", "near", 1) == 1
    met = reach.join(others.join(crowded, "key", "left_anti"), "key").where(verified).drop("key")
    if crowded.isEmpty():
        return met
    dense = reduced.join(crowded, "key", "left_semi").select("word", "n").mapInArrow(_deletions, "word string, n long, part long")
    coming = reach.join(crowded, "key", "left_semi").select("word", "n").distinct().mapInArrow(_deletions, "word string, n long, part long")
    dense = dense.select(F.col("word").alias("near"), F.col("n").alias("near_n"), "part")
    return met.union(coming.join(dense, "part").where(verified).drop("part").distinct())


def group(vocab: DataFrame, factor: int = 5, symbols: int = SYMBOLS, crowd: int = CROWD) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for every word of a table ``word, n`` (words distinct).

    ``form`` is the near word of largest ``n`` (ties: the first in code-point order) where that is at least ``factor``
    times the word's own, else null; ``root`` is reached by following forms and is the word itself without one. As
    counts rise by the factor with each form, the rounds of the last step follow from the largest count.
    """
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    found = near_words(vocab, symbols, crowd).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    enough = -F.col("best.less") >= factor * F.col("n")
    words = written(
        vocab.join(found, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, F.col("best.form")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"),
        )
    )
    most, least = words.agg(F.max("n"), F.min("n")).first()
    jumps = words.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    steps = 0 if most is None else math.floor(math.log(max(1, most / max(1, least)), factor) + 1e-9)
    for _ in range(max(0, steps - 1).bit_length()):
        jumps = written(jumps)
        onward = jumps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumps = jumps.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return words.join(jumps, "word", "left").withColumn("root", F.coalesce("root", "word"))
