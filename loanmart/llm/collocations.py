"""Phrase collocations from count streams in prefix and in suffix order.

Phrases of one to ``LONGEST`` words are counted over all documents. The counts are kept as two streams: sorted by
words from the first on, a phrase stands behind its own beginning, so one scan that remembers the open phrases gives
each phrase the counts of its left parts and each beginning its most frequent right extension; sorted by words
from the last on, the same scan gives right parts and left extensions. The two scans are merge-joined in lockstep. A scan
goes over range partitions, so a word of any frequency is spread over many; what a partition must know
of those before and after it is one row a partition.

Rare phrases need not be counted by name: sieves of all words and pairs, then of all triples, found often enough come
first, and only what they let through is counted. They never hold back a frequent phrase.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.ipc  # noqa: F401
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from loanmart.llm import blocks as B
from loanmart.llm import sieve
from loanmart.llm.shared import partitions, utf8, written

LONGEST = 3
BLOCK_BYTES = 3 << 20  # text whose phrases are counted before they leave a task
ROWS_PER_BUCKET = 400_000
ROWS_PER_TASK = 1_000_000  # phrases a task adds up before they leave it
SLICE_BYTES = 16 << 20  # text whose phrases a task counts at once, from all over the corpus
_BREAK = B.byte_class(b".,;:!?\n\x0b\x0c\r")
_WORD = ~_BREAK & ~B.byte_class(b" \t")
WORDS = ["w1", "w2", "w3"]


class _Pieces:
    """Words of a block of texts as numbers, and which of them follow each other in a piece of one text."""

    def __init__(self, block: pa.RecordBatch):
        data, offsets = B.text_bytes(block.column("text"))
        data = B.LOWER[data]
        start, end, row = B.spans(_WORD[data], offsets)
        piece = np.cumsum(_BREAK[data], dtype=np.int32)[start]
        words = B.cut_out(data, start, end).dictionary_encode()
        del data, start, end
        languages = block.column("lang").dictionary_encode()
        self.names, self.languages = words.dictionary, languages.dictionary
        self.word = words.indices.to_numpy().astype(np.int64)
        self.language = languages.indices.to_numpy().astype(np.int64)[row]
        # whether the word after this one is in the same piece
        self.pair = np.flatnonzero((row[1:] == row[:-1]) & (piece[1:] == piece[:-1]))

        hashes = (
            np.fromiter((xxhash.xxh3_64_intdigest(s) for s in names.cast(pa.binary()).to_pylist()), np.uint64, len(names))
            for names in (self.names, self.languages)
        )
        of_word, of_language = hashes
        self.in_language = (of_language * B._STEP)[self.language]
        self.hash = of_word[self.word]
        self.word_keys = B.mix(self.in_language + self.hash)
        first, second = self.pair, self.pair + 1
        self.pair_keys = B.mix((self.word_keys[first] + B._STEP) * B._STEP + self.hash[second])

    def sieved(self, sieves: list[sieve.Sieve]) -> None:
        """Keeps the words and pairs that the first sieve lets through, and triples of such pairs, with their keys."""
        self.words = np.flatnonzero(sieves[0].passes(self.word_keys))
        passed = sieves[0].passes(self.pair_keys)
        self.pair, self.pair_keys = self.pair[passed], self.pair_keys[passed]
        number = np.full(len(self.word) + 1, -1, np.int64)
        number[self.pair] = np.arange(len(self.pair))
        two = np.flatnonzero(number[self.pair + 1] >= 0)
        self.triple = self.pair[two]
        self.triple_keys = B.mix((self.pair_keys[two] + B._STEP) * B._STEP + self.hash[self.triple + 2])
        if len(sieves) > 1:
            passed = sieves[1].passes(self.triple_keys)
            self.triple, self.triple_keys = self.triple[passed], self.triple_keys[passed]


def _packed(sieves: list[sieve.Sieve], bits: int, least: int):
    """Keys of the words and pairs, or with a sieve of these of the triples, of each block, each at most ``least`` times:
    more would not change what is asked."""

    def run(batches):
        for block in B.sized_blocks(batches, "text", BLOCK_BYTES):
            p = _Pieces(block)
            if sieves:
                p.sieved(sieves)
            found = p.triple_keys if sieves else np.concatenate([p.word_keys, p.pair_keys])
            keys, times = np.unique(found, return_counts=True)
            if len(keys):
                yield from sieve.pack(np.repeat(keys, np.minimum(times, least)), bits)

    return run


GRAM = ["lang", *WORDS]


def _block_counts(block: pa.RecordBatch, sieves: list[sieve.Sieve]) -> pa.Table | None:
    """``key, lang, w1, w2, w3, n`` of a block's phrases; shorter ones have empty words, that of no word counts all words."""
    p = _Pieces(block)
    if not len(p.word):
        return None
    size = len(p.names)
    p.sieved(sieves)
    passed, triple, first = p.pair, p.triple, p.language * size + p.word
    pairs, pair_at, pair_n = np.unique(first[passed] * size + p.word[passed + 1], return_index=True, return_counts=True)
    wide = np.searchsorted(pairs, first[triple] * size + p.word[triple + 1]) * size + p.word[triple + 2]
    _, triple_at, triple_n = np.unique(wide, return_index=True, return_counts=True)
    _, word_at, word_n = np.unique(first[p.words], return_index=True, return_counts=True)
    _, all_at, all_n = np.unique(p.language, return_index=True, return_counts=True)
    levels = [
        (all_at, all_n, B.mix(p.in_language[all_at])), (p.words[word_at], word_n, p.word_keys[p.words[word_at]]),
        (passed[pair_at], pair_n, p.pair_keys[pair_at]), (triple[triple_at], triple_n, p.triple_keys[triple_at]),
    ]
    parts = []
    for length, (at, n, keys) in enumerate(levels):
        blank = pa.array([""] * len(at), pa.string())
        words = [p.names.take(pa.array(p.word[at + i])) if i < length else blank for i in range(LONGEST)]
        columns = [pa.array(keys.view(np.int64)), p.languages.take(pa.array(p.language[at])), *words, pa.array(n)]
        parts.append(pa.RecordBatch.from_arrays(columns, ["key", *GRAM, "n"]))
    return pa.Table.from_batches(parts)


def _added_up(tables: list[pa.Table], more: tuple[str, ...] = ()) -> pa.Table:
    """Counts of equal phrases together."""
    names = [*more, *GRAM]
    summed = pa.concat_tables(tables).group_by(names, use_threads=False).aggregate([("n", "sum")])
    return summed.select([*names, "n_sum"]).rename_columns([*names, "n"])


def _counted(sieves: list[sieve.Sieve], slices: int):
    """``slice, counts``: the phrases of a task's blocks, added up while they are few, sorted, and packed by slice of their hashes."""

    def packed(table: pa.Table):
        of = table.column("key").to_numpy().view(np.uint64) >> np.uint64(64 - 16)
        table = table.append_column("slice", pa.array((of % np.uint64(slices)).astype(np.int32))).drop_columns(["key"])
        table = table.sort_by([(c, "ascending") for c in ("slice", *GRAM)]).combine_chunks()
        numbers = table.column("slice").to_numpy()
        found, at = np.unique(numbers, return_index=True)
        blobs = []
        for start, end in zip(at.tolist(), [*at[1:].tolist(), len(numbers)]):
            sink = pa.BufferOutputStream()
            part = pa.Table.from_arrays([pa.concat_arrays(table.column(c).slice(start, end - start).chunks) for c in (*GRAM, "n")], [*GRAM, "n"])
            with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(part)
            blobs.append(sink.getvalue().to_pybytes())
        return pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(blobs, pa.binary())], ["slice", "counts"])

    def run(batches):
        held = None
        for block in B.sized_blocks(batches, "text", BLOCK_BYTES):
            found = _block_counts(block, sieves)
            if found is None:
                continue
            held = found if held is None else _added_up([held, found], ("key",))
            if held.num_rows > ROWS_PER_TASK:
                yield packed(held)
                held = None
            del found
            pa.default_memory_pool().release_unused()  # tables come and go; the worker should not keep their memory
        if held is not None:
            yield packed(held)
            del held
            pa.default_memory_pool().release_unused()

    return run


def _summed(least: int):
    """``lang, w1, w2, w3, n`` of phrases found often enough; a slice at a time."""

    def run(batches):
        def total(held):
            summed = _added_up(held)
            for batch in summed.filter(pc.greater_equal(summed.column("n"), least)).to_batches(max_chunksize=100_000):
                yield batch

        now, held = None, []
        for batch in batches:
            for one, blob in zip(batch.column("slice").to_pylist(), batch.column("counts")):
                if one != now and held:
                    yield from total(held)
                    held = []
                    pa.default_memory_pool().release_unused()
                now = one
                held.append(pa.ipc.open_stream(blob.as_buffer()).read_all())
        if held:
            yield from total(held)

    return run


def phrase_counts(docs: DataFrame, text_col: str, lang_col: str, least: int) -> DataFrame:
    """``lang, w1, w2, w3, n`` of every phrase found ``least`` times or more within pieces; see ``mine``."""
    texts = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), utf8(text_col).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = sieve.counted_bits(size // 6)
    sieves = []
    for _ in ("words and pairs", "triples"):
        packed = texts.mapInArrow(_packed(list(sieves), bits, least), "slice int, keys binary")
        sieves.append(sieve.of_frequent(packed, bits, least, size // 6))
    slices = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // SLICE_BYTES))
    counted = texts.mapInArrow(_counted(sieves, slices), "slice int, counts binary")
    ordered = counted.repartition(slices, "slice").sortWithinPartitions("slice")
    return ordered.mapInArrow(_summed(least), "lang string, w1 string, w2 string, w3 string, n long")


SCANNED = "lang string, a string, b string, c string, n long, depth int, n0 long, n1 long, n2 long, most long, bucket int, last boolean"


def _scan(batches):
    """Goes over ``lang, a, b, c, n`` in order; gives phrases of two and three words the counts of their beginnings
    (``n0, n1, n2`` of 0, 1, 2 words) and, to those of two words, that of their most frequent extension.

    Ends with a row of depth -1: the last count seen of each length, and the most frequent extension of a phrase that
    began before this partition; ``last`` there says that no other phrase began in it.
    """
    bucket, known, waiting, best, head = TaskContext.get().partitionId(), [None] * 3, None, 0, 0
    names = ["lang", "a", "b", "c", "n", "depth", "n0", "n1", "n2", "most", "bucket", "last"]
    kinds = [pa.string()] * 4 + [pa.int64(), pa.int32()] + [pa.int64()] * 4 + [pa.int32(), pa.bool_()]

    def rows(columns):
        return pa.RecordBatch.from_arrays([pa.array(c, k) if not isinstance(c, pa.Array) else c for c, k in zip(columns, kinds)], names)

    def one(row, last):
        return rows([[v] for v in (*row, best, bucket, last)])

    seen = False
    for batch in batches:
        size = batch.num_rows
        if not size:
            continue
        seen = True
        n = batch.column("n").to_numpy()
        depth = sum((pc.binary_length(batch.column(c)).to_numpy() > 0).astype(np.int32) for c in "abc")
        place = np.arange(size)
        above, carried = [], []
        for d in range(3):
            at = np.maximum.accumulate(np.where(depth == d, place, -1))
            above.append(at)
            value = n[at]
            carried.append(pa.array(np.where(at >= 0, value, known[d] or 0), mask=(at < 0) & (known[d] is None)))
        most = np.zeros(size, np.int64)
        deep = depth == 3
        outside = deep & (above[2] < 0)
        np.maximum.at(most, above[2][deep & ~outside], n[deep & ~outside])
        if outside.any():
            top = int(n[outside].max())
            best, head = (max(best, top), head) if waiting else (best, max(head, top))
        twos = np.flatnonzero(depth == 2)
        take = depth >= 2
        if len(twos):
            if waiting:
                yield one(waiting, False)
            at = int(twos[-1])
            waiting = [batch.column(c)[at].as_py() for c in ("lang", "a", "b", "c", "n")] + [2] + [c[at].as_py() for c in carried]
            best, take[at] = int(most[at]), False
        known = [int(n[at[-1]]) if at[-1] >= 0 else k for at, k in zip(above, known)]
        picked = pa.array(np.flatnonzero(take))
        columns = [batch.column(c) for c in ("lang", "a", "b", "c", "n")] + [pa.array(depth)] + carried + [pa.array(most)]
        yield rows([c.take(picked) for c in columns] + [np.full(len(picked), bucket), np.zeros(len(picked), bool)])
    if waiting:
        yield one(waiting, True)
    if seen:
        yield rows([[v] for v in (None, None, None, None, None, -1, *known, head, bucket, waiting is None)])


def _beginnings(counts: DataFrame, columns: list[str]) -> DataFrame:
    """``lang, a, b, c, n, n0, n1, n2, most`` of phrases of two and three words, with ``a, b, c`` read from ``columns``."""
    spark = counts.sparkSession
    stream = counts.select("lang", *[F.expr(c).alias(n) for c, n in zip(columns, "abc")], "n")
    keys = ["lang", "a", "b", "c"]
    spread = stream.repartitionByRange(partitions(spark, counts.count(), ROWS_PER_BUCKET), *keys)
    scanned = written(spread.sortWithinPartitions(*keys).mapInArrow(_scan, SCANNED))
    # one row a partition: what stands open before it, and how far a phrase's extensions go on behind it
    edges = sorted(scanned.where("depth = -1").select("bucket", "n0", "n1", "n2", "most", "last").collect())
    before, onward, carry = [None] * 3, [], []
    for e in edges:
        carry.append([e.bucket, *before])
        before = [v if v is not None else b for v, b in zip((e.n0, e.n1, e.n2), before)]
    after = 0
    for e in reversed(edges):
        onward.append(after)
        after = max(e.most, after) if e["last"] else e.most
    fills = [(*c, o) for c, o in zip(carry, reversed(onward))]
    fill = F.broadcast(spark.createDataFrame(fills, "bucket int, f0 long, f1 long, f2 long, onward long"))
    full = {f"n{d}": F.coalesce(f"n{d}", f"f{d}") for d in range(3)}
    full["most"] = F.when(F.col("last"), F.greatest("most", "onward")).otherwise(F.col("most"))
    return scanned.where("depth > 0").join(fill, "bucket").withColumns(full).select("lang", "a", "b", "c", "n", "depth", "n0", "n1", "n2", "most")


def mine(docs: DataFrame, text_col: str, lang_col: str, least: int = 10, inside: int = 50, top: int = 2000) -> DataFrame:
    """The ``top`` collocations of each language: ``lang, rank, phrase, a, l, r, n, score``.

    A-Z are lower-cased, texts cut into pieces at ``.,;:!?`` and line ends, pieces into words at spaces and tabs; a null or
    empty text has none, a null language is ``und``, repeated rows count each. Candidates are phrases of two and three
    words found ``a >= least`` times. Cut after some word, they have a left part found ``l`` times and a right part found
    ``r`` times; the cut with the lowest floor(1000000 a a / (l r)) gives the score, the first of equal ones. A candidate goes
    if a longer one around it is found at least ``inside`` percent as often. Ties are ranked by ``a``, then by the phrase's
    bytes. ``n`` counts the language's words. Counts below 10**15 are exact in all products. No rows give no rows.
    """
    counts = written(phrase_counts(docs, text_col, lang_col, least))
    left = _beginnings(counts, WORDS)
    last_first = ["CASE WHEN w3 <> '' THEN w3 WHEN w2 <> '' THEN w2 ELSE w1 END", "CASE WHEN w3 <> '' THEN w2 WHEN w2 <> '' THEN w1 ELSE '' END", "CASE WHEN w3 <> '' THEN w1 ELSE '' END"]
    right = _beginnings(counts, last_first)
    both = (
        left.select("lang", F.col("a").alias("w1"), F.col("b").alias("w2"), F.col("c").alias("w3"), F.col("n").alias("count"), F.col("n0").alias("n"),
                    "depth", F.col("n1").alias("l1"), F.col("n2").alias("l2"), F.col("most").alias("wider"))
        .hint("merge")
        .join(
            right.select(
                "lang", F.when(F.col("depth") == 3, F.col("c")).otherwise(F.col("b")).alias("w1"),
                F.when(F.col("depth") == 3, F.col("b")).otherwise(F.col("a")).alias("w2"), F.when(F.col("depth") == 3, F.col("a")).otherwise("").alias("w3"),
                F.col("n1").alias("r1"), F.col("n2").alias("r2"), F.col("most").alias("wider_left"),
            ),
            ["lang", *WORDS],
        )
    )
    stays = (F.col("depth") == LONGEST) | (100 * F.greatest("wider", "wider_left") < inside * F.col("count"))
    square = "CAST(count AS DECIMAL(15)) * CAST(count AS DECIMAL(15)) * 1000000"
    cut = "({0}) div (CAST({1} AS DECIMAL(15)) * CAST({2} AS DECIMAL(15)))"
    scored = both.where(stays).select(
        "lang", "n", F.col("count").alias("a"), F.concat_ws(" ", "w1", "w2", F.when(F.col("w3") != "", F.col("w3"))).alias("phrase"),
        # the right part of the first cut has one word less than the phrase
        F.col("l1"), F.expr("CASE WHEN depth = 2 THEN r1 ELSE r2 END").alias("r_first"),
        F.col("l2"), F.col("r1").alias("r_second"), "depth",
        F.expr(cut.format(square, "l1", "(CASE WHEN depth = 2 THEN r1 ELSE r2 END)")).alias("first"),
        F.expr(f"CASE WHEN depth = 3 THEN {cut.format(square, 'l2', 'r1')} END").alias("second"),
    )
    later = F.coalesce(F.col("second") < F.col("first"), F.lit(False))
    ranked = scored.select(
        "lang", "phrase", "a", F.when(later, F.col("l2")).otherwise(F.col("l1")).alias("l"),
        F.when(later, F.col("r_second")).otherwise(F.col("r_first")).alias("r"), "n",
        F.when(later, F.col("second")).otherwise(F.col("first")).alias("score"),
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the first of each part of a language, then the first of these: no task ranks a whole language
    part = F.pmod(F.xxhash64("phrase"), F.lit(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    firsts = ranked.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    final = firsts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return final.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
