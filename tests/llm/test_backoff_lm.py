import ctypes
import re
import zlib
from collections import Counter
from math import log10

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loanmart.llm import backoff_lm as M, sieve
from loanmart.llm.queries import QUERIES
from loanmart.llm.shared import give_back, ready
from tests.llm.brute import lowered, words

COLUMNS = ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
END = "\n"


class Plain:
    """The same model with dictionaries: interpolated probabilities, histories of up to two tokens."""

    def __init__(self, texts, least, discount):
        self.c, self.discount = Counter(), discount
        for t in texts:
            s = [END, *words(lowered(t)), END]
            for k in (1, 2, 3):
                self.c.update(tuple(s[i : i + k]) for i in range(1 if k == 1 else 0, len(s) - k + 1))
        self.total = sum(n for g, n in self.c.items() if len(g) == 1)
        self.distinct = sum(len(g) == 1 for g in self.c)
        self.c = Counter({g: n for g, n in self.c.items() if len(g) == 1 or n >= least})
        self.after = {}
        for g, n in self.c.items():
            if len(g) > 1:
                k, t = self.after.get(g[:-1], (0, 0))
                self.after[g[:-1]] = (k + 1, t + n)

    def p(self, history, w):
        if not history:
            return (self.c[(w,)] + 0.5) / (self.total + 0.5 * (self.distinct + 1))
        lower = self.p(history[1:], w)
        if history not in self.after:
            return lower
        kept, total = self.after[history]
        n = self.c[history]
        return max(0, self.c[(*history, w)] - self.discount) / n + (1 - (total - self.discount * kept) / n) * lower


def expected(rows, least=M.LEAST, discount=M.DISCOUNT):
    """``rows``: (id, text, held out)."""
    model, out = Plain([t for _, t, h in rows if not h], least, discount), []
    for i, t, h in rows:
        s = [END, *words(lowered(t)), END]
        moves = range(1, len(s))
        out.append(
            (i, bool(h), len(s) - 1, sum(model.c[(s[k],)] > 0 for k in moves), model.total,
             sum(log10(model.p((), s[k])) for k in moves), sum(log10(model.p(tuple(s[max(0, k - 2) : k]), s[k])) for k in moves))
        )
    return out


def same(got, want):
    key = lambda r: (str(r[0]), r[2], round(r[6], 3))
    got, want = sorted((tuple(r[c] for c in COLUMNS) for r in got), key=key), sorted(want, key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_equals_plain_model(spark, sf):
    folder = f"/root/testdata/sf{sf}"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    rows = [(i, t, zlib.crc32(str(i).encode()) % 5 == 1) for i, t in docs]
    got = [r.asDict() for r in QUERIES["op13_backoff_scores"](spark, folder).withColumnRenamed("doc_id", "id").collect()]
    same(got, expected(rows))
    held = [r for r in got if r["held_out"]]
    assert held and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def random_rows(seed, n=120):
    draw = np.random.default_rng(seed)
    return [(i, " ".join(draw.choice(list("abCdé"), draw.integers(0, 60), p=[0.5, 0.2, 0.1, 0.1, 0.1])), bool(draw.random() < 0.3)) for i in range(n)]


def scores(spark, rows, **how):
    frame = ready(spark).createDataFrame([(*r, 1, "x") for r in rows], "id int, body string, h boolean, block int, text string")
    return M.score(frame, "id", "body", F.col("h"), **how).collect()


@pytest.mark.parametrize("block, lane, slice_rows, least", [(16 << 20, 512, 2_000_000, 5), (200, 3, 100, 2), (40, 1, 300, 1), (3000, 7, 1000, 3)])
def test_blocks_slices_and_lanes_change_nothing(spark, monkeypatch, block, lane, slice_rows, least):
    monkeypatch.setattr(M, "SLICE_ROWS", slice_rows)
    rows = random_rows(lane)
    same(scores(spark, rows, block_bytes=block, lane=lane, least=least), expected(rows, least))


def test_probabilities_add_up(spark):
    """Over all tokens and one that is unknown, after every history."""
    rows = random_rows(5)
    model = Plain([t for _, t, h in rows if not h], 2, 0.75)
    tokens = [g[0] for g in model.c if len(g) == 1]
    for history in [(), *model.after]:
        assert sum(model.p(history, w) for w in [*tokens, "never seen"]) == pytest.approx(1)


def test_odd_rows(spark):
    rows = [(None, "a a a", False), (1, None, False), (1, None, False), (2, "", True), (3, " \n\t", None), (4, "one\x00two É x", True), (5, "a a a a b " * 30_000, True)]
    rows += [(6, "a a a", False)] * 9 + [(7, "A" * 100_000, False)]
    same(scores(spark, rows, lane=100), expected(rows))
    same(scores(spark, [(1, "a b", True), (2, None, True)]), expected([(1, "a b", True), (2, None, True)]))
    assert scores(spark, []) == []


def test_counting_arrays_are_small_and_their_size_changes_nothing(spark):
    assert 1 << M.COUNTING_BITS <= 32 << 20
    rng = np.random.default_rng(3)
    keys = np.repeat(rng.integers(0, 2**64, 3000, np.uint64), rng.integers(1, 9, 3000))
    passed = []
    for slice_bits in (26, M.COUNTING_BITS, 24):
        batches = [b for part in np.array_split(keys, 3) for b in sieve.pack(part, 28, slice_bits)]
        assert max(max(b.column("slice").to_pylist()) for b in batches) < 1 << (28 - slice_bits)
        packed = spark.createDataFrame(pa.Table.from_batches(batches)).selectExpr("cast(slice AS int) slice", "keys")
        passed.append(sieve.of_frequent(packed, 28, 5, len(keys), slice_bits).passes(keys).tolist())
    assert passed[0] == passed[1] == passed[2] and 0 < sum(passed[0]) < len(keys)


@pytest.mark.parametrize("top", [50, 1 << 40, 1 << 62])
def test_distinct_codes(top):
    codes = np.random.default_rng(1).integers(0, top, 300)
    codes = np.concatenate([codes, codes[:100], [0, top - 1]])
    code, at, n = M._distinct(codes.copy(), top)
    want = np.unique(codes, return_inverse=True, return_counts=True)
    assert all(np.array_equal(g, w) for g, w in zip((code, at, n), want)) and at.dtype == np.int32
    assert [len(x) for x in M._distinct(codes[:0], top)] == [0, 0, 0]


def test_rounds_share_out_the_blocks_and_change_nothing(spark, monkeypatch):
    """What is asked, answered and dealt out at once is that of a part of the blocks, and each block is in one round."""
    monkeypatch.setattr(M, "HELD_ROWS", 60)  # so that tasks pass on their counts in several parts
    seen, kept = [], M.written
    monkeypatch.setattr(M, "written", lambda df: seen.append(df.columns) or kept(df))
    rows = random_rows(8)
    for rounds in (1, 3, 4):
        monkeypatch.setattr(M, "ROUNDS", rounds)
        seen.clear()
        same(scores(spark, rows, block_bytes=150, lane=5, least=2), expected(rows, 2))
        assert sum("base_score" in columns for columns in seen) == rounds - 1


def held_mb():
    with open("/proc/self/smaps_rollup") as f:
        return int(re.search(r"\nPss_Anon:\s+(\d+)", f.read())[1]) / 1024


@pytest.mark.skipif(not hasattr(ctypes.CDLL(None), "malloc_trim"), reason="not glibc")
def test_workers_give_back_what_blocks_took(monkeypatch):
    held = [bytearray(b"x" * 50_000) for _ in range(4000)]
    del held[:-1]  # the last one keeps the rest from going back by itself
    before = held_mb()
    give_back()
    assert held_mb() < before - 100
    times = []
    monkeypatch.setattr(M, "give_back", lambda: times.append(1))
    batch = pa.RecordBatch.from_pydict({"x": [1, 2, 3]})
    for n, _ in enumerate(M._block_rows([batch, batch])):
        assert len(times) == n + 1
    assert len(times) == 7
