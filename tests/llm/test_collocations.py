import re
from collections import Counter

import numpy as np
import pytest

from loanmart.llm import collocations as C
from loanmart.llm import sieve
from loanmart.llm.queries import ORACLES, QUERIES
from loanmart.llm.shared import ready
from tests.llm.brute import lowered
from tools.check_queries import compare, duck

NAME = "op12_collocations"
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def expected(rows, least=10, inside=50, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", lowered(text)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f.update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    found = {}
    for p, a in f.items():
        lang, *w = p
        if len(w) < 2 or a < least:
            continue
        around = [f[q] for q in f if len(q) == 4 and len(w) == 2 and q[0] == lang and (list(q[1:3]) == w or list(q[2:]) == w)] if len(w) == 2 else []
        if any(b >= least and 100 * b >= inside * a for b in around):
            continue
        cuts = [(1_000_000 * a * a // (f[p[: k + 1]] * f[(lang, *w[k:])]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[p[: k + 1]], f[(lang, *w[k:])]))
    return sorted(
        (lang, i, p.decode(), -a, l, r, n[lang], -s) for lang, all_ in found.items() for i, (s, a, p, l, r) in enumerate(sorted(all_)[:top], 1)
    )


def rows_of(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_same_rows_as_sql(spark, sf):
    folder = f"/root/testdata/sf{sf}"
    assert compare(QUERIES[NAME](spark, folder), duck(folder), ORACLES[NAME]) == ""


def few_words(seed, n=300, words=("a", "b", "The", "x|", "ñandú", "c")):
    draw = np.random.default_rng(seed)
    return [
        (draw.choice(["en", "fr"]) if i % 9 else None, "".join(w + str(draw.choice([" ", "  ", "\t", ", ", "\n", " "])) for w in draw.choice(words, draw.integers(1, 40), p=[0.4, 0.2, 0.1, 0.1, 0.1, 0.1])))
        for i in range(n)
    ]


def frame(spark, rows):
    return ready(spark).createDataFrame([(*(None if v is None else str(v) for v in r), 1, "x") for r in rows], "lang string, text string, n int, w1 string")


@pytest.mark.parametrize("bucket", [400_000, 40, 7, 1])
def test_scans_go_over_partition_boundaries(spark, monkeypatch, bucket):
    """Down to one row a partition, so that beginnings and extensions lie several partitions apart."""
    monkeypatch.setattr(C, "ROWS_PER_BUCKET", bucket)
    rows = few_words(bucket % 5)
    assert rows_of(C.mine(frame(spark, rows), "text", "lang", top=30)) == expected(rows, top=30)


def test_small_batches(spark, monkeypatch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rows = few_words(3)
        assert rows_of(C.mine(frame(spark, rows), "text", "lang", least=5, inside=80)) == expected(rows, 5, 80)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_odd_texts_ties_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK_BYTES", 1000)
    rows = [("en", None), (None, ""), ("en", " .,;"), ("en", "new york city! " * 40), ("en", "left right " * 20_000), ("und", "same tie. tie same. " * 30), (None, "same tie. tie same\x0b" * 5)]
    assert rows_of(C.mine(frame(spark, rows), "text", "lang")) == expected(rows)
    assert C.mine(frame(spark, []), "text", "lang").collect() == []
    assert C.mine(frame(spark, [("en", "once only")]), "text", "lang").collect() == []


@pytest.mark.parametrize("bits, rows", [(20, 1), (30, 40_000_000)])
def test_sieve_never_holds_back_a_frequent_key(spark, bits, rows):
    from pyspark.sql import functions as F
    import pyarrow as pa

    draw = np.random.default_rng(1)
    keys = draw.integers(0, 2**63, 3000, dtype=np.uint64) * np.uint64(2)
    times = draw.integers(1, 8, 3000)
    parts = np.array_split(draw.permutation(np.repeat(keys, times)), 5)

    def packed(batches):
        for batch in batches:
            for i in batch.column(0).to_pylist():
                yield from sieve.pack(parts[i], bits)

    table = ready(spark).range(5).mapInArrow(packed, "slice int, keys binary")
    found = sieve.of_frequent(table, bits, 4, rows).passes(keys)
    assert found[times >= 4].all() and found[times < 4].mean() < 0.1
    frame = spark.createDataFrame([(int(k),) for k in keys[:500].view(np.int64)], "k long")
    passed = sieve.of_keys(frame, "k", 500).passes(keys)
    assert passed[:500].all() and passed[500:].mean() < 0.1
