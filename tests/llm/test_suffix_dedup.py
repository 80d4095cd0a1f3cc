from collections import Counter

import numpy as np
import pytest

from loanmart.llm import sorted_runs, suffix_dedup
from loanmart.llm.queries import QUERIES
from loanmart.llm.shared import ready
from tests.llm.brute import sha


def expected(ids, texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for key, d in zip(ids, data):
        gone = np.zeros(len(d) + 1, np.int64)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        mask = np.cumsum(gone)[:-1] > 0
        spans = int(mask[:1].sum() + (mask[1:] & ~mask[:-1]).sum())
        kept = bytes(np.frombuffer(d, np.uint8)[~mask])
        out.append((key, len(d), int(mask.sum()), spans, sha(kept)))
    return sorted(out)


def found(frame, length):
    got = suffix_dedup.digest(suffix_dedup.remove_repeats(frame, "doc_id", "text", length))
    return sorted(tuple(r) for r in got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())


def test_query_equals_brute_force(spark, small):
    got = QUERIES["op6_suffix_array_dedup"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, got)) == expected([r["doc_id"] for r in small], [r["text"] for r in small], 400)


@pytest.mark.parametrize("seed", [0, 1])
def test_planted_repeats_at_every_offset(spark, monkeypatch, seed):
    monkeypatch.setattr(sorted_runs, "ROWS_PER_BUCKET", 50)
    monkeypatch.setattr(suffix_dedup, "PIECE", 500)
    rng = np.random.default_rng(seed)
    letters = list("abé \n")
    base = ["".join(rng.choice(letters, 400)) for _ in range(6)]
    texts = [None, "", "x" * 700, "x" * 63, "ab" * 200, "ab" * 200, "a" * 64 + "b" + "a" * 64]
    for _ in range(60):
        parts = []
        for _ in range(rng.integers(1, 5)):
            source = base[rng.integers(0, 6)]
            a, n = rng.integers(0, 330), rng.integers(40, 140)
            parts += [source[a : a + n], "".join(rng.choice(letters, rng.integers(0, 30)))]
        texts.append("".join(parts))
    texts.append("".join(rng.choice(letters, 4000)) + base[0])
    ready(spark)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert found(frame, 64) == expected(range(len(texts)), texts, 64)


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    ready(spark)
    text = "".join(chr(97 + i * i % 23) for i in range(150))
    schema = "doc_id long, text string, tag string, doc int, first int, id string"
    rows = [(1, text, "x", 1, 1, "i")] * 2 + [(1, text[:100], "x", 1, 1, "i"), (None, "q" * 10, "x", 1, 1, "i")]
    got = found(spark.createDataFrame(rows, schema).where("doc_id = 1"), 64)
    assert got == sorted(expected([1, 1], [text, text[:100]], 64) + expected([1, 1], [text, text[:100]], 64)[1:])
    assert len(found(spark.createDataFrame(rows[2:], schema).where("doc_id is null"), 64)) == 1
    assert found(spark.createDataFrame([], schema), 64) == []


def test_multikey_order_sorts():
    rng = np.random.default_rng(3)
    columns = [rng.integers(0, k, 5000) for k in (5, 4, 3, 1000)]
    order = sorted_runs.multikey_order(columns)
    assert [tuple(c[i] for c in columns) for i in order] == sorted(zip(*columns))
