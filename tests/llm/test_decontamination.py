import math

import numpy as np

from loanmart.llm import decontamination as D
from loanmart.llm.queries import ORACLES, QUERIES
from loanmart.llm.shared import ready
from tests.llm.brute import lowered, words
from tools.check_queries import compare, duck


def shingles(text):
    w = words(lowered(text))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def expected(docs, items):
    out = {}
    for d, text in docs:
        for i, passage in items:
            own = shingles(passage)
            n = len(own & shingles(text))
            if own and n >= math.ceil(round(0.8 * len(own), 9)):
                out[d, i] = max(out.get((d, i), (0, 0)), (len(own), n))
    return sorted((*k, *v) for k, v in out.items())


def test_same_rows_as_sql(spark):
    name, folder = "op5_benchmark_decontamination", "/root/testdata/sf0.001"
    assert compare(QUERIES[name](spark, folder), duck(folder), ORACLES[name]) == ""


def test_items_at_the_threshold_inside_long_documents(spark, monkeypatch):
    monkeypatch.setattr(D, "FILTER_BITS", 6)  # a full filter must not change the result
    rng = np.random.default_rng(0)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choice(vocabulary, n))) for i, n in enumerate([5, 6, 9, 14, 24, 40, 70, 130])]
    items += [(90, None), (91, ""), (92, "too few words here"), (93, "Ab AB ab aB ab ab")]
    docs = [(0, None), (1, ""), (2, "x y z"), (3, "AB ab ab AB ab ab q")]
    for k in range(60):
        passage = items[rng.integers(0, 8)][1].split()
        drop = rng.integers(0, max(1, len(passage) // 3))
        part = passage[drop:] if k % 2 else passage[: len(passage) - drop]
        around = [list(rng.choice(vocabulary, rng.integers(0, 400))) for _ in range(2)]
        docs.append((10 + k, "\n".join([*around[0], *part, *around[1]])))
    spark = ready(spark)
    frame = spark.createDataFrame([(*d, 1, 2) for d in docs + docs[:6]], "doc_id long, text string, item int, hash int")
    table = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, doc_id int")
    got = D.find(frame, "doc_id", "text", table, "item_id", "text")
    assert sorted(map(tuple, got.collect())) == expected(docs, items)
    assert D.find(frame.limit(0), "doc_id", "text", table, "item_id", "text").count() == 0
    assert D.find(frame, "doc_id", "text", table.limit(0), "item_id", "text").count() == 0


def test_sketches_are_long_enough():
    for n in range(1, 2000):
        assert min(n, n - D.needed(n, 0.8) + 1) <= D.sketch_length(n, 0.8) <= n
