import numpy as np
import pytest

from loanmart.llm import sorted_runs, substring_dedup as S
from loanmart.llm.queries import QUERIES
from loanmart.llm.shared import ready
from tests.llm.brute import sha, words


def expected(ids, texts, length):
    order = sorted(range(len(ids)), key=lambda i: ids[i])
    seen, out = set(), []
    for i in order:
        w = words(texts[i])
        gone = set()
        for s in range(len(w) - length + 1):
            window = tuple(w[s : s + length])
            if window in seen:
                gone.update(range(s, s + length))
            seen.add(window)
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((ids[i], len(w), len(gone), sha(kept.encode())))
    return out


def found(frame, length):
    got = S.digest(S.remove_repeats(frame, "doc_id", "text", length))
    return sorted(tuple(r) for r in got.select("doc_id", "n_words", "n_removed", "kept_sha256").collect())


def test_query_equals_brute_force(spark, small):
    got = QUERIES["op10_substring_dedup"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, got)) == expected([r["doc_id"] for r in small], [r["text"] for r in small], 20)


@pytest.mark.parametrize("seed", [0, 1])
def test_planted_repeats(spark, monkeypatch, seed):
    monkeypatch.setattr(sorted_runs, "ROWS_PER_BUCKET", 50)
    monkeypatch.setattr(S, "PIECE", 400)
    rng = np.random.default_rng(seed)
    vocabulary = np.array(["a", "b", "c", "dé", "e,", "F", "f"])
    base = [rng.choice(vocabulary, 120) for _ in range(5)]
    texts = [None, "", " \n", "a " * 300, "a " * 19, "a b " * 40, "a b " * 40]
    for _ in range(60):
        parts = []
        for _ in range(rng.integers(1, 5)):
            source, a = base[rng.integers(0, 5)], rng.integers(0, 90)
            parts += [*source[a : a + rng.integers(10, 50)], *rng.choice(vocabulary, rng.integers(0, 8))]
        texts.append(" ".join(parts) + "\n\t")
    texts.append(" ".join(rng.choice(vocabulary, 1500)))
    ready(spark)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert found(frame, 20) == expected(range(len(texts)), texts, 20)


def test_repeated_rows_and_clashing_columns(spark):
    ready(spark)
    text = " ".join(f"w{i}" for i in range(50))
    schema = "doc_id long, text string, tag string, doc int, first int, id string, runs int"
    rows = [(2, text, "x", 1, 1, "i", 1)] * 2 + [(1, text[: len(text) // 2], "x", 1, 1, "i", 1)]
    want = expected([1, 2], [rows[2][1], text], 20)
    assert found(spark.createDataFrame(rows, schema), 20) == [*want, want[1]]
    assert found(spark.createDataFrame([], schema), 20) == []


def test_settled_symbols_do_not_depend_on_what_surrounds_them():
    rng = np.random.default_rng(5)
    inner = rng.integers(0, 4, 40).astype(np.uint64)
    found = []
    for _ in range(30):
        around = [rng.integers(0, 4, rng.integers(0, 9)).astype(np.uint64) for _ in range(2)]
        hashes = np.concatenate([around[0], inner, around[1]])
        at = len(around[0])
        for level in S.rounds(hashes, np.zeros(len(hashes), np.int64))[1:]:
            ok = (level.need_left >= at) & (level.need_right <= at + 40)
            found.append(tuple(zip(level.left[ok] - at, level.right[ok] - at, level.names[ok])))
    assert len(set(found[0::2])) == 1 and len(set(found[1::2])) == 1 and len(found[1]) > 3
