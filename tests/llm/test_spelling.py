import re
import zlib
from collections import Counter

import numpy as np
import pytest

from loanmart.llm import spelling as S
from loanmart.llm.queries import QUERIES
from loanmart.llm.shared import ready
from tests.llm.brute import lowered

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def vocabulary(rows, slip=199, shortest=6, least=5):
    n = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= shortest and c >= least}


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(vocab, factor=5):
    """All pairs that share a deletion, tried one by one."""
    shared = {}
    for w in vocab:
        for part in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            shared.setdefault(part, set()).add(w)
    near = {w: set() for w in vocab}
    for group in shared.values():
        for a in group:
            near[a] |= {b for b in group if one_apart(a, b)}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-vocab[x], x), default=None)
        form[w] = best if best and vocab[best] >= factor * vocab[w] else None
    out = []
    for w in vocab:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, vocab[w], len(near[w]), vocab[form[w]] if form[w] else None))
    return sorted(out)


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def rows_of(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_equals_brute_force(spark, sf):
    folder = f"/root/testdata/sf{sf}"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    want = expected(vocabulary(docs))
    assert rows_of(QUERIES["op11_spelling_variants"](spark, folder)) == want
    assert sf == "0.001" or any(r[1] for r in want) and any(r[4] > 1 for r in want)


@pytest.mark.parametrize("symbols, crowd, cells", [(8, 256, 1 << 20), (1, 2, 1 << 20), (2, 3, 1), (3, 10**9, 1 << 20)])
def test_few_symbols_and_crowded_forms_lose_no_pair(spark, monkeypatch, symbols, crowd, cells):
    monkeypatch.setattr(S, "CELLS", cells)
    draw = np.random.default_rng(symbols)
    words = {"".join(draw.choice(list("abé"), draw.integers(3, 7))) for _ in range(300)} | {"x" * 5000, "x" * 4999 + "y", "x" * 5001}
    vocab = {w: int(5 ** draw.integers(1, 5)) for w in sorted(words)}
    frame = ready(spark).createDataFrame(list(vocab.items()), "word string, n long")
    assert rows_of(S.group(frame, symbols=symbols, crowd=crowd)) == expected(vocab)


def test_long_chain_of_forms(spark):
    chain = ["aaaaaaaa"[:i] + "bbbbbbbb"[i:] for i in range(9)]
    vocab = {w: 5 ** (i + 1) for i, w in enumerate(chain)}
    got = rows_of(S.group(ready(spark).createDataFrame(list(vocab.items()), "word string, n long")))
    assert got == expected(vocab) and {r[2] for r in got} == {chain[-1]}


def test_odd_texts(spark, table, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_BYTES", 64)
    texts = [None, "", "\n \n", "Straßenbahn STRASSE ÀÉÎõü÷× naïvely Ångström" * 5, "école Ābcdefgh", "q" * 3_000, "zebras " * 400, "zebraÃ " * 30]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "zebras without an id") for _ in range(6)] + [(7, "zebrar, zebrar") for _ in range(3)]
    rows += [(20 + i, "q" * 3_000 + " " + "q" * 69_999) for i in range(6)]
    folder = table([(i, t, "en", "s", 1) for i, t in rows])
    assert rows_of(QUERIES["op11_spelling_variants"](spark, folder)) == expected(vocabulary(rows))


def test_slips_leave_out_one_letter(spark):
    rows = [(i, f"word{chr(97 + i % 26)}alpha betagamma " * 3) for i in range(200)]
    frame = ready(spark).createDataFrame([(*r, 1) for r in rows], "id long, body string, word int")
    got = S.vocabulary(frame, "id", "body", slip=3)
    assert {r.word: r.n for r in got.collect()} == vocabulary(rows, slip=3)


def test_empty_table(spark, table):
    assert QUERIES["op11_spelling_variants"](spark, table([])).collect() == []
