import zlib

import numpy as np
import pytest
import public_tokenizers
from hypothesis import given, settings, strategies as st
from pyarrow import fs
from tokenizers import Tokenizer

from loanmart.llm import elias_fano, token_files
from loanmart.llm.queries import QUERIES
from loanmart.llm.shared import ready

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", "   ", "Hello, World. it's they'll.", "a<|endoftext|>b. <|startoftext|>,", "é café x y", "\x1c\x1d a\x85b",
    "12,345.67 ...,,. ,a .b c.,", "İSTANBUL ΣΑΣ ß ﬁ", "日本語 テスト。", "\U0001F600" * 5, "x" * 5000, "word " * 50_000,
]


def plain(texts):
    """``(start, n_tokens, crc)`` of each text, straight from the library."""
    tokenizer, at, out = Tokenizer.from_file(PATH), 0, []
    for t in texts:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        out.append((at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_query_equals_the_library(spark, small):
    got = sorted(map(tuple, QUERIES["op2_token_files"](spark, "/root/testdata/sf0.001").collect()))
    rows = sorted(small, key=lambda r: r["doc_id"])
    assert got == [(r["doc_id"], *x) for r, x in zip(rows, plain([r["text"] for r in rows]))]


def test_odd_texts(spark, table):
    got = sorted(map(tuple, QUERIES["op2_token_files"](spark, table(ODD)).collect()))
    assert got == [(i, *x) for i, x in enumerate(plain(ODD))]


@settings(max_examples=200, deadline=None)
@given(st.text(st.one_of(st.characters(), st.sampled_from(" .,'stlAé́\n<|>")), max_size=30))
def test_words_give_the_ids_of_the_text(text):
    if any("\ud800" <= c <= "\udfff" for c in text):
        return
    known = token_files.word_ids(PATH)
    want = known.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(known.text(text.encode()), "<u2").tolist() == want


@given(st.lists(st.integers(0, 2**40)))
def test_elias_fano_round_trip(values):
    values = sorted(values)
    coded = elias_fano.encode(np.array(values, np.uint64))
    found = elias_fano.Sequence(coded)
    assert found.all().tolist() == values and [found.select(i) for i in range(len(values))] == values


def test_elias_fano_is_near_minimal():
    ends = np.cumsum(np.random.default_rng(0).integers(1, 2000, 100_000))
    assert len(elias_fano.encode(ends)) * 8 < len(ends) * (2 + np.log2(ends[-1] / len(ends)) + 1)


def test_repeated_null_and_negative_ids_and_single_documents(spark):
    ready(spark)
    rows = [(3, "b", 1, "x"), (3, "a", 1, "x"), (None, "n", 1, "x"), (-7, "c d", 1, "x"), (3, "a", 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id int, start string")
    folder = token_files.new_folder(spark)
    shards = token_files.write(docs, "doc_id", "text", folder, PATH, 2)
    got = token_files.read(spark, shards, folder).orderBy("start").collect()
    assert [r.id for r in got] == [None, -7, 3, 3, 3] and [r.n_tokens for r in got] == [2, 3, 2, 2, 2]
    assert all(r.ids[-1] == 2 and len(r.ids) == r.n_tokens for r in got)
    store, _ = fs.FileSystem.from_uri(folder)
    one_by_one = []
    for s in shards.orderBy("shard").collect():
        shard = token_files.Shard(store, s.path)
        one_by_one += [(shard.doc_id(i), shard.ids(i).tolist()) for i in range(shard.n)]
    assert one_by_one == [(r.id, list(r.ids)) for r in got]


def test_empty_table(spark, table):
    assert QUERIES["op2_token_files"](spark, table([])).count() == 0


def test_other_files_are_refused(tmp_path):
    (tmp_path / "x").write_bytes(b"0" * 200)
    with pytest.raises(ValueError):
        token_files.Shard(fs.LocalFileSystem(), str(tmp_path / "x"))
