import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from loanmart.llm import sentence_pieces
from loanmart.llm.shared import documents
from tests.llm.brute import fingerprint, smallest_reachable
from tests.llm.test_decontamination import expected as leaks
from tests.llm.test_line_dedup import expected as cleaned
from tests.llm.test_sentence_pieces import PATH, crc, unpacked

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows after each stage, every stage on what the one before it wrote."""
    docs, out = documents(spark, FOLDER), []
    for name, stage in P.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append([r.asDict() for r in docs.collect()])
    return out


def by_id(rows):
    return sorted(rows, key=lambda r: r["doc_id"])


def test_stages_in_order_and_their_columns(stages):
    assert [n for n, _ in P.STAGES] == ["language_id", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "sentence_pieces"]
    assert all(list(rows[0]) == COLUMNS for rows in stages[:-1])


def test_language_keeps_clean_documents(stages, small):
    kept = {r["doc_id"] for r in stages[0]}
    assert all(r in small for r in stages[0]) and len(kept) > 0.95 * len(small)


def test_lines(stages):
    want = cleaned([(r["doc_id"], r["text"], r["source"]) for r in stages[0]], 12, copies_once=True)
    assert sorted(((r["doc_id"], r["text"]) for r in stages[1]), key=str) == sorted(((i, t) for i, t, _ in want), key=str)
    assert all(r["n_chars"] == len(r["text"]) for r in stages[1])


def test_one_document_of_each_group(stages):
    rows = by_id(stages[1])
    prints = [fingerprint(r["text"]) for r in rows]
    roots = smallest_reachable([r["doc_id"] for r in rows], lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    assert by_id(stages[2]) == [r for r in rows if r["doc_id"] in set(roots)]


def test_no_benchmark_passage_is_left(stages, spark):
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    gone = {d for d, *_ in leaks([(r["doc_id"], r["text"]) for r in stages[2]], items)}
    assert gone and by_id(stages[3]) == [r for r in by_id(stages[2]) if r["doc_id"] not in gone]


def test_pieces(stages):
    model = sentence_pieces.pieces(PATH)
    for r, d in zip(by_id(stages[4]), by_id(stages[3]), strict=True):
        ids = unpacked(model.encode(d["text"]))
        assert list(r["ids"]) == ids and r["ids_crc32"] == crc(ids) and r["n_tokens"] == len(ids)
        assert (r["n_chars"], r["text_md5"]) == (len(d["text"]), hashlib.md5(d["text"].encode()).hexdigest())


def test_run_equals_the_stages(spark, stages):
    got = P.run(spark, FOLDER)
    assert by_id(r.asDict() for r in got.collect()) == by_id(stages[4])


def test_odd_rows_and_extra_columns_pass_every_stage(spark, table):
    text = "the cat sat on the mat and looked at the moon over the hill tonight " * 3
    schema = "doc_id long, text string, lang string, source string, n_chars long, tag string, id int, ids int"
    rows = [(1, text, "en", "s", 5, "t", 1, 2), (1, text, "en", "s", 5, "t", 1, 2), (2, text + "x", None, None, None, None, None, None)]
    rows += [(None, text.replace("cat", "dog") * 2, "en", "s", 5, "t", 1, 2), (3, None, "en", "s", 5, "t", 1, 2), (4, "", "en", "s", 5, "t", 1, 2)]
    folder = table([])
    spark.createDataFrame([(0, "a passage that is nowhere to be found at all")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.createDataFrame(rows, schema)
    for empty in (False, True):
        frame = docs.where(F.lit(not empty))
        for _, stage in P.STAGES[:-1]:
            frame = stage(spark, frame, folder)
            assert frame.columns == docs.columns
        assert (P.to_pieces(spark, frame, folder).count() == 0) == empty
