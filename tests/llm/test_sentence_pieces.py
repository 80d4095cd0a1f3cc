import hashlib
import zlib

import numpy as np
import pytest
import public_tokenizers
import sentencepiece
from hypothesis import given, settings, strategies as st

from loanmart.llm import sentence_pieces as S
from loanmart.llm.queries import QUERIES
from loanmart.llm.shared import ready

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "   a  b ", "\n", "a\n\nb \n c", "hello  world\n\tx y ", "日本語 テスト\U0001F600\x00\x7f", "ééé", "x" * 900,
    "ab" * 3000, "the cat " * 2000, "\U0001F600" * 700, " " * 500,
]


@pytest.fixture(scope="module")
def model():
    return S.pieces(PATH)


def unpacked(packed):
    return np.frombuffer(packed, "<u2").tolist()


def sequential(model, text):
    """One Viterbi pass over the whole text."""
    text = S.marked(text or "")
    return model.segment(text) if text else []


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_the_library_finds_the_same_segmentation(model):
    """The given file with its type set to unigram, so that the library looks for the largest sum too."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(open(PATH, "rb").read())
    proto.trainer_spec.model_type = 1
    for piece in proto.pieces:  # runs of spaces have -1e9, beside which the library's 32-bit sums lose the others
        piece.score = max(piece.score, -40_000.0)
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    for text in ["Hello world", "internationalization of the", "a b c", "Et treêaux leur été", "don't stop"]:
        assert unpacked(model.encode(text)) == library.encode(text)


def test_scores_that_are_not_whole(tmp_path):
    """Log probabilities that differ by less than 1 decide as they do in the library."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(open(PATH, "rb").read())
    proto.trainer_spec.model_type = 1
    rng = np.random.default_rng(3)
    for piece in proto.pieces:
        piece.score = float(rng.uniform(-4.5, -3.5)) * len(piece.piece) ** 0.9
    path = tmp_path / "unigram.model"
    path.write_bytes(proto.SerializeToString())
    library, own = sentencepiece.SentencePieceProcessor(model_file=str(path)), S.Pieces(str(path))
    for text in ["Hello world", "internationalization of the", "a b c", "don't stop", "segmentation of longer words differs"]:
        assert unpacked(own.encode(text)) == library.encode(text)
    assert S.scale([-1e9, -3.0, 0.0]) == 1 and S.scale([-3.27, -3.41]) == 1 << 20
    assert 1e9 * S.scale([-1e9, -3.27]) < 1 << 31


def test_query_equals_one_pass(spark, small, model, monkeypatch):
    monkeypatch.setattr(S.encode, "__defaults__", (2000,))  # most documents are then cut into chunks
    got = {r.doc_id: tuple(r) for r in QUERIES["op9_sentence_pieces"](spark, "/root/testdata/sf0.001").collect()}
    for r in small:
        ids = unpacked(model.encode(r["text"]))
        md5 = hashlib.md5(r["text"].encode()).hexdigest()
        assert got[r["doc_id"]] == (r["doc_id"], len(ids), crc(ids), len(r["text"]), md5)
    assert all(unpacked(model.encode(r["text"])) == sequential(model, r["text"]) for r in small[:12])


@pytest.mark.parametrize("chunk", [16, 23, 400])
def test_odd_texts_and_chunks(spark, model, chunk):
    ready(spark)
    rows = [(i, t, 1, "x", 2) for i, t in enumerate(ODD)] + [(9, ODD[9], 1, "x", 2), (None, ODD[5], 1, "x", 2), (5, "other " * 9, 1, "x", 2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, ids int, tag string, no int")
    coded = S.encode(frame, "doc_id", "text", PATH, chunk)
    got = sorted(((r.doc_id, list(r.ids)) for r in coded.collect()), key=str)
    assert got == sorted(((r[0], sequential(model, r[1])) for r in rows), key=str)
    back = S.decode(coded, "doc_id", "ids", PATH).collect()
    assert sorted(((r.doc_id, r.text) for r in back), key=str) == sorted(((r[0], r[1] or "") for r in rows), key=str)
    assert S.encode(frame.limit(0), "doc_id", "text", PATH, chunk).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(st.one_of(st.characters(blacklist_categories=["Cs"], blacklist_characters=[S.SPACE]), st.sampled_from(" \nthe an")), max_size=60))
def test_words_give_the_segmentation_of_the_text_and_decode_to_it(text):
    model = S.pieces(PATH)
    ids = unpacked(model.encode(text))
    assert ids == sequential(model, text) and model.decode(ids) == text


@pytest.mark.parametrize("text", ["transformationsandinternationalization" * 3 + "zzzqqq" * 20, "transformations and the " * 9])
def test_products_are_associative_and_end_in_the_best_score(model, text):
    text = S.marked(text)
    best = model.forward(text, [0], len(text))[0][-1]
    for size in (16, 31, 64):
        chunks = [S.Chunk(model, text[a : a + size + model.longest - 1], min(size, len(text) - a)) for a in range(0, len(text), size)]
        matrices = [c.matrix() for c in chunks]
        left = matrices[0]
        for m in matrices[1:]:
            left = S._times(left, m)
        # without inner boundaries nothing is left out of the sums
        assert left[0, 0] == best if not model.cuts(text) else left[0, 0] > best
        scanned = S.scan(matrices)
        assert (S._times(scanned[-1], matrices[-1])[0] == left[0]).all()
