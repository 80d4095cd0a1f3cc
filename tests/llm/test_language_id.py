import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from loanmart.llm import language_id as L
from loanmart.llm.queries import QUERIES
from loanmart.llm.shared import ready


def test_held_out_accuracy(spark, small):
    got = {r.doc_id: r for r in QUERIES["op3_language_id"](spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(small) and all(0 <= r.score <= 1 for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    held = [r for r in small if got[r["doc_id"]].held_out and any(c.isalpha() for c in r["text"])]
    right = sum(got[r["doc_id"]].lang_pred == r["lang"] for r in held)
    assert len(held) > 20 and right / len(held) > 0.95


def kneser_ney(texts, order=L.ORDER):
    """A plain interpolated Kneser-Ney model of one language: a function of context and character."""
    counts = [None, *(Counter() for _ in range(order))]
    for t in texts:
        codes, _ = L.characters([t])
        codes = [0] * (order - 1) + codes.tolist()
        for i in range(order, len(codes)):
            counts[order][tuple(codes[i - order + 1 : i + 1])] += 1
    for k in range(order - 1, 0, -1):
        for gram in counts[k + 1]:
            counts[k][gram[1:]] += 1
    stats = [None]
    for k in range(1, order + 1):
        n1, n2 = (sum(v == x for v in counts[k].values()) for x in (1, 2))
        d = min(0.95, max(0.1, n1 / max(n1 + 2 * n2, 1)))
        total, kinds = defaultdict(int), defaultdict(int)
        for g, v in counts[k].items():
            total[g[:-1]] += v
            kinds[g[:-1]] += 1
        stats.append((d, total, kinds))

    def p(gram):
        if not gram:
            return 1 / L._UNSEEN
        d, total, kinds = stats[len(gram)]
        t = total.get(gram[:-1], 0)
        if not t:
            return p(gram[1:])
        return max(counts[len(gram)].get(gram, 0) - d, 0) / t + d * kinds[gram[:-1]] / t * p(gram[1:])

    return p


def test_probabilities_equal_a_plain_model(spark):
    ready(spark)
    texts = {"a": ["the cat sat on the mat", "that hat", "é the"], "b": ["el gato en la mesa", "la casa", "el mes"]}
    rows = [(t, lang) for lang, own in texts.items() for t in own]
    model = L.fit(spark.createDataFrame(rows, "text string, lang string"), "text", "lang")
    assert model.languages == ["a", "b"]
    for text in ["the cat", "la masa", "zzz qqq", "é", "x the hat?!", "thé  été"]:
        bits, n = model.cross_entropies([text, "other", text])
        codes = [0] * (L.ORDER - 1) + L.characters([text])[0].tolist()
        for i, lang in enumerate("ab"):
            p = kneser_ney(texts[lang])
            want = -sum(math.log2(p(tuple(codes[j - L.ORDER + 1 : j + 1]))) for j in range(L.ORDER, len(codes)))
            assert bits[0, i] == pytest.approx(want / (len(codes) - L.ORDER), rel=1e-4) and bits[0, i] == bits[2, i]


def test_counts_beyond_memory_change_nothing(spark, monkeypatch):
    """No gram is left out when the counts stay tables and tasks hold only a few of them."""
    ready(spark)
    texts = {"a": ["the cat sat on the mat", "that hat", "é the"], "b": ["el gato en la mesa", "la casa", "el mes"]}
    rows = [(t, lang) for lang, own in texts.items() for t in own]
    asked = ["the cat", "la masa", "zzz qqq", "é", "x the hat?!", "thé  été", "la masa", "", None, "日本"]
    labelled = spark.createDataFrame(rows, "text string, lang string")
    docs = spark.createDataFrame(list(enumerate(asked)), "id int, text string")
    got = {}
    for most in (1_000_000, 12):
        monkeypatch.setattr(L, "MAX_GRAMS", most)
        model = L.fit(labelled, "text", "lang")
        assert isinstance(model, L.Model if most > 12 else L.Tables) and model.languages == ["a", "b"]
        found = {r.id: r for r in L.entropies(docs, model, "text", ["id"]).collect()}
        assert len(found) == len(asked)
        got[most] = [(list(found[i]["_bits"]), found[i]["_n"]) for i in range(len(asked))]
    for (bits, n), (other, n_other), text in zip(*got.values(), asked):
        assert n == n_other and bits == pytest.approx(other, rel=1e-5)
        codes = [0] * (L.ORDER - 1) + L.characters([text or ""])[0].tolist()
        for i, lang in enumerate("ab"):
            p = kneser_ney(texts[lang])
            want = -sum(math.log2(p(tuple(codes[j - L.ORDER + 1 : j + 1]))) for j in range(L.ORDER, len(codes)))
            assert other[i] == pytest.approx(want / max(len(codes) - L.ORDER, 1), rel=1e-4, abs=1e-9)


def calibration_row(i):
    return zlib.crc32(str(i).encode()) % 16 == 3


def test_limits_of_languages_with_few_calibration_texts(spark):
    """One calibration text, copies of one text, or none give no limit that drops clean texts, and none that drops nothing."""
    ready(spark)
    words = {"en": "the cat and dog sat on a mat in that house", "fi": "kaksi kolme neljä viisi kuusi talo metsä", "es": "el gato negro come pan con queso", "pl": "dzień dobry jabłko drzewo ulica"}
    rng = np.random.default_rng(5)
    text = lambda lang: " ".join(rng.choice(words[lang].split(), rng.integers(20, 60)))
    rows = [(i, text("en"), "en") for i in range(800)]
    own = {"fi": range(1000, 1200), "es": range(2000, 2200), "pl": range(3000, 3200)}
    copies = text("es")
    for i in own["fi"]:  # a single calibration text
        rows += [(i, text("fi"), "fi")] if not calibration_row(i) or i == next(filter(calibration_row, own["fi"])) else []
    rows += [(i, copies if calibration_row(i) else text("es"), "es") for i in own["es"]]
    rows += [(i, text("pl"), "pl") for i in own["pl"] if not calibration_row(i)]  # no calibration text
    noise = ["".join(rng.choice(list("ąćęłńóśźżwqxjk "), 200)) for _ in range(5)]
    rows += [(9000 + i, t, None) for i, t in enumerate(noise)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model, fitted = L.train(frame, "doc_id", "text", "lang")
    assert model.languages == ["en", "es", "fi", "pl"]
    assert all(np.isfinite(fitted.mean)) and min(fitted.spread) > 0 and min(fitted.noise) > 0
    got = L.verdicts(frame, "text", model, fitted, ["doc_id", "lang"]).collect()
    assert [r for r in got if r.lang and (r.rejected or r.lang_pred != r.lang)] == []
    assert all(r.rejected for r in got if r.lang is None)
    assert {r.doc_id for r in L.keep_known(frame, "doc_id", "text", "lang").collect()} == {r[0] for r in rows if r[2]}


def test_odd_rows(spark):
    ready(spark)
    schema = "doc_id long, text string, lang string, n long, key string, bits int"
    words = {"x": "lorem ipsum dolor sit amet ", "y": "kaksi kolme neljä viisi kuusi "}
    rows = [(i, words["xy"[i % 2]] * (1 + i % 3), "xy"[i % 2], 1, "k", 2) for i in range(120)]
    rows += [(i, t, None, 1, "k", 2) for i, t in enumerate([None, "", "12 !?", "\n", "日本語" * 500], 500)]
    rows += [(None, "lorem ipsum", "x", 1, "k", 2), (7, "kaksi", "y", 1, "k", 2), (7, "kaksi", "y", 1, "k", 2), (900, "lorem " * 20_000, "x", 1, "k", 2)]
    got = L.predict(spark.createDataFrame(rows, schema), "doc_id", "text", "lang").collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 and by[i].rejected for i in range(500, 504))
    assert by[504].rejected and by[None].lang_pred == "x" and by[900].lang_pred == "x"
    assert all(by[i].lang_pred == "xy"[i % 2] and not by[i].rejected for i in range(120))
    assert L.predict(spark.createDataFrame([], schema), "doc_id", "text", "lang").count() == 0
    nobody = spark.createDataFrame([(1, "abc", None, 1, "k", 2)], schema)
    assert [r.lang_pred for r in L.predict(nobody, "doc_id", "text", "lang").collect()] == ["und"]


def test_hash_array_finds_what_it_holds():
    keys = np.unique(np.random.default_rng(0).integers(0, 2**63, 5000, dtype=np.uint64))
    array = L.HashArray(keys[::2])
    place = array.find(keys)
    assert (place[1::2] == -1).all() and (keys[::2][array.order[place[::2]]] == keys[::2]).all()
