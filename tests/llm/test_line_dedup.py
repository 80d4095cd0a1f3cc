import pytest

from loanmart.llm import line_dedup as L
from loanmart.llm.queries import ORACLES, QUERIES
from loanmart.llm.shared import ready
from tests.llm.brute import words
from tools.check_queries import compare, duck

SCHEMA = "doc_id long, text string, source string, n_lines string, line int, site int"


def expected(rows, least, copies_once=False):
    sites, texts = {}, {}
    split = [(r[1] or "").split("\n") for r in rows]
    for r in rows:
        if r[2] is not None:
            texts[r[1] or ""] = min(r[2], texts.get(r[1] or "", r[2]))
    for r, lines in zip(rows, split):
        for l in lines:
            if words(l) and r[2] is not None:
                sites.setdefault(l, set()).add(texts[r[1] or ""] if copies_once else r[2])
    gone = {l for l, s in sites.items() if len(s) >= least}
    return sorted(
        ((r[0], None if r[1] is None else "\n".join(l for l in lines if l not in gone), sum(l in gone for l in lines)) for r, lines in zip(rows, split)),
        key=str,
    )


def found(spark, rows, least, **how):
    frame = ready(spark).createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    got = L.remove_boilerplate(frame, "doc_id", "text", "source", least, **how)
    assert set(got.columns) == {*frame.columns, "n_removed"}
    return sorted(map(tuple, got.select("doc_id", "text", "n_removed").collect()), key=str)


def test_same_rows_as_sql(spark):
    name, folder = "op4_line_dedup", "/root/testdata/sf0.001"
    assert compare(QUERIES[name](spark, folder), duck(folder), ORACLES[name]) == ""


@pytest.mark.parametrize("registers", [11, 4])
def test_threshold_copies_and_odd_rows(spark, monkeypatch, registers):
    """With few registers nearly every count is near the threshold and is made exact."""
    monkeypatch.setattr(L, "LOG_REGISTERS", registers)
    rows = [(i, f"top {i}\nfooter\n\nend {i}", f"s{i}") for i in range(9)]
    rows += [(20 + i, f"a{i}\nat threshold\nb{i}", f"s{i}") for i in range(5)]
    rows += [(30 + i, f"a{i}\nbelow\nb{i}", f"s{i}") for i in range(4)]
    rows += [(40 + i, "copied text\nsecond\nthird", f"s{i}") for i in range(9)]  # one text on many sites
    rows += [(60, None, "s1"), (61, "", "s1"), (62, "\n \n", None), (63, "footer", None), (63, "footer", None), (None, "footer\nx", "s1")]
    rows += [(70 + i, f"c{i}\nsame site\nd{i}", "s1") for i in range(9)]
    rows += [(80 + i, f"d{i}\nabout us\nterms\nprivacy", f"s{i}") for i in range(6)]  # an unchanged block on every site
    rows += [(90, "long\n" * 300_000 + "footer", "s1")]
    for once, copied in ((False, ""), (True, "copied text\nsecond\nthird")):
        want = expected(rows, 5, once)
        assert found(spark, rows, 5, copies_once=once) == want
        texts = dict((i, t) for i, t, _ in want)
        assert "footer" not in texts[0] and "threshold" not in texts[20] and "below" in texts[30]
        assert texts[40] == copied and texts[80] == "d0"


def test_empty_table(spark):
    assert found(spark, [], 5) == []
