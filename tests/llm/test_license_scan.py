import re

from loanmart.llm import license_scan as L
from loanmart.llm.queries import QUERIES
from loanmart.llm.shared import ready

PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
MIT, APACHE, BSD = (next(t for l, t in L.NOTICES if l == n) for n in ("mit", "apache", "bsd"))
ODD = [
    None, "", "...", "MIT License", "cc", "by", "CC BY-NC cc-by cc by\nCC\tBY", "mit mit license license", "the MIT\n\nLicence",
    "é MIT licenseé mit LICENSE é", "x " * 40_000 + "GNU General Public License", MIT, "word " * 9 + BSD.upper() + " tail",
    APACHE.replace("compliance", "full compliance").replace("Version 2.0", "Version"), " ".join(MIT.split()[:9]),
    "Released under the MIT License. " * 3 + "gnu general public license",
]


def base(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    at = [(i, l) for p, l in PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    starts = [i for i, _ in at]
    return len(w), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({l for _, l in at}))


def test_base_of_the_query_equals_brute_force(spark, small):
    got = QUERIES["op7_license_scan"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(tuple(r)[:6] for r in got) == sorted((r["doc_id"], *base(r["text"])) for r in small)
    assert all(set(r.base_labels.split(",")) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got if r.base_labels)


def test_odd_texts_and_notices(spark, table):
    got = sorted(QUERIES["op7_license_scan"](spark, table(ODD)).collect())
    assert [tuple(r)[1:6] for r in got] == [base(t) for t in ODD]
    labels = [r.labels for r in got]
    assert labels[11] == "mit" and labels[12] == "bsd" and "apache" in labels[13] and labels[14] == "" and labels[0] == ""
    assert got[11].score == 1 and got[12].score == 1 and 0.6 <= got[13].score and got[0].score == 0


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    ready(spark)
    schema = "doc_id long, text string, tag string, n_words string, label int"
    rows = [(1, "MIT License", "x", "y", 0)] * 2 + [(1, "other", "x", "y", 0), (None, "cc by", "x", "y", 0)]
    got = L.scan(spark.createDataFrame(rows, schema), "doc_id", "text").collect()
    assert sorted((str(r.doc_id), r.n_base, r.labels) for r in got) == [("1", 0, ""), ("1", 1, "mit"), ("1", 1, "mit"), ("None", 1, "cc-by")]
    assert L.scan(spark.createDataFrame([], schema), "doc_id", "text").count() == 0
