from collections import Counter

import pytest
from pyspark.sql import functions as F

from loanmart.llm import quality_rules as Q
from loanmart.llm.queries import ORACLES, QUERIES
from loanmart.llm.shared import ready
from tests.llm.brute import words
from tools.check_queries import compare, duck

ODD = [
    None, "", " \t\n\x0b", "one", "a b c d e " * 4, "a b c d e f g h i j", "x\n\nx\n x\n", "#*$%&|<> " * 12, "é " * 12,
    "1234 567 " * 12, "w" * 300 + " a b c d e f g h i j k", "a b c d e f g h i a b c d e f", "    a", "z " * 30_000,
]


def expected(text):
    w = words(text)
    seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for k in range(5)}
    lines = [l for l in (text or "").split("\n") if words(l)]
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return (
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), failed,
    )


def test_same_rows_as_sql(spark):
    name, folder = "op1_quality_rules", "/root/testdata/sf0.001"
    assert compare(QUERIES[name](spark, folder), duck(folder), ORACLES[name]) == ""


def test_odd_texts(spark, table):
    folder = table(ODD)
    got = {r.doc_id: tuple(r)[1:-1] for r in QUERIES["op1_quality_rules"](spark, folder).collect()}
    assert got == {i: expected(t) for i, t in enumerate(ODD)}


def test_order_changes_the_reason_but_not_the_verdict(spark, table):
    docs = Q.with_measures(spark.read.parquet(table(ODD) + "/documents.parquet"), "text")
    rules = Q.standard_rules("text")
    verdicts = []
    for chosen in (rules, rules[::-1], Q.order(docs, rules)):
        assert {r.name for r in chosen} == {r.name for r in rules}
        rows = Q.cascade(docs, chosen).select("doc_id", F.col("rejected_by").isNull()).collect()
        verdicts.append(sorted(map(tuple, rows)))
    assert verdicts[0] == verdicts[1] == verdicts[2]


def test_rules_that_reject_more_for_less_go_first(spark, monkeypatch):
    ready(spark)
    docs = spark.range(2000).withColumn("text", F.repeat(F.lit("ab cd "), 3000))
    dear = F.size(F.regexp_extract_all("text", F.lit("a(b) (c)d"), F.lit(1)))
    rules = [
        Q.Rule("dear_never", dear < 0), Q.Rule("dear_half", (dear > 0) & (F.col("id") % 2 == 0)), Q.Rule("cheap_most", F.col("id") % 10 > 0),
    ]
    assert [r.name for r in Q.order(docs, rules, rows=2000)][0] == "cheap_most"


def test_only_sampled_rows_are_measured_to_order_rules(spark, monkeypatch):
    ready(spark)
    plans, written = [], Q.written

    def spy(frame):
        plans.append(frame._jdf.queryExecution().optimizedPlan().toString().splitlines())
        return written(frame)

    monkeypatch.setattr(Q, "written", spy)
    docs = spark.range(3000).withColumn("text", F.concat_ws(" ", F.lit("abc def ghi jkl mno pqr stu vwx yza bcd efg"), "id"))
    assert Q.judge(docs, "text").where("kept AND n_words = 12").count() == 3000
    (plan,) = plans
    (sampled,) = [i for i, line in enumerate(plan) if "Sample " in line]
    measured = [i for i, line in enumerate(plan) if "regexp_extract_all" in line]
    assert measured and max(measured) < sampled  # a plan lists what runs first last


@pytest.mark.parametrize("rows", [[], [(1, "a", 5, "q"), (1, "a", 5, "q")]])
def test_empty_table_repeated_rows_and_clashing_columns(spark, rows):
    ready(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, kept string")
    assert [(r.doc_id, r.n_words, r.kept) for r in Q.judge(docs, "text").collect()] == [(1, 1, False)] * len(rows)


def test_no_python_in_the_plan(spark):
    plan = QUERIES["op1_quality_rules"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
