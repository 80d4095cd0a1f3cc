from pyspark.sql import functions as F

from loanmart.operators import profile
from loanmart.plans import datamart
from loanmart.sources import tables

COLUMNS = "loan_id customer_id loan_start_date tenure installment_num loan_amt due_amt paid_amt overdue_amt balance snapshot_date"


def loans(spark, rows):
    base = dict(zip(COLUMNS.split(), ["L", "C", "2023-01-01", "10", "0", "100", "0", "0", "0", "100", "2023-01-01"]))
    text = ", ".join(f"{c} string" for c in base)
    return spark.createDataFrame([tuple((base | r).values()) for r in rows], text)


def test_first_reason_counts_and_rows_come_back_as_they_were(spark, tmp_path):
    raw = loans(spark, [
        {}, {"snapshot_date": "1/2/2023"}, {"snapshot_date": "soon", "loan_id": None}, {"snapshot_date": None}, {"snapshot_date": "2023-02-02", "loan_amt": "0"},
        {"loan_id": None, "loan_amt": "x"}, {"customer_id": None}, {"loan_amt": "0"}, {"loan_amt": "many"}, {"loan_amt": None},
    ]).withColumnRenamed("customer_id", "Customer_ID")
    layout = datamart.Layout(str(tmp_path))
    counts = datamart.bronze_with_rejects(spark, layout, "loans", raw)
    assert counts == {"raw": 10, "unreadable date": 2, "not the first of a month": 1, "no key": 2, "no amount": 3}
    rejects = tables.read_snapshots(spark, layout.table("rejects", "loans"), month="reason")
    assert {r.reason: r.n for r in rejects.groupBy("reason").agg(F.count("*").alias("n")).collect()} == {k: v for k, v in counts.items() if k != "raw"}
    assert rejects.where("snapshot_date = 'soon'").count() == 1 and rejects.where("loan_amt = 'many'").count() == 1
    held = tables.read_snapshots(spark, layout.table("bronze", "loans"))
    assert held.count() == 7  # keys and amounts are silver's rules
    assert datamart.silver("loans", held.drop(*datamart.LINEAGE)).count() == 2


def test_nothing_rejected_and_nothing_at_all(spark, tmp_path):
    for n in (2, 0):
        layout = datamart.Layout(str(tmp_path / str(n)))
        counts = datamart.bronze_with_rejects(spark, layout, "loans", loans(spark, [{}] * n) if n else loans(spark, [{}]).where("false"))
        assert counts["raw"] == n and sum(counts.values()) == n
        rejects = tables.read_snapshots(spark, layout.table("rejects", "loans"), month="reason")
        assert rejects.count() == 0 and "loan_id" in rejects.columns


def test_flat_rows_need_a_date_only(spark):
    raw = loans(spark, [{}, {"loan_id": None}, {"loan_amt": "0"}, {"snapshot_date": "2023-01-02"}])
    found = datamart.with_reason(raw, "loans", "flat")
    assert [r.reason for r in found.collect()] == [None, None, None, "not the first of a month"]


def test_wide_columns_are_reported_and_not_shuffled(spark):
    rows = [(i, str(i % 16), "abc"[i % 3], None, str(i % 15)) for i in range(5000)]
    df = spark.createDataFrame(rows, "id int, over string, few string, none string, just string")
    columns = ["id", "over", "few", "none", "just"]
    likely, many = profile.columns_with_few_values(df, columns, 15)
    assert many == ["id"] and set(likely) == {"over", "few", "none", "just"}
    got = {(r.column, r.value): (r.n, r.at_least) for r in profile.value_counts_reported(df, columns).collect()}
    assert {k: v for k, v in got.items() if v[1]} == {("id", None): (None, 16), ("over", None): (None, 16)}
    assert len([k for k in got if k[0] == "just"]) == 15 and got[("few", "a")] == (1667, None)
    assert profile.value_counts(df, ["id"]).count() == 0
