import datetime as dt

import pytest
from pyspark.sql import functions as F

from loanmart.operators import cleaning, snapshots
from loanmart.sources import raw

ATTRIBUTES = '''Customer_ID,Name,Age,SSN,Occupation,snapshot_date
CUS_1,Matthewm,45,230-22-9583,Accountant,2023-01-01
CUS_2,"""""""Manuelap""",41_,#F%$D@*&8,_______,2023-01-01
CUS_3,"""x, y""",-500,761-27-5143,Lawyer,1/2/2023
CUS_4,Empty,,111-11-1111,Doctor,2023-02-01
,Nobody,33,111-11-1112,Doctor,2023-02-01
'''


@pytest.fixture
def attributes(spark, tmp_path):
    path = tmp_path / "features_attributes.csv"
    path.write_text(ATTRIBUTES)
    return raw.read_raw(spark, str(path))


def test_quotes_and_commas_survive(attributes, rows):
    assert rows(attributes, "name")[:2] == [('"""Manuelap"',), ('"x, y"',)]


def test_plain_cleaning_turns_unreadable_numbers_into_zero(attributes, rows):
    silver = cleaning.silver_attributes(attributes)
    assert rows(silver, "customer_id", "age") == [
        ("CUS_1", 45.0), ("CUS_2", 0.0), ("CUS_3", -500.0), ("CUS_4", 0.0),
    ]


def test_repair_mends_what_it_can(attributes, rows):
    silver = cleaning.silver_attributes(attributes, "repair")
    assert rows(silver, "customer_id", "age", "ssn", "occupation") == [
        ("CUS_1", 45.0, "230-22-9583", "Accountant"),
        ("CUS_2", 41.0, None, None),
        ("CUS_3", None, "761-27-5143", "Lawyer"),
        ("CUS_4", None, "111-11-1111", "Doctor"),
    ]


def test_header_names_may_differ_in_case_and_unknown_columns_become_numbers(spark, tmp_path, rows):
    path = tmp_path / "f.csv"
    path.write_text("Customer_ID,Annual_Income,Credit_Mix,Extra,snapshot_date\nC1,10_,Good,7,2023-01-01\n")
    frame = raw.read_raw(spark, str(path))
    assert rows(cleaning.silver_financials(frame)) == [("C1", 0.0, 0.0, 7.0, dt.date(2023, 1, 1))]
    assert rows(cleaning.silver_financials(frame, "repair")) == [
        ("C1", 10.0, "Good", 7.0, dt.date(2023, 1, 1))
    ]


def test_header_only_month_keeps_its_types(spark, tmp_path):
    path = tmp_path / "empty.csv"
    path.write_text("fe_1,fe_2,Customer_ID,snapshot_date\n")
    silver = cleaning.silver_clickstream(raw.read_raw(spark, str(path)))
    assert silver.count() == 0
    assert dict(silver.dtypes) == {
        "fe_1": "double", "fe_2": "double", "customer_id": "string", "snapshot_date": "date",
    }


def test_explicit_schema_round_trip(spark, tmp_path, rows):
    df = spark.createDataFrame([("a", 0.1), ("b,c", None), ('d"e', 1e-12)], "k string, v double")
    raw.write_csv(df, str(tmp_path / "out"))
    assert rows(raw.read_raw(spark, str(tmp_path / "out"), df.schema)) == rows(df)


def test_absent_source_is_none_but_other_faults_are_raised(spark, tmp_path):
    assert raw.read_raw_optional(spark, str(tmp_path / "nothing.csv")) is None


def test_silver_loans_rules(spark, rows):
    day = "2023-05-01"
    frame = spark.createDataFrame(
        [
            ("L1", "C1", day, "12", "3", "1000", "100", "0", "250", "900", day),
            (None, "C1", day, "12", "3", "1000", "100", "0", "250", "900", day),
            ("L2", None, day, "12", "3", "1000", "100", "0", "250", "900", day),
            ("L3", "C1", day, "12", "3", "0", "100", "0", "250", "900", day),
            ("L4", "C1", day, "12.0", "0", "1e3", "0", "0", "5", "900", day),
        ],
        ", ".join(f"{c} string" for c in cleaning.LOAN_TYPES),
    )
    silver = cleaning.silver_loans(frame)
    assert rows(silver, "loan_id", "mob", "tenure", "installments_missed", "dpd") == [
        ("L1", 3, 12, 3, 89), ("L4", 0, 12, 0, None),
    ]
    flat = cleaning.silver_loans_flat(frame)
    assert flat.count() == 5 and {r.dpd for r in flat.collect()} == {30}


def test_drop_and_first_present(spark):
    df = spark.createDataFrame([(1, 2)], "DPD int, snapshot_date int")
    assert cleaning.drop_system_columns(df).columns == ["DPD"]
    assert cleaning.first_present(df, ("dpd", "DPD")) == "DPD"
    assert cleaning.first_present(df, ("dpd",)) is None


def test_nan_and_null_are_filled(spark, rows):
    df = spark.createDataFrame([("a", float("nan"), None), ("b", 1.0, 2)], "k string, x double, n int")
    assert rows(cleaning.fill_numeric(df)) == [("a", 0.0, 0), ("b", 1.0, 2)]


def test_months(spark, rows):
    days = [dt.date(2023, 1, 1), dt.date(2023, 4, 1)]
    df = spark.createDataFrame([(d,) for d in days], "snapshot_date date")
    months = snapshots.calendar(df)
    assert months.count() == 4
    missing = rows(snapshots.missing_months(months, df))
    assert missing == [(dt.date(2023, 2, 1),), (dt.date(2023, 3, 1),)]
    tagged = snapshots.listed_months(df, ["2023-01-01", "2023-02-01"])
    assert rows(tagged, "data_month") == [("Jan 2023",)]


def test_lineage_columns(spark):
    df = spark.createDataFrame([(dt.date(2023, 1, 1),)], "snapshot_date date")
    row = snapshots.with_lineage(df, "bronze").select(F.col("bronze_processing_date")).first()
    assert row[0] == "2023-01-01"
