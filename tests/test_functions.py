import datetime as dt
import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from loanmart.functions import dates, delinquency, numbers, text
from loanmart.operators import features
from loanmart.operators.bins import with_equal_width_bin


def one(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_dates_in_two_layouts(spark):
    parsed = one(spark, ["2023-01-05", "1/2/2023", "bad", None, ""], "string", dates.parse_date)
    assert parsed == [dt.date(2023, 1, 5), dt.date(2023, 2, 1), None, None, None]


def test_month_start_tag_and_back(spark):
    day = [dt.date(2023, 4, 17), None]
    assert one(spark, day, "date", dates.month_start) == [dt.date(2023, 4, 1), None]
    assert one(spark, day, "date", dates.month_tag) == ["2023_04_01", None]
    paths = ["gold/gold_feature_store_2023_04_01.parquet", "no date"]
    assert one(spark, paths, "string", dates.tag_to_date) == [dt.date(2023, 4, 1), None]


def test_dirty_text_becomes_null_not_an_error(spark):
    assert one(spark, ["41_", "41", "", None], "string", numbers.to_double) == [None, 41.0, None, None]
    assert one(spark, ["45.0", "45.9", "x"], "string", numbers.to_int) == [45, 45, None]


def test_infinities_become_null(spark):
    values = [math.inf, -math.inf, 1.5, None]
    assert one(spark, values, "double", numbers.finite_or_null) == [None, None, 1.5, None]


def test_repairs(spark):
    ages = one(spark, ["41_", "-500", "8100", "30", None], "string", text.repaired_age)
    assert ages == [41.0, None, None, 30.0, None]
    jobs = one(spark, ["_______", "Lawyer", ""], "string", text.repaired_label)
    assert jobs == [None, "Lawyer", None]
    numbers_ = one(spark, ["230-22-9583", "#F%$D@*&8", None], "string", text.ssn_is_valid)
    assert numbers_ == [True, False, None]


def test_bands_are_closed_on_the_right(spark):
    def age_group(v):
        return numbers.right_closed_band(v, features.AGE_EDGES, features.AGE_LABELS)

    ages = [0.0, 25.0, 26.0, 65.0, 100.0, 101.0, None]
    assert one(spark, ages, "double", age_group) == [None, "<25", "25-34", "55-64", "65+", None, None]
    dti = [0.0, 0.3, 0.31, 1.0, 5.0, None]
    assert one(spark, dti, "double", features.dti_band) == [
        None, "Excellent (5)", "Good (4)", "Poor (2)", "Critical (1)", None,
    ]


LOANS = [
    # overdue, due, snapshot, missed, first missed, days
    (10.0, 0.0, dt.date(2023, 5, 1), 0, None, None),
    (0.0, 0.0, dt.date(2023, 5, 1), 0, None, 0),
    (50.0, 100.0, dt.date(2023, 3, 1), 1, dt.date(2023, 2, 1), 28),
    (50.0, 100.0, dt.date(2024, 3, 1), 1, dt.date(2024, 2, 1), 29),
    (50.0, 100.0, dt.date(2023, 5, 1), 1, dt.date(2023, 4, 1), 30),
    (250.0, 100.0, dt.date(2023, 5, 1), 3, dt.date(2023, 2, 1), 89),
    (-50.0, 100.0, dt.date(2023, 5, 1), 0, None, 0),
    (None, 100.0, dt.date(2023, 5, 1), None, None, 0),
]


def test_days_past_due(spark):
    df = spark.createDataFrame(
        [(i, *row[:3]) for i, row in enumerate(LOANS)],
        "i int, overdue double, due double, snapshot date",
    )
    df = df.withColumn("m", delinquency.installments_missed(F.col("overdue"), F.col("due")))
    df = df.withColumn("f", delinquency.first_missed_date(F.col("snapshot"), F.col("m")))
    df = df.withColumn("d", delinquency.days_past_due(F.col("overdue"), F.col("snapshot"), F.col("f")))
    df = df.withColumn("bad", delinquency.is_bad(F.col("d")))
    got = [tuple(r) for r in df.orderBy("i").select("m", "f", "d", "bad").collect()]
    assert [g[:3] for g in got] == [row[3:] for row in LOANS]
    # one month missed is not 30 days in March; an unknown delay is not bad
    assert [g[3] for g in got] == [0, 0, 0, 0, 1, 1, 0, 0]


def test_unguarded_count_treats_a_failed_division_as_zero(spark):
    df = spark.createDataFrame([(10.0, 0.0), (10.0, -5.0), (15.0, 10.0)], "o double, d double")
    missed = delinquency.installments_missed_unguarded(F.col("o"), F.col("d"))
    assert [r[0] for r in df.select(missed).collect()] == [0, -2, 2]


@pytest.mark.parametrize("bins", [1, 10, 30, 50])
def test_bins_match_numpy(spark, bins):
    rng = np.random.default_rng(bins)
    for x in (
        rng.normal(size=500),
        rng.integers(0, 20, 500) / 10.0,
        np.linspace(0, 1, 11),
        np.full(20, 7.0),
    ):
        df = spark.createDataFrame([(float(v),) for v in x], "x double")
        lo, hi = F.lit(float(x.min())), F.lit(float(x.max()))
        binned = with_equal_width_bin(df, "x", lo, hi, bins)
        got = {r["bin"]: r["count"] for r in binned.groupBy("bin").count().collect()}
        assert [got.get(i, 0) for i in range(bins)] == np.histogram(x, bins)[0].tolist()


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(min_size=1, max_size=5), min_size=1, max_size=20))
def test_unit_hash_is_in_range_and_repeatable(spark, keys):
    first = one(spark, keys, "string", numbers.unit_hash)
    assert first == one(spark, keys, "string", numbers.unit_hash)
    assert all(0 <= u < 1 for u in first)


def test_fast_dates_equal_the_formatter(spark):
    texts = [
        "2023-01-05", "1/2/2023", "01/02/2023", "001/1/2023", "2023-1-5", " 2023-01-05", "2023-01-05\n", "2023-02-30", "31/4/2023",
        "0000-01-01", "1/1/0000", "0001-01-01", "+12023-01-01", "1/1/12023", "0/1/2023", "1/13/2023", "2023-01-05T00:00", "1/2/23", "bad", "", None,
    ]
    slow = one(spark, texts, "string", lambda c: F.coalesce(*[F.try_to_date(c, f) for f in dates.RAW_DATE_FORMATS]).cast("string"))
    assert one(spark, texts, "string", lambda c: dates.parse_date(c).cast("string")) == slow
    days = [dt.date(2023, 4, 17), None]
    assert one(spark, days, "date", dates.parse_date) == days
