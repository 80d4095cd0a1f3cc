import datetime as dt

import pytest

from loanmart.operators import gold, vintage
from loanmart.plans import datamart

JAN, JUL = dt.date(2023, 1, 1), dt.date(2023, 7, 1)
LOANS = "loan_id string, customer_id string, loan_amt double, tenure int, mob int, due_amt double, overdue_amt double, dpd int, snapshot_date date"


@pytest.fixture
def loans(spark):
    return spark.createDataFrame(
        [
            ("L1", "C1", 100.0, 10, 0, 0.0, 0.0, 0, JAN),
            ("L1", "C1", 100.0, 10, 6, 10.0, 15.0, 61, JUL),
            ("L2", "C2", 200.0, 10, 0, 0.0, 0.0, 0, JAN),
            ("L2", "C2", 200.0, 10, 6, 10.0, 0.0, 0, JUL),
            ("L3", "C1", 300.0, 10, 0, 0.0, 5.0, None, JAN),
            ("L4", "C1", 400.0, 10, 6, 0.0, 5.0, None, JUL),
        ],
        LOANS,
    )


@pytest.fixture
def attributes(spark):
    return spark.createDataFrame([("C1", 30.0, JAN), ("C9", 50.0, JAN)], "customer_id string, age double, snapshot_date date")


def test_loans_without_features_stay(loans, attributes, rows):
    store = gold.feature_store(loans, None, attributes, None)
    assert rows(store, "loan_id", "age") == [("L1", 30.0), ("L2", None), ("L3", 30.0)]
    assert {(r.feature_version, r.feature_date) for r in store.collect()} == {("v1", JAN)}


def test_labels_at_one_month_on_book(loans, rows):
    labels = gold.label_store_at_mob(loans)
    assert rows(labels, "loan_id", "label", "label_def", "dpd") == [
        ("L1", 1, "30dpd_6mob", 61), ("L2", 0, "30dpd_6mob", 0), ("L4", 0, "30dpd_6mob", None),
    ]


def test_labels_by_customer_and_month(loans, rows):
    assert rows(gold.label_store_by_customer(loans)) == [
        ("C1", JAN, 0), ("C1", JUL, 1), ("C2", JAN, 0), ("C2", JUL, 0),
    ]


def test_shifted_pairing_keeps_one_feature_date(loans, attributes, rows):
    features = gold.feature_store(loans, None, attributes, None)
    paired = gold.training_set_shifted(features, gold.label_store_at_mob(loans))
    assert paired.columns.count("feature_date") == 1
    assert rows(paired, "loan_id", "feature_date", "label_date", "label") == [
        ("L1", JAN, JUL, 1), ("L2", JAN, JUL, 0),
    ]
    direct = gold.training_set_from_loans(loans, gold.label_store_at_mob(loans), None, attributes, None)
    order = sorted(paired.columns)
    assert rows(direct, *order) == rows(paired, *order)
    rate = gold.match_rate(features, gold.label_store_at_mob(loans)).first()
    assert (rate.n_features, rate.n_matched, rate.n_defaults) == (3, 2, 1)
    assert rate.default_rate_pct == 50.0


def test_match_rate_of_nothing_is_null(loans):
    nothing = loans.where("false")
    rate = gold.match_rate(nothing, gold.label_store_at_mob(nothing)).first()
    assert rate.n_features == 0 and rate.match_rate_pct is None


def test_same_month_pairing_replaces_the_label(loans, rows):
    states = gold.feature_store_by_state(loans, None, None, None)
    labels = gold.label_store_by_customer(loans)
    table = gold.attach_labels(states, labels.where("customer_id = 'C1'"))
    assert rows(table.where("customer_id = 'C2'"), "label") == [(0,), (0,)]
    paired = gold.training_set_same_month(table, labels)
    assert paired.columns.count("label") == 1 and paired.count() == 6
    assert {r.snapshot_tag for r in paired.collect()} == {"2023_01_01", "2023_07_01"}


def test_loan_states_are_distinct(loans):
    assert gold.distinct_loan_states(loans.unionByName(loans)).count() == 6


def test_bad_rates(loans, rows):
    twice = loans.unionByName(loans)
    assert rows(vintage.bad_rate_by_mob(twice)) == [(0, 3, 0, 0.0), (6, 3, 1, 1 / 3)]
    assert rows(vintage.bad_rate_by_mob_rows(twice)) == [(0, 6, 0, 0.0), (6, 6, 2, 1 / 3)]
    rates = vintage.bad_rate_by_mob(loans)
    assert vintage.growth(rates).first().relative_growth_pct is None
    assert vintage.largest_increase(rates).first().mob == 6
    assert vintage.stabilisation_point(rates).first()[0] is None
    assert vintage.null_delays(loans).first() == (6, 2)
    assert vintage.no_bad_loans(rates).first()[0] is False
    assert vintage.no_bad_loans(vintage.bad_rate_by_mob(loans, 1000)).first()[0] is True


def test_delay_column_by_any_spelling(loans):
    assert vintage.bad_rate_by_mob(loans.withColumnRenamed("dpd", "days_past_due")).count() == 2
    with pytest.raises(ValueError):
        vintage.bad_rate_by_mob(loans.drop("dpd"))


def test_gold_needs_loans():
    with pytest.raises(FileNotFoundError):
        datamart.gold_stores({"loans": None})
