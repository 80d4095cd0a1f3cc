"""Delinquency, feature and label stores, training sets."""

from __future__ import annotations

from loanmart.operators import cleaning, gold
from loanmart.session import cut_lineage, scratch_path
from loanmart.sources import bucketed
from workload import views
from workload.registry import query

FEATURES = (
    "loan_amt fe_1 fe_2 fe_3 fe_4 fe_5 age monthly_inhand_salary annual_income interest_rate "
    "num_of_loan outstanding_debt total_emi_per_month credit_utilization_ratio"
)
SIDE_COLUMNS = FEATURES.replace("loan_amt ", "").replace(" ", ", ") + ", name, ssn, occupation"


def flat_loans(spark, sf_dir):
    return cleaning.silver_loans_flat(views.loans(spark, sf_dir))


def kept_flat_loans(spark, sf_dir):
    """What states and labels are made of, written once as both are made of it."""
    return cut_lineage(flat_loans(spark, sf_dir).select(*gold.LOAN_STATE, "dpd"))


def features_typed(spark, sf_dir, loans=None):
    return gold.feature_store(
        loans or views.silver_loans(spark, sf_dir),
        views.silver_clickstream(spark, sf_dir),
        views.silver_attributes(spark, sf_dir),
        views.silver_financials(spark, sf_dir),
    )


def features_by_state(spark, sf_dir, loans=None):
    return gold.feature_store_by_state(
        loans or flat_loans(spark, sf_dir),
        views.silver_financials(spark, sf_dir),
        views.silver_attributes(spark, sf_dir),
        views.silver_clickstream(spark, sf_dir),
    )


def gold_by_state(spark, sf_dir, loans=None):
    loans = loans or flat_loans(spark, sf_dir)
    labels = gold.label_store_by_customer(loans)
    return gold.attach_labels(features_by_state(spark, sf_dir, loans), labels)


@query(
    """SELECT loan_id, mob, snapshot_date, installments_missed, first_missed_date, dpd FROM silver_loans""",
    dates="snapshot_date first_missed_date",
)
def loan_dpd(spark, sf_dir):
    """Days past due by months missed."""
    return views.silver_loans(spark, sf_dir).select(
        "loan_id", "mob", "snapshot_date", "installments_missed", "first_missed_date", "dpd"
    )


@query("SELECT loan_id, mob, snapshot_date, dpd FROM flat_loans", dates="snapshot_date")
def loan_dpd_flat(spark, sf_dir):
    """Days past due by the constant rule."""
    return flat_loans(spark, sf_dir).select("loan_id", "mob", "snapshot_date", "dpd")


@query(
    f"""SELECT loan_id, customer_id, tenure, loan_amt, {SIDE_COLUMNS}, snapshot_date,
               snapshot_date feature_date, 'v1' feature_version FROM features""",
    rounded=FEATURES, dates="snapshot_date feature_date",
)
def gold_features_a1(spark, sf_dir):
    """Month-0 loans with the customer's side tables of that month."""
    return features_typed(spark, sf_dir)


@query(
    f"SELECT loan_id, customer_id, tenure, loan_amt, {SIDE_COLUMNS}, snapshot_date FROM features",
    rounded=FEATURES, dates="snapshot_date",
)
def gold_features_stored(spark, sf_dir):
    """The same from four tables in buckets of customer and month, none of which is shuffled by the three joins."""
    stores = {
        "base": gold.application_base(views.silver_loans(spark, sf_dir)),
        "clickstream": views.silver_clickstream(spark, sf_dir),
        "attributes": views.silver_attributes(spark, sf_dir),
        "financials": views.silver_financials(spark, sf_dir),
    }
    return gold.feature_store_of(*_in_buckets(spark, stores, gold.BY_CUSTOMER))


@query(
    f"SELECT customer_id, tenure, mob, loan_amt, {SIDE_COLUMNS}, snapshot_date FROM gold_a2",
    rounded=FEATURES, dates="snapshot_date",
)
def gold_features_a2(spark, sf_dir):
    """Distinct loan states of all months with the side tables."""
    return features_by_state(spark, sf_dir)


@query(
    f"SELECT customer_id, tenure, mob, loan_amt, {SIDE_COLUMNS}, snapshot_date, label FROM gold_a2",
    rounded=FEATURES, dates="snapshot_date",
)
def gold_table_a2(spark, sf_dir):
    """The same with the customer's label; no label counts as good."""
    return gold_by_state(spark, sf_dir)


@query("SELECT customer_id, snapshot_date, label FROM labels_a2", dates="snapshot_date")
def label_store_a2(spark, sf_dir):
    return gold.label_store_by_customer(flat_loans(spark, sf_dir))


@query(
    "SELECT loan_id, customer_id, label, label_def, snapshot_date, dpd FROM labels_a1",
    dates="snapshot_date",
)
def label_store_a1(spark, sf_dir):
    return gold.label_store_at_mob(views.silver_loans(spark, sf_dir))


@query(
    "SELECT customer_id, loan_amt, tenure, mob, snapshot_date FROM states",
    rounded="loan_amt", dates="snapshot_date",
)
def distinct_loan_states(spark, sf_dir):
    return gold.distinct_loan_states(flat_loans(spark, sf_dir))


TRAINING_SQL = f"""
        SELECT f.loan_id, f.customer_id, l.snapshot_date label_date, tenure, loan_amt, {SIDE_COLUMNS},
               f.snapshot_date feature_date, 'v1' feature_version, label, label_def, dpd
        FROM features f JOIN labels_a1 l ON f.loan_id = l.loan_id AND f.customer_id = l.customer_id
         AND l.snapshot_date = cast(f.snapshot_date + INTERVAL 6 MONTH AS date)"""


@query(TRAINING_SQL, rounded=FEATURES, dates="label_date feature_date")
def training_set_a1(spark, sf_dir):
    """Application-time features with the outcome six months later."""
    loans = views.silver_loans(spark, sf_dir)
    return gold.training_set_from_loans(
        loans,
        gold.label_store_at_mob(loans),
        views.silver_clickstream(spark, sf_dir),
        views.silver_attributes(spark, sf_dir),
        views.silver_financials(spark, sf_dir),
    )


def _in_buckets(spark, stores, keys):
    """The stores written in as many buckets as a shuffle has partitions, and read back."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    paths = {name: scratch_path(spark, f"buckets-{name}") for name in stores}
    for name, store in stores.items():
        bucketed.write_bucketed(store, paths[name], keys, buckets)
    return [bucketed.read_bucketed(spark, path) for path in paths.values()]


@query(f"SELECT * FROM ({TRAINING_SQL})", rounded=FEATURES, dates="label_date feature_date")
def training_set_a1_stored(spark, sf_dir):
    """The same from feature and label stores in buckets of their join keys, of which neither is shuffled."""
    loans = views.silver_loans(spark, sf_dir)
    stores = {
        "features": gold.for_outcome(features_typed(spark, sf_dir, loans)),
        "labels": gold.as_outcome(gold.label_store_at_mob(loans)),
    }
    return gold.training_set_of(*_in_buckets(spark, stores, gold.OUTCOME_KEYS))


@query(
    f"""SELECT g.customer_id, tenure, mob, loan_amt, {SIDE_COLUMNS}, g.snapshot_date, l.label,
               strftime(g.snapshot_date, '%Y_%m_%d') snapshot_tag
        FROM gold_a2 g JOIN labels_a2 l ON g.customer_id = l.customer_id AND g.snapshot_date = l.snapshot_date""",
    rounded=FEATURES, dates="snapshot_date",
)
def training_set_a2(spark, sf_dir):
    """Feature rows with the customer's label of the same month."""
    loans = flat_loans(spark, sf_dir)
    labels = gold.label_store_by_customer(loans)
    return gold.training_set_same_month(gold_by_state(spark, sf_dir, loans), labels)


@query(
    """SELECT count(*) n_features, count(l.label) n_matched, coalesce(sum(l.label), 0) n_defaults,
              100.0 * count(l.label) / count(*) match_rate_pct,
              100.0 * sum(l.label) / count(l.label) default_rate_pct
       FROM applications f LEFT JOIN labels_a1 l ON f.loan_id = l.loan_id AND f.customer_id = l.customer_id
        AND l.snapshot_date = cast(f.snapshot_date + INTERVAL 6 MONTH AS date)""",
    rounded="match_rate_pct default_rate_pct", ints="n_features n_matched n_defaults",
)
def match_rate(spark, sf_dir):
    """How many features find their outcome."""
    loans = views.silver_loans(spark, sf_dir)
    return gold.match_rate(cleaning.at_mob(loans, 0), gold.label_store_at_mob(loans))
