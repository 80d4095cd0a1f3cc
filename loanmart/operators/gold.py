"""Gold layer: feature stores, label stores, training sets.

Every join here is an equi join with at most one side that may hold a hot key; adaptive
execution broadcasts a side it measures as small and splits a skewed partition of the other.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from loanmart.functions import delinquency
from loanmart.functions.delinquency import is_bad
from loanmart.operators.cleaning import at_mob
from loanmart.sources.bucketed import join_stored

BY_CUSTOMER = ["customer_id", "snapshot_date"]
LOAN_FEATURES = ["loan_id", "customer_id", "loan_amt", "tenure", "snapshot_date"]
LOAN_STATE = ["customer_id", "loan_amt", "tenure", "mob", "snapshot_date"]


def _with_sides(base: DataFrame, sides: Iterable[DataFrame | None]) -> DataFrame:
    """Left join each side that is present on customer and month, all on the same keys."""
    for side in sides:
        if side is not None:
            base = base.join(side, BY_CUSTOMER, "left")
    return base


def application_base(loans: DataFrame) -> DataFrame:
    return at_mob(loans, 0).select(*LOAN_FEATURES)


def feature_store(
    loans: DataFrame,
    clickstream: DataFrame | None,
    attributes: DataFrame | None,
    financials: DataFrame | None,
    version: str = "v1",
) -> DataFrame:
    """Application-time features: loans at month 0 with what was known that month."""
    wide = _with_sides(application_base(loans), [clickstream, attributes, financials])
    return wide.withColumn("feature_date", F.col("snapshot_date")).withColumn(
        "feature_version", F.lit(version)
    )


def feature_store_of(base: DataFrame, *sides: DataFrame) -> DataFrame:
    """Features from a stored application base and side tables, all in the same buckets of customer and month."""
    for side in sides:
        base = join_stored(base, side, BY_CUSTOMER, "left")
    return base


def distinct_loan_states(loans: DataFrame) -> DataFrame:
    return loans.select(*LOAN_STATE).dropDuplicates()


def feature_store_by_state(
    loans: DataFrame,
    financials: DataFrame | None,
    attributes: DataFrame | None,
    clickstream: DataFrame | None,
) -> DataFrame:
    """Features of every distinct loan state, at any month on book."""
    return _with_sides(distinct_loan_states(loans), [financials, attributes, clickstream])


def label_store_by_customer(loans: DataFrame, threshold: int = 30) -> DataFrame:
    """1 when any of the customer's loans reaches the threshold in the month."""
    return loans.groupBy(*BY_CUSTOMER).agg(
        F.max(is_bad(F.col("dpd"), threshold)).alias("label")
    )


def label_store_at_mob(loans: DataFrame, threshold: int = 30, mob: int = 6) -> DataFrame:
    """Outcome of each loan at one month on book."""
    snapshot, overdue = F.col("snapshot_date"), F.col("overdue_amt")
    missed = delinquency.installments_missed_unguarded(overdue, F.col("due_amt"))
    days = F.when(
        overdue > 0, F.datediff(snapshot, delinquency.first_missed_date(snapshot, missed))
    ).otherwise(F.lit(0))
    return (
        at_mob(loans, mob)
        .withColumn("dpd", days.cast("int"))
        .select(
            "loan_id",
            "customer_id",
            is_bad(F.col("dpd"), threshold).alias("label"),
            F.lit(f"{threshold}dpd_{mob}mob").alias("label_def"),
            "snapshot_date",
            "dpd",
        )
    )


def attach_labels(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Same-month labels; a customer without one counts as good."""
    return features.join(labels, BY_CUSTOMER, "left").fillna({"label": 0})


def _shifted(features: DataFrame, labels: DataFrame, months: int, how: str) -> DataFrame:
    return for_outcome(features, months).join(as_outcome(labels), OUTCOME_KEYS, how)


OUTCOME_KEYS = ["loan_id", "customer_id", "label_date"]


def for_outcome(features: DataFrame, months: int = 6) -> DataFrame:
    """Features with the month their outcome is due, as they are stored to be joined with it."""
    return features.drop("feature_date").withColumn("label_date", F.add_months("snapshot_date", months).cast("date"))


def as_outcome(labels: DataFrame) -> DataFrame:
    return labels.withColumnRenamed("snapshot_date", "label_date")


def training_set_of(due: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The shifted training set from both sides as they were stored, joined where they lie."""
    return join_stored(due, outcomes, OUTCOME_KEYS).withColumnRenamed("snapshot_date", "feature_date")


def training_set_shifted(
    features: DataFrame, labels: DataFrame, months: int = 6
) -> DataFrame:
    """Features of month X with the loan's outcome in month X + ``months``."""
    return _shifted(features, labels, months, "inner").withColumnRenamed(
        "snapshot_date", "feature_date"
    )


def training_set_from_loans(
    loans: DataFrame,
    labels: DataFrame,
    clickstream: DataFrame | None,
    attributes: DataFrame | None,
    financials: DataFrame | None,
    months: int = 6,
    version: str = "v1",
) -> DataFrame:
    """The shifted training set straight from the silver tables.

    Loans meet their outcome while rows are narrow, so that only loans that have one are
    joined with the side tables; the rows equal those made from a stored feature store.
    """
    paired = _shifted(application_base(loans), labels, months, "inner")
    wide = _with_sides(paired, [clickstream, attributes, financials])
    return wide.withColumnRenamed("snapshot_date", "feature_date").withColumn(
        "feature_version", F.lit(version)
    )


def training_set_same_month(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Features with the customer's label of the same month; an older label is replaced."""
    return (
        features.drop("label")
        .join(labels.select(*BY_CUSTOMER, "label"), BY_CUSTOMER, "inner")
        .withColumn("snapshot_tag", F.date_format("snapshot_date", "yyyy_MM_dd"))
    )


def match_rate(features: DataFrame, labels: DataFrame, months: int = 6) -> DataFrame:
    """How many features found their outcome, and the default rate among them."""
    paired = _shifted(
        features.select("loan_id", "customer_id", "snapshot_date"),
        labels.select("loan_id", "customer_id", "snapshot_date", "label"),
        months,
        "left",
    )
    features_n, matched, bad = F.count(F.lit(1)), F.count("label"), F.sum("label")
    return paired.agg(
        features_n.alias("n_features"),
        matched.alias("n_matched"),
        F.coalesce(bad, F.lit(0)).alias("n_defaults"),
        (100 * F.try_divide(matched, features_n)).alias("match_rate_pct"),
        (100 * F.try_divide(F.coalesce(bad, F.lit(0)), matched)).alias("default_rate_pct"),
    )
