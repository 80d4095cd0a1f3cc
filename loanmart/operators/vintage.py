"""Bad rate by months on book and its course."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from loanmart.functions.delinquency import is_bad
from loanmart.operators.cleaning import first_present

# Spellings under which the delay column may appear.
DPD_NAMES = ("dpd", "DPD", "Dpd", "days_past_due", "DaysPastDue")


def delay_column(df: DataFrame) -> str:
    name = first_present(df, DPD_NAMES)
    if name is None:
        raise ValueError(f"no delay column; looked for {', '.join(DPD_NAMES)}")
    return name


def bad_rate_by_mob(loans: DataFrame, threshold: int = 30) -> DataFrame:
    """Distinct loans and distinct bad loans per month on book.

    Rows are first reduced to one per loan and month on book; the second step then counts, so
    a month that holds most of the rows is spread over its loans.
    """
    bad = F.max(is_bad(F.col(delay_column(loans)), threshold)).alias("bad")
    per_loan = loans.groupBy("mob", "loan_id").agg(bad)
    return per_loan.groupBy("mob").agg(
        F.count("loan_id").alias("total_loans"),
        F.sum(F.when(F.col("loan_id").isNotNull(), F.col("bad")).otherwise(0)).alias("bad_loans"),
    ).withColumn("bad_rate", _rate("bad_loans", "total_loans"))


def bad_rate_by_mob_rows(loans: DataFrame, threshold: int = 30) -> DataFrame:
    """The same on rows."""
    bad = is_bad(F.col(delay_column(loans)), threshold)
    return loans.groupBy("mob").agg(
        F.count(F.lit(1)).alias("total"), F.sum(bad).alias("bad")
    ).withColumn("bad_rate", _rate("bad", "total"))


def _rate(part: str, whole: str):
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def with_change(rates: DataFrame) -> DataFrame:
    """Change against the month before. One row per month on book, so one task suffices."""
    return rates.withColumn(
        "mom_change", F.col("bad_rate") - F.lag("bad_rate").over(Window.orderBy("mob"))
    )


def largest_increase(rates: DataFrame) -> DataFrame:
    changes = with_change(rates).where("mom_change IS NOT NULL")
    return changes.orderBy(F.desc("mom_change"), "mob").limit(1).select("mob", "mom_change")


def stabilisation_point(rates: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """First month whose rate moved by less than the tolerance; null when there is none."""
    calm = F.abs("mom_change") < tolerance
    return with_change(rates).agg(F.min(F.when(calm, F.col("mob"))).alias("stabilisation_mob"))


def growth(rates: DataFrame) -> DataFrame:
    """From the first to the last month on book; relative growth from 0 is left null."""
    ends = rates.agg(
        F.min_by("bad_rate", "mob").alias("initial_rate"),
        F.max("mob").alias("final_mob"),
        F.max_by("bad_rate", "mob").alias("final_rate"),
    )
    rise = F.col("final_rate") - F.col("initial_rate")
    return ends.withColumns(
        {
            "absolute_growth": rise,
            "relative_growth_pct": 100 * F.try_divide(rise, F.col("initial_rate")),
        }
    )


def null_delays(loans: DataFrame) -> DataFrame:
    """Rows without a delay, which the rates count as not late."""
    delay = delay_column(loans)
    return loans.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(delay).isNull()).alias("n_null_dpd")
    )


def no_bad_loans(rates: DataFrame) -> DataFrame:
    """One row saying whether any month has a bad loan: a threshold too high shows here."""
    return rates.agg((F.coalesce(F.sum("bad_loans"), F.lit(0)) == 0).alias("no_bad_loans"))
