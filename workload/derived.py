"""Derived features."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanmart.operators import cleaning, features
from workload import views
from workload.gold import features_typed
from workload.registry import query


@query(
    """SELECT loan_id,
              CASE WHEN annual_income <> 0 THEN loan_amt / annual_income END debt_to_income,
              CASE WHEN monthly_inhand_salary <> 0 THEN total_emi_per_month / monthly_inhand_salary END emi_burden,
              CASE WHEN annual_income <> 0 THEN outstanding_debt / annual_income END debt_service_ratio,
              CASE WHEN tenure <> 0 THEN loan_amt / tenure END monthly_payment
       FROM features""",
    rounded="debt_to_income emi_burden debt_service_ratio monthly_payment",
)
def ratio_features(spark, sf_dir):
    rows = features.with_ratios(features_typed(spark, sf_dir))
    return rows.select(
        "loan_id", "debt_to_income", "emi_burden", "debt_service_ratio", "monthly_payment"
    )


@query(
    """SELECT customer_id, fe_1 + fe_2 + fe_3 + fe_4 + fe_5 total_engagement,
              cast(fe_1 <> 0 AS int) + cast(fe_2 <> 0 AS int) + cast(fe_3 <> 0 AS int)
                + cast(fe_4 <> 0 AS int) + cast(fe_5 <> 0 AS int) activity_diversity,
              CASE WHEN fe_1 = 0 AND fe_2 = 0 AND fe_3 = 0 AND fe_4 = 0 AND fe_5 = 0 THEN NULL
                   WHEN fe_1 = top THEN 'fe_1' WHEN fe_2 = top THEN 'fe_2' WHEN fe_3 = top THEN 'fe_3'
                   WHEN fe_4 = top THEN 'fe_4' ELSE 'fe_5' END favorite_action
       FROM (SELECT *, greatest(fe_1, fe_2, fe_3, fe_4, fe_5) top FROM clickstream)""",
    rounded="total_engagement",
)
def engagement_features(spark, sf_dir):
    rows = features.with_engagement(views.silver_clickstream(spark, sf_dir))
    return rows.select("customer_id", "total_engagement", "activity_diversity", "favorite_action")


@query(
    """SELECT customer_id, age,
              CASE WHEN age <= 0 THEN NULL WHEN age <= 25 THEN '<25' WHEN age <= 35 THEN '25-34'
                   WHEN age <= 45 THEN '35-44' WHEN age <= 55 THEN '45-54' WHEN age <= 65 THEN '55-64'
                   WHEN age <= 100 THEN '65+' END age_group FROM attributes""",
    rounded="age",
)
def age_groups(spark, sf_dir):
    rows = features.with_age_group(views.silver_attributes(spark, sf_dir))
    return rows.select("customer_id", "age", "age_group")


@query(
    """SELECT band, count(*) n FROM (
         SELECT CASE WHEN dti <= 0 THEN NULL WHEN dti <= 0.3 THEN 'Excellent (5)' WHEN dti <= 0.5 THEN 'Good (4)'
                     WHEN dti <= 0.7 THEN 'Fair (3)' WHEN dti <= 1.0 THEN 'Poor (2)'
                     WHEN dti > 1.0 THEN 'Critical (1)' END band
         FROM (SELECT CASE WHEN annual_income <> 0 THEN outstanding_debt / annual_income END dti
               FROM financials)) WHERE band IS NOT NULL GROUP BY 1""",
)
def dti_bands(spark, sf_dir):
    """Financial health bands of debt against income."""
    dti = F.try_divide("outstanding_debt", "annual_income")
    return features.dti_bands(views.silver_financials(spark, sf_dir).withColumn("dti", dti), "dti")


@query(
    """SELECT customer_id, annual_income,
              CASE WHEN annual_income <= lower THEN 'low' WHEN annual_income <= upper THEN 'medium'
                   WHEN annual_income IS NOT NULL THEN 'high' END income_band
       FROM financials CROSS JOIN
         (SELECT quantile_cont(annual_income, 0.3333333333333333::double) AS lower,
                 quantile_cont(annual_income, 0.6666666666666666::double) AS upper FROM financials)""",
    rounded="annual_income",
)
def income_bands(spark, sf_dir):
    """Terciles of income."""
    rows = features.with_income_band(views.silver_financials(spark, sf_dir))
    return rows.select("customer_id", "annual_income", "income_band")


@query(
    """SELECT customer_id, annual_income,
              CASE WHEN annual_income <= lower THEN 'low' WHEN annual_income <= upper THEN 'medium'
                   WHEN annual_income IS NOT NULL THEN 'high' END income_band
       FROM financials CROSS JOIN
         (SELECT quantile_cont(annual_income, 0.3333333333333333::double) AS lower,
                 quantile_cont(annual_income, 0.6666666666666666::double) AS upper FROM financials)""",
    rounded="annual_income",
)
def income_bands_refined(spark, sf_dir):
    """The same with terciles found by refining ranges."""
    rows = features.with_income_band_refined(views.silver_financials(spark, sf_dir))
    return rows.select("customer_id", "annual_income", "income_band")


@query(
    """SELECT loan_id, loan_amt * credit_utilization_ratio loan_amt_x_utilization,
              tenure * interest_rate tenure_x_interest_rate, age * num_of_loan age_x_credit_cards,
              loan_amt * loan_amt loan_amt_squared FROM features""",
    rounded="loan_amt_x_utilization tenure_x_interest_rate age_x_credit_cards loan_amt_squared",
    digits=1,
)
def interaction_features(spark, sf_dir):
    """Products of features; the number of loans stands in for the number of cards."""
    rows = features_typed(spark, sf_dir).withColumn("num_credit_card", F.col("num_of_loan"))
    return features.with_interactions(rows).select(
        "loan_id", "loan_amt_x_utilization", "tenure_x_interest_rate", "age_x_credit_cards",
        "loan_amt_squared",
    )


def _log_sql(column: str) -> str:
    skew = f"(SELECT avg((v - m) ** 3) / avg((v - m) ** 2) ** 1.5 FROM (SELECT {column} v, avg({column}) OVER () m FROM financials))"
    return (
        f"CASE WHEN abs({skew}) > 0.6 THEN CASE WHEN {column} > -1 THEN ln(1 + {column}) END "
        f"ELSE {column} END log_{column}"
    )


@query(
    f"SELECT customer_id, {_log_sql('annual_income')}, {_log_sql('outstanding_debt')}, "
    f"{_log_sql('credit_utilization_ratio')} FROM financials",
    rounded="log_annual_income log_outstanding_debt log_credit_utilization_ratio",
)
def log_features(spark, sf_dir):
    """Logarithms of the skewed columns only."""
    columns = ["annual_income", "outstanding_debt", "credit_utilization_ratio"]
    rows = features.with_log(views.silver_financials(spark, sf_dir), columns, threshold=0.6)
    return rows.select("customer_id", *[f"log_{c}" for c in columns])


OCCUPATIONS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query(
    "SELECT customer_id, "
    + ", ".join(
        f"CASE WHEN occupation = '{o}' THEN 1 ELSE 0 END occupation_{o.lower()}" for o in OCCUPATIONS
    )
    + " FROM raw_attributes",
)
def one_hot(spark, sf_dir):
    """One column per occupation found in the cleaned table."""
    rows = cleaning.silver_attributes(views.raw_attributes(spark, sf_dir), "repair")
    found = features.categories_of(rows, "occupation")
    hot = features.with_one_hot(rows, "occupation", found)
    return hot.select("customer_id", *[c for c in hot.columns if c.startswith("occupation_")])
