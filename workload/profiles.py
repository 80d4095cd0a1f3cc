"""Store checks, data quality and exploratory profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanmart.functions.text import ssn_is_valid
from loanmart.operators import cleaning, gold, gram, profile, ranks, snapshots, vintage
from loanmart.plans import datamart
from loanmart.session import scratch_path
from loanmart.sources import bitmaps, raw
from workload import views
from workload.gold import features_typed, gold_by_state
from workload.registry import query

FINANCES = (
    "annual_income", "monthly_inhand_salary", "interest_rate", "num_of_loan",
    "outstanding_debt", "credit_utilization_ratio", "total_emi_per_month",
)
CLICKS = tuple(f"fe_{i}" for i in range(1, 6))


def labels(spark, sf_dir):
    return gold.label_store_at_mob(views.silver_loans(spark, sf_dir))


@query(
    """SELECT count(*) n_rows, count(DISTINCT loan_id) n_loan_id, count(DISTINCT customer_id) n_customer_id,
              min(snapshot_date) first_snapshot, max(snapshot_date) last_snapshot FROM silver_loans""",
    dates="first_snapshot last_snapshot",
)
def store_profile(spark, sf_dir):
    return profile.store_profile(views.silver_loans(spark, sf_dir), "loan_id", "customer_id")


@query(
    """SELECT label, count(*) n, 100.0 * count(*) / sum(count(*)) OVER () share_pct
       FROM labels_a1 GROUP BY label""",
    rounded="share_pct",
)
def label_distribution(spark, sf_dir):
    return profile.label_distribution(labels(spark, sf_dir))


@query(
    """SELECT count(*) n_loans, sum(label) n_defaults, 100.0 * sum(label) / count(*) default_rate_pct
       FROM labels_a1""",
    rounded="default_rate_pct", ints="n_loans n_defaults",
)
def default_rate(spark, sf_dir):
    return profile.default_rate(labels(spark, sf_dir))


def _summary_sql(columns, view):
    return " UNION ALL ".join(
        f"""SELECT '{c}' "column", count({c}) n, avg({c}) mean, stddev_samp({c}) "stddev",
                   cast(min({c}) AS double) "min", cast(max({c}) AS double) "max" FROM {view}"""
        for c in columns
    )


@query(_summary_sql(["dpd", "loan_amt", "overdue_amt", "tenure"], "silver_loans"),
       rounded="mean stddev min max", digits=4)
def column_summary(spark, sf_dir):
    """Count, mean, deviation and range."""
    loans = views.silver_loans(spark, sf_dir)
    return profile.column_summary(loans, ["dpd", "loan_amt", "overdue_amt", "tenure"])


@query(
    _summary_sql(["loan_amt", "tenure", "mob", *FINANCES, "age", *CLICKS], "gold_a2"),
    rounded="mean stddev min max", digits=4,
)
def numeric_features(spark, sf_dir):
    """The columns a model would use, picked by type, with their summary."""
    rows = gold_by_state(spark, sf_dir)
    chosen = cleaning.numeric_columns(rows, ["customer_id", "snapshot_date", "label"])
    return profile.column_summary(rows, chosen)


@query(
    """SELECT 'occupation' "column", occupation "value", count(*) n FROM raw_attributes
       WHERE occupation IS NOT NULL GROUP BY 2""",
)
def value_counts(spark, sf_dir):
    """Values of the text columns that have few of them."""
    rows = views.raw_attributes(spark, sf_dir)
    return profile.value_counts(rows, profile.string_columns(rows, ["customer_id", "ssn"]))


@query(
    """SELECT "column", "value", n, NULL::bigint at_least FROM (
         SELECT 'occupation' AS "column", occupation AS "value", count(*) n FROM raw_attributes WHERE occupation IS NOT NULL GROUP BY 2)
       UNION ALL SELECT c, NULL, NULL, 16 FROM (
         SELECT 'name' AS c, count(DISTINCT name) k FROM raw_attributes UNION ALL SELECT 'ssn', count(DISTINCT ssn) FROM raw_attributes
         UNION ALL SELECT 'customer_id', count(DISTINCT customer_id) FROM raw_attributes) WHERE k > 15""",
    ints="n at_least",
)
def value_counts_reported(spark, sf_dir):
    """The same with a row for every column that has too many values to be listed."""
    rows = views.raw_attributes(spark, sf_dir)
    return profile.value_counts_reported(rows, ["customer_id", "name", "ssn", "occupation"])


@query("SELECT tenure, count(*) n FROM applications WHERE tenure IS NOT NULL GROUP BY 1")
def tenure_counts(spark, sf_dir):
    """Value counts of a numeric column, by value."""
    counts = profile.value_counts(views.applications(spark, sf_dir), ["tenure"], None)
    return counts.select(F.col("value").cast("int").alias("tenure"), "n").orderBy("tenure")


@query(
    """SELECT snapshot_date, avg(CASE WHEN ok THEN 0.0 ELSE 1.0 END) share_false,
              avg(CASE WHEN ok THEN 1.0 ELSE 0.0 END) share_true
       FROM (SELECT snapshot_date, regexp_full_match(ssn, '[0-9]{3}-[0-9]{2}-[0-9]{4}') ok FROM raw_attributes)
       GROUP BY 1""",
    rounded="share_false share_true", dates="snapshot_date",
)
def ssn_validity_by_month(spark, sf_dir):
    rows = views.raw_attributes(spark, sf_dir)
    return profile.flag_share_by_group(rows, "snapshot_date", ssn_is_valid(F.col("ssn")))


MISSING = {
    "Attributes": ("repaired", ["customer_id", "name", "age", "ssn", "occupation", "snapshot_date"]),
    "Financials": (
        "financials",
        "customer_id monthly_inhand_salary annual_income interest_rate num_of_loan outstanding_debt "
        "total_emi_per_month credit_utilization_ratio snapshot_date".split(),
    ),
    "LMS MOB=0": (
        "applications",
        "loan_id customer_id loan_start_date tenure installment_num loan_amt due_amt paid_amt "
        "overdue_amt balance snapshot_date mob installments_missed first_missed_date dpd".split(),
    ),
}
MISSING_SQL = " UNION ALL ".join(
    f"SELECT '{name}' dataset, strftime(snapshot_date, '%b %Y') m, 100.0 * ("
    + " + ".join(f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)" for c in columns)
    + f" + avg(CASE WHEN snapshot_date IS NULL THEN 1.0 ELSE 0.0 END)) / {len(columns) + 1} p FROM {view} GROUP BY ALL"
    for name, (view, columns) in MISSING.items()
)


@query(
    f"SELECT dataset, m data_month, p missing_pct FROM ({MISSING_SQL})",
    rounded="missing_pct",
    views={
        "repaired": """
            SELECT customer_id, name, CASE WHEN try_cast(rtrim(age, '_') AS double) BETWEEN 0 AND 120
                   THEN try_cast(rtrim(age, '_') AS double) END age,
                   CASE WHEN regexp_full_match(ssn, '[0-9]{3}-[0-9]{2}-[0-9]{4}') THEN ssn END ssn,
                   CASE WHEN replace(occupation, '_', '') <> '' THEN occupation END occupation, snapshot_date
            FROM raw_attributes"""
    },
)
def missing_pct(spark, sf_dir):
    """Mean share of missing values per dataset and month, all months."""
    return profile.missing_pct(
        {
            name: df.withColumn("data_month", F.date_format("snapshot_date", "MMM yyyy"))
            for name, df in _described(spark, sf_dir).items()
        }
    )


def _described(spark, sf_dir):
    return {
        "Attributes": cleaning.silver_attributes(views.raw_attributes(spark, sf_dir), "repair"),
        "Financials": views.silver_financials(spark, sf_dir),
        "LMS MOB=0": views.applications(spark, sf_dir),
    }


@query(
    "SELECT snapshot_date, count(loan_id) n_applications FROM applications GROUP BY 1",
    dates="snapshot_date",
)
def applications_by_month(spark, sf_dir):
    return profile.applications_by_month(views.applications(spark, sf_dir))


@query(
    """SELECT sum(n) n_applications, avg(n) mean_per_month FROM
         (SELECT snapshot_date, count(loan_id) n FROM applications GROUP BY 1)""",
    rounded="mean_per_month", ints="n_applications",
)
def applications_per_month(spark, sf_dir):
    by_month = profile.applications_by_month(views.applications(spark, sf_dir))
    return profile.mean_per_month(by_month)


@query(
    """SELECT count(*) FILTER (n = 1) n_single, count(*) FILTER (n > 1) n_multiple,
              100.0 * count(*) FILTER (n > 1) / count(*) multiple_pct
       FROM (SELECT customer_id, count(*) n FROM applications GROUP BY 1)""",
    rounded="multiple_pct",
)
def multi_application_share(spark, sf_dir):
    return profile.multi_application_share(views.applications(spark, sf_dir))


@query(
    """SELECT count(DISTINCT ssn) n_distinct, count(*) n_rows,
              100.0 * count(DISTINCT ssn) / count(*) uniqueness_pct FROM raw_attributes""",
    rounded="uniqueness_pct", ints="n_rows",
)
def key_uniqueness(spark, sf_dir):
    return profile.key_uniqueness(views.raw_attributes(spark, sf_dir), "ssn")


CORRELATION_SQL = " UNION ALL ".join(
    f"SELECT '{a}' a, '{b}' b, corr({a}, {b}) corr FROM financials"
    for i, a in enumerate(FINANCES) for b in FINANCES[i + 1:]
)


@query(CORRELATION_SQL, rounded="corr")
def correlation_pairs(spark, sf_dir):
    return profile.correlation_pairs(views.silver_financials(spark, sf_dir), FINANCES)


@query(
    f"SELECT a, b, corr FROM ({CORRELATION_SQL}) ORDER BY abs(corr) DESC, a, b LIMIT 5",
    rounded="corr",
)
def top_correlations(spark, sf_dir):
    """The five strongest pairs."""
    return profile.top_correlations(views.silver_financials(spark, sf_dir), FINANCES)


ACTIVITY_SQL = " UNION ALL ".join(
    f"SELECT '{c}' activity, sum({c}) total, avg({c}) mean FROM clickstream" for c in CLICKS
)


@query(
    f"SELECT * FROM ({ACTIVITY_SQL}) ORDER BY total DESC, activity LIMIT 3",
    rounded="total mean", digits=4,
)
def top_activities(spark, sf_dir):
    return profile.top_activities(views.silver_clickstream(spark, sf_dir), CLICKS, 3)


@query(
    f"SELECT * FROM ({ACTIVITY_SQL}) ORDER BY mean DESC, activity LIMIT 15",
    rounded="total mean", digits=4,
)
def activity_means(spark, sf_dir):
    return profile.top_activities(views.silver_clickstream(spark, sf_dir), CLICKS, 15, "mean")


def _histogram_sql(view: str, column: str, bins: int) -> str:
    return f"""
        SELECT g.bin, lo + g.bin * ((hi - lo) / {bins}) low, lo + (g.bin + 1) * ((hi - lo) / {bins}) high,
               coalesce(n, 0) n
        FROM (SELECT cast(unnest(range({bins})) AS int) bin) g
        CROSS JOIN (SELECT min({column}) lo, max({column}) hi FROM {view}) e
        LEFT JOIN (SELECT cast(least({bins - 1}, len(list_filter(range({bins + 1}),
                            lambda i: lo + i * ((hi - lo) / {bins}) <= x)) - 1) AS int) bin, count(*) n
                   FROM (SELECT {column} x FROM {view} WHERE {column} IS NOT NULL)
                   CROSS JOIN (SELECT min({column}) lo, max({column}) hi FROM {view})
                   GROUP BY 1) c ON c.bin = g.bin"""


@query(_histogram_sql("applications", "loan_amt", 50), rounded="low high")
def histogram(spark, sf_dir):
    return profile.histogram(views.applications(spark, sf_dir), "loan_amt", 50)


@query(_histogram_sql("attributes", "age", 30), rounded="low high")
def histogram_age(spark, sf_dir):
    return profile.histogram(views.silver_attributes(spark, sf_dir), "age", 30)


GRAM_COLUMNS = [
    "loan_amt", "tenure", "fe_1", "fe_2", "fe_3", "fe_4", "fe_5", "age", "monthly_inhand_salary", "annual_income", "interest_rate",
    "num_of_loan", "outstanding_debt", "total_emi_per_month", "credit_utilization_ratio",
]
# ratios and powers of them, so that there are some five hundred pairs
GRAM_DERIVED = {
    "emi_share": "total_emi_per_month / (abs(monthly_inhand_salary) + 1)", "debt_share": "outstanding_debt / (abs(annual_income) + 1)",
    "amount_a_month": "loan_amt / tenure", "age_rate": "age * interest_rate", "clicks": "fe_1 + fe_2 + fe_3 + fe_4 + fe_5",
    **{f"{c}_squared": f"{c} * {c} * 1.0" for c in ("loan_amt", "age", "interest_rate", "num_of_loan", "fe_1", "fe_2", "fe_3")},
    **{f"{c}_root": f"sqrt(abs({c}))" for c in ("loan_amt", "age", "outstanding_debt", "annual_income", "fe_1", "fe_2")},
}
GRAM_ALL = [*GRAM_COLUMNS, *GRAM_DERIVED]
GRAM_SQL = " UNION ALL ".join(
    f"SELECT '{a}' a, '{b}' b, count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL) n, corr({a}, {b}) corr FROM wide"
    for i, a in enumerate(GRAM_ALL) for b in GRAM_ALL[i + 1 :]
)


@query(
    f"SELECT a, b, n, CASE WHEN isnan(corr) THEN NULL ELSE corr END corr FROM ({GRAM_SQL})", rounded="corr", ints="n",
    views={
        "typed": "SELECT " + ", ".join(f"cast({c} AS double) {c}" for c in GRAM_COLUMNS) + " FROM features",
        "wide": "SELECT *, " + ", ".join(f"{e} {c}" for c, e in GRAM_DERIVED.items()) + " FROM typed",
    },
)
def correlation_gram(spark, sf_dir):
    """Correlations of all pairs of the numeric gold columns and of others made from them, by one Gram matrix."""
    typed = features_typed(spark, sf_dir).select(*[F.col(c).cast("double").alias(c) for c in GRAM_COLUMNS])
    return gram.correlations(typed.withColumns({c: F.expr(e) for c, e in GRAM_DERIVED.items()}), GRAM_ALL)


@query(_histogram_sql("financials", "annual_income", 40), rounded="low high")
def histogram_income(spark, sf_dir):
    return profile.histogram(views.silver_financials(spark, sf_dir), "annual_income", 40)


@query(
    """SELECT feature, min(value) FILTER (value >= q1 - 1.5 * (q3 - q1)) whisker_low, q1, median, q3,
              max(value) FILTER (value <= q3 + 1.5 * (q3 - q1)) whisker_high,
              count(*) FILTER (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) n_outliers
       FROM lng JOIN (SELECT feature, quantile_cont(value, 0.25) q1, quantile_cont(value, 0.5) median,
                             quantile_cont(value, 0.75) q3 FROM lng GROUP BY 1) USING (feature)
       GROUP BY feature, q1, median, q3""",
    rounded="whisker_low q1 median q3 whisker_high",
    views={
        "picked": "SELECT loan_amt, overdue_amt FROM silver_loans",
        "lng": "SELECT * FROM picked UNPIVOT (value FOR feature IN (loan_amt, overdue_amt))",
    },
)
def boxplot_stats(spark, sf_dir):
    """Quartiles and whiskers."""
    return profile.boxplot_stats(views.silver_loans(spark, sf_dir), ["loan_amt", "overdue_amt"])


@query(
    """SELECT feature, min(value) FILTER (value >= q1 - 1.5 * (q3 - q1)) whisker_low, q1, median, q3,
              max(value) FILTER (value <= q3 + 1.5 * (q3 - q1)) whisker_high,
              count(*) FILTER (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) n_outliers
       FROM lng JOIN (SELECT feature, quantile_cont(value, 0.25) q1, quantile_cont(value, 0.5) median,
                             quantile_cont(value, 0.75) q3 FROM lng GROUP BY 1) USING (feature)
       GROUP BY feature, q1, median, q3""",
    rounded="whisker_low q1 median q3 whisker_high", ints="n_outliers",
    views={"lng": "SELECT feature, value FROM silver_loans UNPIVOT (value FOR feature IN (loan_amt, overdue_amt, due_amt, paid_amt, balance))"},
)
def boxplot_refined(spark, sf_dir):
    """The same of all amounts, by refining ranges instead of ordering values."""
    return ranks.boxplot(views.silver_loans(spark, sf_dir), ["loan_amt", "overdue_amt", "due_amt", "paid_amt", "balance"])


@query(
    """SELECT min(loan_amt) min_amount, max(loan_amt) max_amount,
              count(*) FILTER (loan_amt >= 50000) n_high_value,
              100.0 * count(*) FILTER (loan_amt >= 50000) / count(loan_amt) high_value_pct,
              median(loan_amt) median_amount, cast(median(tenure) AS double) median_tenure,
              (SELECT tenure FROM applications GROUP BY 1 ORDER BY count(*) DESC, tenure LIMIT 1) mode_tenure,
              (SELECT min(age) FROM attributes) min_age, (SELECT max(age) FROM attributes) max_age,
              (SELECT median(age) FROM attributes) median_age, (SELECT min(annual_income) FROM financials) min_income,
              (SELECT max(annual_income) FROM financials) max_income, (SELECT median(annual_income) FROM financials) median_income,
              (SELECT median(outstanding_debt / annual_income) FROM financials WHERE annual_income <> 0) median_dti
       FROM applications""",
    rounded="min_amount max_amount high_value_pct median_amount median_tenure min_age max_age median_age min_income max_income "
    "median_income median_dti",
)
def application_profile(spark, sf_dir):
    """Amounts and tenures of the applications, ages, incomes and debts of the applicants."""
    dti = F.try_divide("outstanding_debt", "annual_income").alias("dti")
    financials = views.silver_financials(spark, sf_dir).select("annual_income", dti)
    facts = profile.applicant_facts(views.silver_attributes(spark, sf_dir), financials, "dti")
    return profile.application_profile(views.applications(spark, sf_dir)).withColumns(facts)


@query(
    """SELECT count(dti) n_dti, count(*) FILTER (dti BETWEEN 0 AND 2) n_dti_plotted,
              100.0 * count(*) FILTER (dti > 0.43) / count(dti) high_dti_pct,
              count(u) n_utilization, count(*) FILTER (u BETWEEN 0 AND 100) n_utilization_plotted,
              100.0 * count(*) FILTER (u > 70) / count(u) high_utilization_pct
       FROM (SELECT CASE WHEN annual_income <> 0 THEN outstanding_debt / annual_income END dti,
                    credit_utilization_ratio u FROM financials)""",
    rounded="high_dti_pct high_utilization_pct",
)
def risk_shares(spark, sf_dir):
    rows = views.silver_financials(spark, sf_dir)
    dti = F.try_divide("outstanding_debt", "annual_income")
    return profile.risk_shares(rows.withColumn("dti", dti), "dti", "credit_utilization_ratio")


@query(
    """SELECT count(*) n_distinct FROM (
         SELECT customer_id FROM raw_attributes UNION SELECT customer_id FROM raw_financials
         UNION SELECT customer_id FROM applications) WHERE customer_id IS NOT NULL""",
)
def total_customers(spark, sf_dir):
    tables = [
        views.raw_attributes(spark, sf_dir),
        views.raw_financials(spark, sf_dir),
        views.applications(spark, sf_dir),
    ]
    return profile.distinct_over_tables(tables, "customer_id")


@query(
    """SELECT 'all months' AS over, count(DISTINCT customer_id) n_distinct FROM (
         SELECT customer_id, snapshot_date FROM raw_attributes UNION SELECT customer_id, snapshot_date FROM raw_financials
         UNION SELECT customer_id, snapshot_date FROM applications) WHERE snapshot_date IS NOT NULL
       UNION ALL SELECT 'two months', count(DISTINCT customer_id) FROM (
         SELECT customer_id, snapshot_date FROM raw_attributes UNION SELECT customer_id, snapshot_date FROM raw_financials
         UNION SELECT customer_id, snapshot_date FROM applications) WHERE snapshot_date IN (DATE '1996-02-01', DATE '1997-03-01')""",
    ints="n_distinct",
)
def total_customers_stored(spark, sf_dir):
    """Customers in any of three tables, in all and in two months, from bitmaps that were written a table at a time."""
    root = scratch_path(spark, "bitmaps")
    found = {
        "attributes": views.raw_attributes(spark, sf_dir),
        "financials": views.raw_financials(spark, sf_dir),
        "applications": views.applications(spark, sf_dir),
    }
    for name, table in found.items():
        bitmaps.write_bitmaps(table.select("customer_id", "snapshot_date"), f"{root}/{name}", {"customer_id": f"{root}/ids"})
    paths = [f"{root}/{name}" for name in found]
    every = bitmaps.distinct_ids(spark, paths, "customer_id").withColumn("over", F.lit("all months"))
    two = bitmaps.distinct_ids(spark, paths, "customer_id", ["1996-02-01", "1997-03-01"]).withColumn("over", F.lit("two months"))
    return every.unionByName(two).select("over", "n_distinct")


@query(
    """SELECT count(*) n_rows, count(DISTINCT loan_id) n_loan_id, count(DISTINCT customer_id) n_customer_id,
              min(snapshot_date) first_snapshot, max(snapshot_date) last_snapshot FROM silver_loans""",
    dates="first_snapshot last_snapshot", ints="n_rows",
)
def store_profile_stored(spark, sf_dir):
    """Rows, distinct keys and dates of the loans from their bitmaps."""
    root = scratch_path(spark, "bitmaps")
    ids = {c: f"{root}/{c}" for c in ("loan_id", "customer_id")}
    loans = views.silver_loans(spark, sf_dir).select("loan_id", "customer_id", "snapshot_date")
    bitmaps.write_bitmaps(loans, f"{root}/loans", ids)
    return bitmaps.store_profile(spark, f"{root}/loans", *ids)


@query(
    """SELECT loan_id, loan_amt, balance FROM applications
       WHERE loan_amt IS NOT NULL AND balance IS NOT NULL ORDER BY md5(loan_id), loan_id LIMIT 1000""",
    rounded="loan_amt balance",
)
def stable_sample(spark, sf_dir):
    """A random but repeatable sample for a scatter plot."""
    rows = views.applications(spark, sf_dir).select("loan_id", "loan_amt", "balance").dropna()
    return profile.stable_sample(rows, ["loan_id"], 1000)


@query(
    """SELECT loan_id, snapshot_date, CASE WHEN year(snapshot_date) % 2 = 0 THEN dpd END dpd,
              CASE WHEN year(snapshot_date) % 2 = 1 THEN balance END balance FROM silver_loans""",
    rounded="balance", dates="snapshot_date",
)
def union_by_name(spark, sf_dir):
    """All months in one, as if those of odd years had been written with other columns."""
    loans = views.silver_loans(spark, sf_dir)
    odd = F.year("snapshot_date") % 2 == 1
    first = loans.where(~odd).select("loan_id", "snapshot_date", "dpd")
    second = loans.where(odd).select("snapshot_date", "loan_id", "balance")
    return profile.union_by_name([first, second])


@query(
    """SELECT m.snapshot_date FROM
         (SELECT cast(unnest(generate_series(min(snapshot_date), max(snapshot_date), INTERVAL 1 MONTH)) AS date)
                   snapshot_date FROM silver_loans) m
       WHERE m.snapshot_date NOT IN (SELECT snapshot_date FROM attributes WHERE snapshot_date IS NOT NULL)""",
    dates="snapshot_date",
)
def missing_months(spark, sf_dir):
    """Months of the loans for which no customer's attributes came in."""
    loans = views.silver_loans(spark, sf_dir)
    return snapshots.missing_months(snapshots.calendar(loans), views.silver_attributes(spark, sf_dir))


@query("SELECT count(*) n_rows, count(*) FILTER (dpd IS NULL) n_null_dpd FROM silver_loans")
def null_dpd(spark, sf_dir):
    return vintage.null_delays(views.silver_loans(spark, sf_dir))


RATES = {
    "rates": """
        SELECT mob, count(DISTINCT loan_id) total_loans,
               count(DISTINCT CASE WHEN dpd >= 30 THEN loan_id END) bad_loans,
               count(DISTINCT CASE WHEN dpd >= 30 THEN loan_id END) / count(DISTINCT loan_id) bad_rate
        FROM silver_loans GROUP BY 1""",
    "changes": "SELECT *, bad_rate - lag(bad_rate) OVER (ORDER BY mob) mom_change FROM rates",
}


def rates(spark, sf_dir):
    return vintage.bad_rate_by_mob(views.silver_loans(spark, sf_dir))


@query("SELECT * FROM rates", rounded="bad_rate", views=RATES)
def bad_rate_by_mob(spark, sf_dir):
    return rates(spark, sf_dir)


@query(
    """SELECT mob, count(*) total, count(*) FILTER (dpd >= 30) bad,
              count(*) FILTER (dpd >= 30) / count(*) bad_rate FROM silver_loans GROUP BY 1""",
    rounded="bad_rate", ints="bad",
)
def bad_rate_by_mob_rows(spark, sf_dir):
    return vintage.bad_rate_by_mob_rows(views.silver_loans(spark, sf_dir))


@query("SELECT * FROM changes", rounded="bad_rate mom_change", views=RATES)
def bad_rate_mom(spark, sf_dir):
    return vintage.with_change(rates(spark, sf_dir))


@query(
    """SELECT mob, mom_change FROM changes WHERE mom_change IS NOT NULL
       ORDER BY mom_change DESC, mob LIMIT 1""",
    rounded="mom_change", views=RATES,
)
def bad_rate_peak(spark, sf_dir):
    return vintage.largest_increase(rates(spark, sf_dir))


@query(
    "SELECT min(mob) FILTER (abs(mom_change) < 0.01) stabilisation_mob FROM changes", views=RATES
)
def bad_rate_stabilisation(spark, sf_dir):
    return vintage.stabilisation_point(rates(spark, sf_dir))


@query(
    """SELECT initial_rate, final_mob, final_rate, final_rate - initial_rate absolute_growth,
              CASE WHEN initial_rate <> 0 THEN 100 * (final_rate - initial_rate) / initial_rate END
                relative_growth_pct
       FROM (SELECT arg_min(bad_rate, mob) initial_rate, max(mob) final_mob, arg_max(bad_rate, mob) final_rate
             FROM rates)""",
    rounded="initial_rate final_rate absolute_growth relative_growth_pct", views=RATES,
)
def bad_rate_growth(spark, sf_dir):
    """From the first month on book; nothing can be late there, so relative growth is null."""
    return vintage.growth(rates(spark, sf_dir))


@query(
    """SELECT t.threshold, count(*) FILTER (dpd >= t.threshold) = 0 no_bad_loans
       FROM silver_loans, (SELECT unnest([30, 1000000]) AS threshold) t GROUP BY 1""",
    ints="threshold",
)
def no_bad_loans(spark, sf_dir):
    """A threshold that no delay reaches is noticed, beside one that some reach."""
    loans = views.silver_loans(spark, sf_dir)
    found = [
        vintage.no_bad_loans(vintage.bad_rate_by_mob(loans, threshold)).select(F.lit(threshold).alias("threshold"), "no_bad_loans")
        for threshold in (30, 1_000_000)
    ]
    return found[0].unionByName(found[1])


EMPTY_MONTHS = ("1900-01-01", "1997-03-01")


@query(
    " UNION ALL ".join(
        f"""SELECT '{table}' AS layer, m.d snapshot_date, count(v.snapshot_date) n_rows
            FROM (SELECT unnest([DATE '1900-01-01', DATE '1997-03-01']) d) m LEFT JOIN {view} v ON v.snapshot_date = m.d GROUP BY ALL"""
        for table, view in (
            ("bronze.loans", "loans"), ("silver.loans", "silver_loans"), ("gold.feature_store", "applications"), ("gold.label_store", "labels_a1"),
        )
    ),
    dates="snapshot_date", ints="n_rows",
)
def empty_snapshot(spark, sf_dir):
    """A raw file with a header only goes through all layers beside a month with rows: its tables are there and empty."""
    loans, folder = views.as_text(views.loans(spark, sf_dir)), scratch_path(spark, "raw-months")
    held = None
    for month in EMPTY_MONTHS:
        path = f"{folder}/{month}"
        raw.write_csv(loans.where(F.col("snapshot_date") == month), path)
        part = raw.read_raw(spark, path, loans.schema)
        held = part if held is None else held.unionByName(part)
    layout = datamart.run(spark, {"loans": held}, scratch_path(spark, "datamart"), EMPTY_MONTHS)
    months = spark.createDataFrame([(m,) for m in EMPTY_MONTHS], "d string").select(F.col("d").cast("date").alias("snapshot_date"))
    counts = datamart.layer_counts(spark, layout, ["loans"])
    named = [
        months.join(counts.where(F.col("layer") == layer), "snapshot_date", "left").select(
            F.lit(layer).alias("layer"), "snapshot_date", F.coalesce("n_rows", F.lit(0)).alias("n_rows")
        )
        for layer in ("bronze.loans", "silver.loans", "gold.feature_store", "gold.label_store")
    ]
    return profile.union_by_name(named)
