"""Drift between the historical months and the newest three."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanmart.operators import drift, model
from loanmart.operators.split import oot_cutoff
from loanmart.plans import monitoring, scoring, training
from loanmart.session import cut_lineage, scratch_path
from loanmart.sources import tables
from workload import views
from workload.gold import FEATURES as GOLD_INPUTS, gold_by_state, kept_flat_loans
from workload.registry import query

# what is numeric in silver loans, in its columns' order
FEATURES = (
    "tenure installment_num loan_amt due_amt paid_amt overdue_amt balance mob installments_missed dpd"
).split()

SIDED = {
    "sided": f"""
        SELECT {', '.join(f'cast({f} AS double) {f}' for f in FEATURES)},
               CASE WHEN snapshot_date >= (SELECT d FROM cutoff) THEN 'cur' ELSE 'ref' END side
        FROM silver_loans""",
    "lng": f"SELECT side, feature, value FROM sided UNPIVOT (value FOR feature IN ({', '.join(FEATURES)}))",
}
PSI_TAIL = {
    "shares": """
        SELECT g.feature, g.bin, coalesce(r.n, 0) / tr.n r, coalesce(c.n, 0) / tc.n c
        FROM (SELECT feature, unnest(range(0, 12)) bin FROM (SELECT DISTINCT feature FROM lng)) g
        LEFT JOIN (SELECT feature, bin, count(*) n FROM binned WHERE side = 'ref' GROUP BY 1, 2) r
          ON g.feature = r.feature AND g.bin = r.bin
        LEFT JOIN (SELECT feature, bin, count(*) n FROM binned WHERE side = 'cur' GROUP BY 1, 2) c
          ON g.feature = c.feature AND g.bin = c.bin
        JOIN (SELECT feature, count(*) n FROM lng WHERE side = 'ref' GROUP BY 1) tr ON tr.feature = g.feature
        JOIN (SELECT feature, count(*) n FROM lng WHERE side = 'cur' GROUP BY 1) tc ON tc.feature = g.feature""",
}
DECILES = "[0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]"
MINMAX = {
    **SIDED,
    "binned": """
        SELECT feature, side, CASE WHEN hi = lo THEN 5
               ELSE least(9, len(list_filter(range(0, 11), lambda i: i * (((hi - lo) / (hi - lo + 1e-8)) / 10)
                                                                <= (value - lo) / (hi - lo + 1e-8))) - 1) END bin
        FROM lng JOIN (SELECT feature, side, min(value) lo, max(value) hi FROM lng GROUP BY 1, 2)
          USING (feature, side)""",
    **PSI_TAIL,
}
OWN = {
    **SIDED,
    "edges": f"SELECT feature, side, quantile_cont(value, {DECILES}) e FROM lng GROUP BY 1, 2",
    "binned": """
        SELECT feature, side, greatest(1, least(10, len(list_filter(e, lambda x: x < value)))) bin
        FROM lng JOIN edges USING (feature, side)""",
    **PSI_TAIL,
}
REFERENCE = {
    **SIDED,
    "edges": f"SELECT feature, quantile_cont(value, {DECILES}) e FROM lng WHERE side = 'ref' GROUP BY 1",
    "binned": """
        SELECT feature, side, greatest(1, least(10, len(list_filter(e, lambda x: x < value)))) bin
        FROM lng JOIN edges USING (feature)""",
    **PSI_TAIL,
}
KS = {
    "steps": """
        SELECT feature, value, sum(count(*) FILTER (side = 'ref')) OVER w r,
               sum(count(*) FILTER (side = 'cur')) OVER w c
        FROM lng GROUP BY feature, value
        WINDOW w AS (PARTITION BY feature ORDER BY value)""",
    "ks": """
        SELECT feature, max(abs(r / n_ref - c / n_cur)) ks_stat, n_ref, n_cur
        FROM steps JOIN (SELECT feature, count(*) FILTER (side = 'ref') n_ref,
                                count(*) FILTER (side = 'cur') n_cur FROM lng GROUP BY 1) USING (feature)
        GROUP BY feature, n_ref, n_cur""",
    "tested": """
        SELECT feature, ks_stat, n_ref, n_cur, CASE WHEN lam < 0.2 THEN 1.0::double ELSE greatest(0.0::double,
               least(1.0::double, 2 * list_sum(list_transform(range(1, 101),
                 lambda k: (CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END) * exp(-2.0 * k * k * lam * lam))))) END ks_pvalue
        FROM (SELECT *, sqrt(cast(n_ref AS double) * n_cur / (n_ref + n_cur)) * ks_stat lam FROM ks)""",
}
METRICS = {
    **REFERENCE,
    **KS,
    "psi_ref": """
        SELECT feature, sum((c - r) * ln((c + 1e-6) / (r + 1e-6))) psi FROM shares GROUP BY 1""",
    "metrics": "SELECT feature, psi, ks_stat, ks_pvalue FROM psi_ref JOIN tested USING (feature)",
}


def kept_loans(spark, sf_dir, *columns):
    """Silver loans with these columns, written once: the newest months and both sides are found in them."""
    return cut_lineage(views.silver_loans(spark, sf_dir).select(*FEATURES, "snapshot_date", *columns))


def sided(spark, sf_dir):
    """Historical months against the newest three, over all numeric columns they share."""
    loans = kept_loans(spark, sf_dir)
    newest = F.col("snapshot_date") >= oot_cutoff(loans)
    return drift.two_sided(loans.where(~newest), loans.where(newest))


def _psi_sql(epsilon: str) -> str:
    return (
        f"SELECT feature, sum((c - r) * ln((c + {epsilon}) / (r + {epsilon}))) psi FROM shares GROUP BY 1"
    )


@query(_psi_sql("1e-8"), rounded="psi", views=MINMAX)
def psi_minmax(spark, sf_dir):
    """PSI with each side scaled by its own range."""
    return drift.psi_minmax(sided(spark, sf_dir), FEATURES)


@query(_psi_sql("1e-6"), rounded="psi", views=OWN)
def psi_quantile(spark, sf_dir):
    """PSI with each side cut at its own deciles."""
    return drift.psi_own_quantiles(drift.sliced_values(sided(spark, sf_dir), FEATURES))


@query(_psi_sql("1e-6"), rounded="psi", views=REFERENCE)
def psi_reference_edges(spark, sf_dir):
    """PSI with both sides cut at the reference's deciles."""
    return drift.psi_reference_quantiles(drift.sliced_values(sided(spark, sf_dir), FEATURES))


@query(_psi_sql("1e-6"), rounded="psi", views=OWN)
def psi_quantile_refined(spark, sf_dir):
    """PSI with each side cut at its own deciles, found without ordering any values."""
    return drift.psi_refined(sided(spark, sf_dir), FEATURES, own=True)


@query(_psi_sql("1e-6"), rounded="psi", views=REFERENCE)
def psi_reference_refined(spark, sf_dir):
    """PSI with both sides cut at the reference's deciles, found without ordering any values."""
    return drift.psi_refined(sided(spark, sf_dir), FEATURES)


@query("SELECT feature, ks_stat, n_ref, n_cur FROM ks", rounded="ks_stat", views={**SIDED, **KS})
def ks_statistic(spark, sf_dir):
    return drift.ks_statistic(drift.sliced_values(sided(spark, sf_dir), FEATURES))


@query("SELECT feature, ks_pvalue FROM tested", rounded="ks_pvalue", views={**SIDED, **KS})
def ks_pvalue(spark, sf_dir):
    slices = drift.sliced_values(sided(spark, sf_dir), FEATURES)
    return drift.ks_test(slices).select("feature", "ks_pvalue")


@query(
    """SELECT feature, n_ref, n_cur, CASE WHEN n_ref >= 10 AND n_cur >= 10 THEN 1 ELSE 0 END compared FROM
         (SELECT f.feature, count(*) FILTER (side = 'ref' AND value IS NOT NULL) n_ref,
                 count(*) FILTER (side = 'cur' AND value IS NOT NULL) n_cur
          FROM (SELECT unnest([""" + ", ".join(f"'{f}'" for f in FEATURES) + """]) feature) f
          LEFT JOIN lng ON lng.feature = f.feature GROUP BY 1)""",
    views=SIDED,
)
def drift_features(spark, sf_dir):
    """Which features have enough values on both sides."""
    return drift.feature_counts(sided(spark, sf_dir), FEATURES)


@query(
    """SELECT 'drift' outcome, feature, psi, ks_pvalue FROM metrics WHERE psi > 0.2 OR ks_pvalue < 0.05
       UNION ALL SELECT CASE WHEN count(*) = 0 THEN 'no drift' ELSE 'stable' END, NULL, NULL, NULL FROM metrics
       HAVING count(*) FILTER (psi > 0.2 OR ks_pvalue < 0.05) = 0""",
    rounded="psi ks_pvalue", views=METRICS,
)
def drift_alerts(spark, sf_dir):
    metrics = drift.drift_metrics(sided(spark, sf_dir), FEATURES)
    return drift.drift_alerts(metrics)


SCORES = {
    "scores": """
        SELECT customer_id, snapshot_date, loan_id, floor(loan_amt / 10000 + mob) / 10 score,
               CASE WHEN dpd >= 30 THEN 1 ELSE 0 END label FROM silver_loans""",
}
MVR = {
    **SCORES,
    "mvr": """
        SELECT count(*) n_rows, coalesce(sum(CASE WHEN score - before > 0 THEN 1 ELSE 0 END), 0) n_violations
        FROM (SELECT *, lag(score) OVER (PARTITION BY customer_id ORDER BY snapshot_date, md5(loan_id)) AS before
              FROM scores)""",
}


def scores(spark, sf_dir):
    """Scored loans with many ties and their outcome."""
    loans = views.silver_loans(spark, sf_dir)
    score = F.floor(F.col("loan_amt") / 10000 + F.col("mob")) / F.lit(10.0)
    label = F.when(F.col("dpd") >= 30, 1).otherwise(0)
    return loans.select(
        "customer_id", "snapshot_date", "loan_id", score.alias("score"), label.alias("label")
    )


@query(
    "SELECT n_rows, n_violations, n_violations / n_rows mvr FROM mvr",
    rounded="mvr", ints="n_rows n_violations", views=MVR,
)
def monotonicity_violation(spark, sf_dir):
    """Share of scores above the customer's score before."""
    rows = scores(spark, sf_dir)
    return drift.monotonicity_violation_rate(
        rows, "customer_id", "snapshot_date", "loan_id", "score"
    )


@query(
    """SELECT count(*) num_features, count(*) FILTER (psi > 0.25) num_drifted_features,
              avg(psi) avg_psi, avg(ks_stat) avg_ks, (SELECT n_violations / n_rows FROM mvr) mvr FROM metrics""",
    rounded="avg_psi avg_ks mvr", ints="num_features num_drifted_features", views={**METRICS, **MVR},
)
def drift_summary(spark, sf_dir):
    metrics = drift.drift_metrics(sided(spark, sf_dir), FEATURES)
    violations = drift.monotonicity_violation_rate(
        scores(spark, sf_dir), "customer_id", "snapshot_date", "loan_id", "score"
    )
    return drift.drift_summary(metrics, violations)


PREDICTIONS = {
    **SCORES,
    "latest_scores": """
        SELECT customer_id, max(score) prediction, max(snapshot_date) snapshot_date
        FROM scores GROUP BY 1""",
}


@query(
    """SELECT s.customer_id, s.loan_id, s.mob, s.snapshot_date snapshot_date_ref,
              p.snapshot_date snapshot_date_pred, prediction
       FROM silver_loans s JOIN latest_scores p ON s.customer_id = p.customer_id""",
    rounded="prediction", dates="snapshot_date_ref snapshot_date_pred", views=PREDICTIONS,
)
def monitor_join(spark, sf_dir):
    """Reference rows with the one prediction of their customer."""
    reference = views.silver_loans(spark, sf_dir).select(
        "customer_id", "loan_id", "mob", "snapshot_date"
    )
    predictions = scores(spark, sf_dir).groupBy("customer_id").agg(
        F.max("score").alias("prediction"), F.max("snapshot_date").alias("snapshot_date")
    )
    return drift.monitor_join(reference, predictions)


WEIGHTED = {
    "matched": """
        SELECT s.* FROM silver_loans s
        JOIN (SELECT * FROM silver_loans WHERE snapshot_date >= (SELECT d FROM cutoff)) p
          ON s.customer_id = p.customer_id""",
    "sided": " UNION ALL ".join(
        f"SELECT {', '.join(f'cast({f} AS double) {f}' for f in FEATURES)}, '{side}' side FROM {table}"
        for side, table in (("ref", "silver_loans"), ("cur", "matched"))
    ),
    "lng": SIDED["lng"],
    **{name: text for name, text in METRICS.items() if name not in SIDED},
}


@query(
    """SELECT feature, psi, m.ks_stat, n_ref, n_cur, m.ks_pvalue FROM metrics m JOIN tested USING (feature)""",
    rounded="psi ks_stat ks_pvalue", ints="n_ref n_cur", views=WEIGHTED,
)
def monitor_matched(spark, sf_dir):
    """Reference against its rows as paired with many predictions per customer, by weights.

    The SQL forms the pairs; Spark carries their number instead.
    """
    loans = kept_loans(spark, sf_dir, "customer_id")
    reference = loans.drop("snapshot_date")
    predictions = loans.where(F.col("snapshot_date") >= oot_cutoff(loans)).select("customer_id")
    sample, names, weight = monitoring.matched_sample(reference, predictions)
    metrics = drift.drift_metrics(sample, names, weight=weight)
    counts = drift.feature_counts(sample, names, weight).select("feature", "n_ref", "n_cur")
    return metrics.join(counts, "feature").select("feature", "psi", "ks_stat", "n_ref", "n_cur", "ks_pvalue")


@query(
    """SELECT feature, psi, ks_stat, ks_pvalue, CASE WHEN psi > 0.25 THEN 1 ELSE 0 END psi_flag,
              CASE WHEN ks_pvalue < 0.05 THEN 1 ELSE 0 END ks_flag,
              CASE WHEN psi > 0.2 OR ks_pvalue < 0.05 THEN 1 ELSE 0 END alert FROM metrics""",
    rounded="psi ks_stat ks_pvalue", views=METRICS,
)
def monitor_report(spark, sf_dir):
    """The report job: metric, alert and summary tables appended, the metrics read back."""
    root = scratch_path(spark, "monitoring")
    violations = drift.monotonicity_violation_rate(
        scores(spark, sf_dir), "customer_id", "snapshot_date", "loan_id", "score"
    )
    monitoring.report(sided(spark, sf_dir), FEATURES, root, violations)
    return spark.read.parquet(f"{root}/metrics").drop("reported_at")


GOLD_FEATURES = f"{GOLD_INPUTS} tenure mob label".split()
STORED = {
    "reference": "SELECT * FROM gold_a2 WHERE snapshot_date >= (SELECT d FROM cutoff)",
    "newest": "SELECT customer_id FROM gold_a2 WHERE snapshot_date = (SELECT max(snapshot_date) FROM gold_a2)",
    "sided": " UNION ALL ".join(
        f"SELECT {', '.join(f'cast(coalesce({f}, 0) AS double) {f}' for f in GOLD_FEATURES)}, '{side}' side FROM {table}"
        for side, table in (("ref", "reference"), ("cur", "(SELECT r.* FROM reference r JOIN newest n ON r.customer_id = n.customer_id)"))
    ),
    "lng": f"SELECT side, feature, value FROM sided UNPIVOT (value FOR feature IN ({', '.join(GOLD_FEATURES)}))",
    **{name: text for name, text in METRICS.items() if name not in (*SIDED, "metrics")},
    "metrics": """SELECT feature, psi, ks_stat, ks_pvalue FROM psi_ref JOIN tested USING (feature)
                  WHERE n_ref >= 10 AND n_cur >= 10""",
}


@query(
    """SELECT 'metric' kind, feature, psi, ks_stat, ks_pvalue FROM metrics
       UNION ALL SELECT 'drift', feature, psi, NULL, ks_pvalue FROM metrics WHERE psi > 0.2 OR ks_pvalue < 0.05
       UNION ALL SELECT CASE WHEN count(*) = 0 THEN 'no drift' ELSE 'stable' END, NULL, NULL, NULL, NULL FROM metrics
       HAVING count(*) FILTER (psi > 0.2 OR ks_pvalue < 0.05) = 0
       UNION ALL SELECT 'summary', cast(count(*) AS varchar), avg(psi), avg(ks_stat), NULL FROM metrics""",
    rounded="psi ks_stat ks_pvalue", views=STORED,
)
def monitor_stored(spark, sf_dir):
    """From a stored gold table to alerts: train, publish, score the newest month, report; all tables read back."""
    root = scratch_path(spark, "monitoring")
    tables.write_snapshots(gold_by_state(spark, sf_dir, kept_flat_loans(spark, sf_dir)), f"{root}/gold")
    rows = tables.read_snapshots(spark, f"{root}/gold")
    grid = [model.Candidate("LogisticRegression", 0.01)]
    best = training.train(rows, ["customer_id", "snapshot_date"], grid, samples=f"{root}/samples")
    training.publish(spark, best, f"{root}/bank", "20250101_000000")
    scoring.run(spark, f"{root}/gold", f"{root}/bank", f"{root}/predictions")
    monitoring.run(spark, f"{root}/samples", f"{root}/gold", f"{root}/predictions", f"{root}/report")
    metrics, alerts, summary = (spark.read.parquet(f"{root}/report/{t}") for t in ("metrics", "alerts", "summary"))
    none = F.lit(None).cast("double")
    return (
        metrics.select(F.lit("metric").alias("kind"), "feature", "psi", "ks_stat", "ks_pvalue")
        .union(alerts.select("outcome", "feature", "psi", none, "ks_pvalue"))
        .union(summary.select(F.lit("summary"), F.col("num_features").cast("string"), "avg_psi", "avg_ks", none))
    )


ZEROS = {
    **SIDED,
    "zeros": f"""SELECT side, {', '.join(f'coalesce({f}, 0) {f}' for f in FEATURES)} FROM sided""",
}


@query(
    " UNION ALL ".join(
        f"SELECT '{f}' feature, count(*) FILTER (side = 'ref') n_ref, count(*) FILTER (side = 'cur') n_cur, "
        "CASE WHEN count(*) FILTER (side = 'ref') >= 10 AND count(*) FILTER (side = 'cur') >= 10 THEN 1 ELSE 0 END compared FROM zeros"
        for f in FEATURES
    ),
    ints="n_ref n_cur compared", views=ZEROS,
)
def drift_features_zero_filled(spark, sf_dir):
    """Missing values counted as 0: every row is known."""
    loans = views.silver_loans(spark, sf_dir)
    newest = F.col("snapshot_date") >= oot_cutoff(loans)
    return drift.feature_counts(drift.two_sided(loans.where(~newest), loans.where(newest), zero_fill=True), FEATURES)
