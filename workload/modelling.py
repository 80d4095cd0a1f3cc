"""Splits, models, evaluation, scoring."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from loanmart.operators import evaluate, model, score, split
from loanmart.plans import training
from loanmart.session import cut_lineage, scratch_path
from loanmart.sources import registry
from workload import views
from workload.drifting import SCORES, scores
from workload.gold import FEATURES, flat_loans, gold_by_state, kept_flat_loans
from workload.registry import query

SMALL_GRID = [model.Candidate("LogisticRegression", 0.01), model.Candidate("RandomForest", 6)]


@query(
    """SELECT loan_id, mob, snapshot_date,
              CASE WHEN snapshot_date >= (SELECT d FROM cutoff) THEN 'oot' ELSE 'historical' END part
       FROM silver_loans""",
    dates="snapshot_date",
)
def oot_split(spark, sf_dir):
    """The newest three months apart."""
    rows = split.with_oot_part(views.silver_loans(spark, sf_dir))
    return rows.select("loan_id", "mob", "snapshot_date", "part")


@query(
    """SELECT loan_id, mob, CASE WHEN u < 0.70 THEN 'train' WHEN u < 0.85 THEN 'val' ELSE 'test' END split
       FROM (SELECT loan_id, mob, cast('0x' || substr(md5(loan_id || '|' || mob), 1, 8) AS bigint) / 4294967296.0 u
             FROM silver_loans)""",
)
def hash_split(spark, sf_dir):
    """70/15/15 by the hash of the row key."""
    rows = split.with_hash_split(views.silver_loans(spark, sf_dir), "loan_id", "mob")
    return rows.select("loan_id", "mob", "split")


@query(
    """SELECT loan_id, loan_amt / (SELECT stddev_samp(loan_amt) FROM applications) loan_amt_scaled,
              tenure / (SELECT stddev_samp(tenure) FROM applications) tenure_scaled FROM applications""",
    rounded="loan_amt_scaled tenure_scaled",
)
def standard_scale(spark, sf_dir):
    rows = model.standard_scaled(views.applications(spark, sf_dir), ["loan_amt", "tenure"])
    return rows.select("loan_id", "loan_amt_scaled", "tenure_scaled")


CURVE = {
    **SCORES,
    "steps": """
        SELECT score, sum(label) tp, count(*) - sum(label) fp,
               sum(sum(label)) OVER w ctp, sum(count(*) - sum(label)) OVER w cfp
        FROM scores GROUP BY score WINDOW w AS (ORDER BY score DESC)""",
    "totals": "SELECT sum(label) p, count(*) - sum(label) n FROM scores",
}


@query(
    "SELECT sum(cast(fp AS double) * (ctp - tp / 2)) / any_value(cast(p AS double) * n) auc_roc FROM steps, totals",
    rounded="auc_roc", views=CURVE,
)
def auc_roc(spark, sf_dir):
    """Area under the ROC curve, tied scores as one step."""
    return evaluate.evaluate_scores(scores(spark, sf_dir)).select("auc_roc")


@query(
    """SELECT sum(tp / p * (prec + coalesce(lag_prec, prec)) / 2) auc_pr FROM
         (SELECT *, lag(prec) OVER (ORDER BY score DESC) lag_prec FROM
            (SELECT *, ctp / (ctp + cfp) prec FROM steps, totals))""",
    rounded="auc_pr", views=CURVE,
)
def auc_pr(spark, sf_dir):
    """Area under the precision-recall curve."""
    return evaluate.evaluate_scores(scores(spark, sf_dir)).select("auc_pr")


@query(
    """SELECT loan_id, coalesce(try_cast(tenure AS double), 0) tenure,
              coalesce(try_cast(loan_amt AS double), 0) loan_amt, 0.0::double fe_99
       FROM (SELECT loan_id, tenure, loan_amt FROM silver_loans)""",
    rounded="tenure loan_amt fe_99",
)
def schema_guard(spark, sf_dir):
    """Columns a model wants: missing ones added, all double."""
    rows = views.silver_loans(spark, sf_dir).select(
        "loan_id", F.col("tenure").cast("string").alias("tenure"), "loan_amt"
    )
    return score.ensure_columns(rows, ["tenure", "loan_amt", "fe_99"])


@query("SELECT loan_id, tenure, tenure term, mob FROM silver_loans")
def map_equivalents(spark, sf_dir):
    """A missing column copied from its equivalent; one that is present is left alone."""
    rows = views.silver_loans(spark, sf_dir).select("loan_id", "tenure", "mob")
    return score.map_equivalents(rows, {"term": "tenure", "mob": "tenure", "x": "absent"})


@query("SELECT customer_id, score prediction FROM scores", rounded="prediction", views=SCORES)
def available_projection(spark, sf_dir):
    """Those of the output columns that exist."""
    rows = scores(spark, sf_dir).withColumnRenamed("score", "prediction")
    return score.available(rows, score.PREDICTION_COLUMNS)


def _training_rows(spark, sf_dir):
    """Gold rows with a key to split by; the label is the customer's outcome of the month."""
    return gold_by_state(spark, sf_dir, kept_flat_loans(spark, sf_dir))


KEY = ("customer_id", "snapshot_date", "loan_amt", "mob")


INPUTS = f"{FEATURES} tenure mob".split()


@query(
    "SELECT customer_id, snapshot_date, "
    + ", ".join(f"cast(coalesce({c}, 0) AS double) v_{c}" for c in INPUTS)
    + " FROM gold_a2",
    rounded=[f"v_{c}" for c in INPUTS], dates="snapshot_date",
)
def assemble(spark, sf_dir):
    """Feature vectors, shown element by element."""
    rows, names = model.prepared(_training_rows(spark, sf_dir))
    vectors = model.assembler(names).transform(rows).select(
        "customer_id", "snapshot_date", vector_to_array("features_raw").alias("v")
    )
    return vectors.select(
        "customer_id", "snapshot_date", *[F.col("v")[i].alias(f"v_{c}") for i, c in enumerate(names)]
    )


# the split of a customer's month, as hash_split does it, and one 0/1 column to learn from
SIMPLE = {
    "simple": """
        SELECT CASE WHEN snapshot_date >= (SELECT d FROM cutoff) THEN 'oot' WHEN u < 0.70 THEN 'train'
                    WHEN u < 0.85 THEN 'val' ELSE 'test' END part, x, y, label
        FROM (SELECT snapshot_date, label, CASE WHEN tenure = 6 THEN 1.0 ELSE 0.0 END::double x,
                     CASE WHEN cast(customer_id AS bigint) % 4 = 0 THEN 1.0 - label ELSE label END::double y,
                     cast('0x' || substr(md5(customer_id || '|' || snapshot_date), 1, 8) AS bigint) / 4294967296.0 u
              FROM gold_a2)""",
    "sizes": """
        SELECT count(*) FILTER (part = 'train') train_rows, count(*) FILTER (part = 'val') val_rows,
               count(*) FILTER (part = 'test') hist_test_rows, count(*) FILTER (part = 'oot') oot_rows FROM simple""",
    "shares": "SELECT x, avg(cast(label AS double)) p FROM simple WHERE part = 'train' GROUP BY x",
    "leaves": "SELECT y x, avg(cast(label AS double)) p FROM simple WHERE part = 'train' GROUP BY y",
}
SIMPLE_KEY = ("customer_id", "snapshot_date")
SIZES = "train_rows val_rows hist_test_rows oot_rows"


def _simple_model(spark, sf_dir, candidate, condition):
    """The training job on one 0/1 column."""
    rows = _training_rows(spark, sf_dir).select(*SIMPLE_KEY, F.expr(condition).cast("double").alias("x"), "label")
    return training.train(rows, SIMPLE_KEY, [candidate], trees=1)


@query(
    """SELECT sizes.*, ln(p0 / (1 - p0)) intercept, ln(p1 / (1 - p1)) - ln(p0 / (1 - p0)) coefficient
       FROM sizes, (SELECT max(CASE WHEN x = 0 THEN p END) p0, max(CASE WHEN x = 1 THEN p END) p1 FROM shares)""",
    rounded="intercept coefficient", digits=3, views=SIMPLE,
)
def train_lr(spark, sf_dir):
    """Logistic regression without penalty: on one 0/1 column its coefficients are log odds."""
    best = _simple_model(spark, sf_dir, model.Candidate("LogisticRegression", 0.0), "tenure = 6")
    _, scaler, fitted = best.model.stages
    return best.metrics.select(
        *SIZES.split(),
        F.lit(float(fitted.intercept)).alias("intercept"),
        F.lit(float(fitted.coefficients[0] / scaler.std[0])).alias("coefficient"),
    )


@query("SELECT x, p probability_bad FROM leaves", rounded="x probability_bad", views=SIMPLE)
def train_rf(spark, sf_dir):
    """One tree of depth 1: on one 0/1 column its leaves are the shares of the training part."""
    best = _simple_model(spark, sf_dir, model.Candidate("RandomForest", 1), "IF(CAST(customer_id AS bigint) % 4 = 0, 1 - label, label)")
    both = spark.range(2).select(F.col("id").cast("double").alias("x"))
    scored = score.score_batch(best.model, both, columns=["x", "probability"])
    return scored.select("x", vector_to_array("probability")[1].alias("probability_bad"))


SPLIT = {
    "simple": """
        SELECT CASE WHEN snapshot_date >= (SELECT d FROM cutoff) THEN 'oot' WHEN u < 0.70 THEN 'train'
                    WHEN u < 0.85 THEN 'val' ELSE 'test' END part
        FROM (SELECT snapshot_date,
                     cast('0x' || substr(md5(customer_id || '|' || snapshot_date), 1, 8) AS bigint) / 4294967296.0 u
              FROM gold_a2)""",
    "sizes": SIMPLE["sizes"],
}


@query(
    """SELECT sizes.*, 5 n_candidates, true best_chosen, true areas_valid, true rows_recorded FROM sizes""",
    ints="n_candidates", views=SPLIT,
)
def champion(spark, sf_dir):
    """The whole grid: sizes of the parts, and whether the best recorded area won and was published."""
    bank = scratch_path(spark, "model-bank")
    best = training.train(_training_rows(spark, sf_dir), SIMPLE_KEY)
    training.publish(spark, best, bank, "20250101_000000")
    areas = [area for _, area in best.areas]
    stored = spark.read.parquet(f"{bank}/metrics")
    won = dict(best.areas)[best.candidate] == max(areas) and best.candidate == max(best.areas, key=lambda a: a[1])[0]
    fair = F.lit(max(areas)) == F.col("val_auc")
    for name in ("val_auc", "hist_test_auc", "hist_test_pr", "oot_auc", "oot_pr"):
        fair = fair & F.col(name).between(0, 1)
    named = (F.col("model") == best.candidate.name) & (F.col("best_param") == float(best.candidate.parameter))
    return stored.select(
        *SIZES.split(), F.lit(len(areas)).alias("n_candidates"), F.lit(won).alias("best_chosen"),
        fair.alias("areas_valid"), named.alias("rows_recorded"),
    )


def _published(spark, sf_dir, rows=None):
    bank = scratch_path(spark, "model-bank")
    best = training.train(_training_rows(spark, sf_dir) if rows is None else rows, KEY, SMALL_GRID[:1])
    training.publish(spark, best, bank, "20250101_000000")
    return best.model, bank


@query(
    "SELECT customer_id, snapshot_date, mob, true same, true consistent FROM gold_a2", dates="snapshot_date"
)
def model_roundtrip(spark, sf_dir):
    """A model saved, registered, found again and loaded: every row scored, by both alike."""
    rows = cut_lineage(_training_rows(spark, sf_dir))  # the gold table is derived once, for training and for scoring
    fitted, bank = _published(spark, sf_dir, rows)
    loaded = registry.load_latest_model(spark, bank, "LogisticRegression")
    keys = ["customer_id", "snapshot_date", "mob"]
    bad = vector_to_array("probability")[1]
    first = score.score_batch(fitted, rows, columns=[*INPUTS, *keys[:2], "probability"])
    first = first.withColumn("p_fitted", bad).drop("probability")
    scored = score.score_batch(loaded, first, columns=[*keys, "p_fitted", "probability", "prediction"])
    return scored.select(
        *keys, (bad == F.col("p_fitted")).alias("same"), ((F.col("prediction") == 1) == (bad > 0.5)).alias("consistent")
    )


@query(
    "SELECT customer_id, loan_id, snapshot_date, true consistent, 0 n_missing FROM flat_loans",
    dates="snapshot_date", ints="n_missing",
)
def score_batch(spark, sf_dir):
    """Scored loan states, one row for each; the click and customer columns are absent and filled."""
    _, bank = _published(spark, sf_dir)
    loaded = registry.load_latest_model(spark, bank)
    columns = ["customer_id", "loan_id", "snapshot_date", "prediction", "probability"]
    scored = score.score_batch(loaded, flat_loans(spark, sf_dir), columns=columns, nulls="keep")
    bad = vector_to_array("probability")[1]
    return scored.select(
        *columns[:3], ((F.col("prediction") == 1) == (bad > 0.5)).alias("consistent"),
        F.col("missing_inputs").alias("n_missing"),
    )


@query(
    """SELECT customer_id, snapshot_date, mob, n_missing, n_missing > 0 unscored FROM
         (SELECT *, """ + " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in INPUTS) + """ n_missing FROM gold_a2)""",
    dates="snapshot_date", ints="n_missing",
)
def score_with_gaps(spark, sf_dir):
    """Rows with missing inputs leave with a null prediction and the number of gaps."""
    _, bank = _published(spark, sf_dir)
    loaded = registry.load_latest_model(spark, bank)
    columns = ["customer_id", "snapshot_date", "mob", "prediction"]
    scored = score.score_batch(loaded, _training_rows(spark, sf_dir), columns=columns, nulls="keep")
    return scored.select(
        *columns[:3], F.col("missing_inputs").alias("n_missing"), F.col("prediction").isNull().alias("unscored")
    )


@query(
    "SELECT * FROM (VALUES " + ", ".join(f"({i}, '{c}')" for i, c in enumerate(
        "loan_amt tenure mob monthly_inhand_salary annual_income interest_rate num_of_loan outstanding_debt "
        "total_emi_per_month credit_utilization_ratio age fe_1 fe_2 fe_3 fe_4 fe_5".split()
    )) + ") t(place, input)", ints="place"
)
def model_inputs(spark, sf_dir):
    """What a loaded model expects, in order."""
    _, bank = _published(spark, sf_dir)
    names = score.expected_inputs(registry.load_latest_model(spark, bank))
    return spark.range(1).select(F.posexplode(F.array(*[F.lit(n) for n in names])).alias("place", "input"))


@query("SELECT count(*) n_rows, count(*) n_split, true shares_near FROM silver_loans", ints="n_rows n_split")
def random_split(spark, sf_dir):
    """70/15/15 by a seeded draw: every row in one part, the parts about as large as wanted."""
    rows = split.with_random_split(views.silver_loans(spark, sf_dir))
    parts = [F.count_if(F.col("split") == name) for name in ("train", "val", "test")]
    off = [F.abs(n / F.count("*") - share) < 0.05 for n, share in zip(parts, (0.70, 0.15, 0.15))]
    return rows.agg(
        F.count("*").alias("n_rows"), (parts[0] + parts[1] + parts[2]).alias("n_split"), (off[0] & off[1] & off[2]).alias("shares_near")
    )
