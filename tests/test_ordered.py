import numpy as np
import pytest
from pyspark.sql import functions as F

import workload.catalog  # noqa: F401
from loanmart import session
from loanmart.operators import drift, evaluate, ordered, profile
from tools.check_queries import compare, duck
from workload.registry import ORACLES, QUERIES


def frame(spark, **columns):
    rows = list(zip(*columns.values()))
    kinds = ", ".join(f"{c} double" for c in columns)
    return spark.createDataFrame([tuple(None if v is None else float(v) for v in r) for r in rows], kinds)


def samples():
    rng = np.random.default_rng(3)
    return {
        "smooth": rng.normal(size=1000),
        "ties": rng.integers(0, 7, 1000),
        "hot": np.where(rng.random(1000) < 0.4, 5.0, rng.random(1000)),
        "flat": np.full(1000, 2.0),
    }


def test_quantiles_match_numpy(spark):
    data = samples()
    probabilities = [0, 0.1, 0.25, 1 / 3, 0.5, 0.9, 1]
    got = {
        r["feature"]: r["q_n"]
        for r in ordered.exact_quantiles(frame(spark, **data), list(data), probabilities).collect()
    }
    for name, x in data.items():
        assert got[name] == pytest.approx(np.quantile(x, probabilities), rel=1e-12)


def test_quantiles_leave_out_missing_values(spark):
    df = frame(spark, x=[1, None, 3, float("nan"), 2])
    assert ordered.exact_quantiles(df, ["x"], [0, 0.5, 1]).first()["q_n"] == [1.0, 2.0, 3.0]
    assert ordered.exact_quantiles(df.where("false"), ["x"], [0.5]).count() == 0


@pytest.fixture(autouse=True)
def small_slices(monkeypatch):
    """At most 50 values a slice, so that totals are carried across many."""
    monkeypatch.setattr(ordered, "ROWS_PER_SLICE", 50)


SLICED = (
    "auc_roc auc_pr psi_quantile psi_reference_edges ks_statistic ks_pvalue drift_summary boxplot_stats "
    "application_profile income_bands monitor_matched"
).split()


@pytest.mark.parametrize("name", SLICED)
def test_sliced_queries_match_sql_over_many_slices(spark, monkeypatch, name):
    if name in ("auc_roc", "auc_pr", "income_bands"):  # fewer distinct values
        monkeypatch.setattr(ordered, "ROWS_PER_SLICE", 8)
    used = []
    plain = ordered.spread

    def counted(*arguments):
        used.append(plain(*arguments))
        return used[-1]

    for module in (ordered, drift, evaluate, profile):
        if hasattr(module, "spread"):
            monkeypatch.setattr(module, "spread", counted)
    folder = "/root/testdata/sf0.001"
    assert compare(QUERIES[name](spark, folder), duck(folder), ORACLES[name]) == ""
    assert used and all(u.select(ordered.SLICE).distinct().count() >= 5 for u in used)


def test_written_tables_are_released(spark):
    mark = session.written_so_far(spark)
    before = session.cut_lineage(spark.range(3))
    later = session.written_so_far(spark)
    ordered.exact_quantiles(frame(spark, x=range(200)), ["x"], [0.5]).collect()
    assert session.release(spark, later) > 0 and before.count() == 3
    assert session.release(spark, mark) == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND|not exist"):
        spark.read.parquet(before.inputFiles()[0]).count()


def test_running_totals_over_many_slices(spark):
    values = np.random.default_rng(0).permutation(5000)
    df = spark.createDataFrame([(int(v) % 3, int(v), 1 + int(v) % 5) for v in values], "g int, v int, n int")
    sliced = ordered.spread(df, ["g"], "v")
    assert sliced.select(ordered.SLICE).distinct().count() >= 5
    totals = ordered.with_running_totals(sliced, ["g"], "v", ["n"]).toPandas()
    for _, part in totals.sort_values("v").groupby("g"):
        assert (part["n"].cumsum() == part["cum_n"]).all()
        assert (part["total_n"] == part["n"].sum()).all()


def test_slices_do_not_split_a_group_out_of_order(spark):
    """With small partitions forced, slices follow the order of the values."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(1000).select(F.lit("a").alias("g"), F.col("id").alias("v"), F.lit(1).alias("n"))
        sliced = ordered.spread(df, ["g"], "v")
        bounds = sorted(
            (r[0], r[1], r[2])
            for r in sliced.groupBy(ordered.SLICE).agg(F.min("v"), F.max("v")).collect()
        )
        assert len(bounds) > 1
        assert all(left[2] < right[1] for left, right in zip(bounds, bounds[1:]))
        last = ordered.with_running_totals(sliced, ["g"], "v", ["n"]).where("v = 999").first()
        assert last.cum_n == 1000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def brute_areas(score, label):
    order = np.argsort(-score, kind="stable")
    score, label = score[order], label[order]
    ends = np.r_[np.nonzero(np.diff(score))[0], len(score) - 1]
    tp, fp = np.cumsum(label)[ends], np.cumsum(1 - label)[ends]
    roc = np.trapezoid(np.r_[0, tp / tp[-1]], np.r_[0, fp / fp[-1]])
    precision = tp / (tp + fp)
    pr = np.trapezoid(np.r_[precision[0], precision], np.r_[0, tp / tp[-1]])
    return roc, pr


@pytest.mark.parametrize("decimals", [0, 1, 6])
def test_areas_match_brute_force_and_the_evaluator(spark, decimals):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rng = np.random.default_rng(decimals)
    label = (rng.random(800) < 0.3).astype(int)
    score = np.round(rng.normal(size=800) + label, decimals) + 0.0  # no negative zeros
    df = spark.createDataFrame(
        [(float(s), int(y)) for s, y in zip(score, label)], "score double, label int"
    )
    got = evaluate.evaluate_scores(df).first()
    assert (got.auc_roc, got.auc_pr) == pytest.approx(brute_areas(score, label), abs=1e-12)
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    assert evaluator.evaluate(df) == pytest.approx(got.auc_roc, abs=1e-9)
    evaluator.setMetricName("areaUnderPR")
    assert evaluator.evaluate(df) == pytest.approx(got.auc_pr, abs=1e-9)
    flipped = evaluate.evaluate_scores(df.withColumn("score", -F.col("score"))).first()
    assert flipped.auc_roc == pytest.approx(1 - got.auc_roc, abs=1e-12)


def test_areas_without_positives_are_null(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 0)], "score double, label int")
    assert evaluate.evaluate_scores(df).first() == (None, None)


def test_boxplot(spark):
    x = np.r_[np.random.default_rng(1).normal(size=300), 40.0, -30.0]
    got = profile.boxplot_stats(frame(spark, x=x), ["x"]).first()
    q1, q3 = np.quantile(x, [0.25, 0.75])
    inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
    assert (got.q1, got.q3) == pytest.approx((q1, q3))
    assert (got.whisker_low, got.whisker_high) == (inside.min(), inside.max())
    assert got.n_outliers == len(x) - len(inside)


def test_histogram_has_empty_bins(spark):
    x = np.r_[np.zeros(5), np.full(3, 10.0)]
    got = profile.histogram(frame(spark, x=x), "x", 4).orderBy("bin").collect()
    assert [r.n for r in got] == [5, 0, 0, 3]
    assert (got[0].low, got[-1].high) == (0.0, 10.0)


def test_value_counts_leave_out_wide_columns(spark, rows):
    df = spark.createDataFrame([(str(i), "a" if i % 2 else None) for i in range(20)], "id string, k string")
    assert rows(profile.value_counts(df, ["id", "k"])) == [("k", "a", 10)]
    assert profile.value_counts(df, ["id", "k"], None).count() == 21
