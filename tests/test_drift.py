import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanmart.operators import drift
from loanmart.plans import monitoring
import workload.catalog  # noqa: F401
from workload import drifting, profiles
from workload.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def sided(spark, ref, cur, **more):
    """Frame of one or more features with both sides."""
    pairs = {"x": (ref, cur), **more}
    tables = []
    for i, side in enumerate(("ref", "cur")):
        data = list(zip(*[p[i] for p in pairs.values()]))
        kinds = ", ".join(f"{f} double" for f in pairs)
        rows = [tuple(None if v is None else float(v) for v in r) for r in data]
        tables.append(spark.createDataFrame(rows, kinds).withColumn("side", F.lit(side)))
    return tables[0].unionByName(tables[1])


def np_psi(ref_share, cur_share, epsilon):
    return float(np.sum((cur_share - ref_share) * np.log((cur_share + epsilon) / (ref_share + epsilon))))


def np_psi_minmax(ref, cur):
    def share(x):
        scaled = (x - x.min()) / (x.max() - x.min() + 1e-8)
        return np.histogram(scaled, 10)[0] / len(x)

    return np_psi(share(ref), share(cur), 1e-8)


def np_psi_quantile(ref, cur, own):
    steps = np.linspace(0, 100, 11)

    def share(x, edges):
        bins = np.clip(np.digitize(x, edges, right=True), 1, 10)
        return np.bincount(bins, minlength=11) / len(x)

    ref_edges = np.percentile(ref, steps)
    cur_edges = np.percentile(cur, steps) if own else ref_edges
    return np_psi(share(ref, ref_edges), share(cur, cur_edges), 1e-6)


def np_ks(ref, cur):
    values = np.unique(np.r_[ref, cur])
    cdf = [np.searchsorted(np.sort(x), values, side="right") / len(x) for x in (ref, cur)]
    return float(np.max(np.abs(cdf[0] - cdf[1])))


def cases():
    rng = np.random.default_rng(11)
    smooth = rng.normal(size=600)
    return {
        "shifted": (smooth, rng.normal(0.5, 2, 400)),
        "ties": (rng.integers(0, 5, 600).astype(float), rng.integers(1, 9, 400).astype(float)),
        "hot": (np.where(rng.random(600) < 0.4, 0.0, smooth), rng.random(400)),
        "flat": (np.full(600, 3.0), rng.random(400)),
    }


@pytest.mark.parametrize("name", list(cases()))
def test_measures_match_numpy(spark, name):
    ref, cur = cases()[name]
    df = sided(spark, ref, cur)
    slices = drift.sliced_values(df, ["x"])

    def psi(table):
        return table.first()["psi"]

    assert psi(drift.psi_minmax(df, ["x"])) == pytest.approx(np_psi_minmax(ref, cur), abs=1e-9)
    assert psi(drift.psi_own_quantiles(slices)) == pytest.approx(
        np_psi_quantile(ref, cur, True), abs=1e-9
    )
    assert psi(drift.psi_reference_quantiles(slices)) == pytest.approx(
        np_psi_quantile(ref, cur, False), abs=1e-9
    )
    tested = drift.ks_test(slices).first()
    assert tested.ks_stat == pytest.approx(np_ks(ref, cur), abs=1e-12)
    lam = math.sqrt(600 * 400 / 1000) * tested.ks_stat
    series = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 101))
    assert tested.ks_pvalue == pytest.approx(min(1, max(0, series)) if lam >= 0.2 else 1, abs=1e-12)


def test_identical_samples_do_not_drift(spark):
    x = np.random.default_rng(5).random(100)
    df = sided(spark, x, x)
    for method in ("minmax", "own", "reference"):
        row = drift.drift_metrics(df, ["x"], method).first()
        assert (row.psi, row.ks_stat, row.ks_pvalue) == pytest.approx((0, 0, 1))
    outcome = drift.drift_alerts(drift.drift_metrics(df, ["x"])).collect()
    assert [(r.outcome, r.feature) for r in outcome] == [("stable", None)]


def test_three_outcomes(spark):
    rng = np.random.default_rng(6)
    short = sided(spark, rng.random(9), rng.random(50))
    metrics = drift.drift_metrics(short, ["x"])
    assert [r.outcome for r in drift.drift_alerts(metrics).collect()] == ["no drift"]
    moved = sided(spark, rng.random(100), rng.random(100) + 5)
    metrics = drift.drift_metrics(moved, ["x"])
    assert [(r.outcome, r.feature) for r in drift.drift_alerts(metrics).collect()] == [("drift", "x")]
    summary = drift.drift_summary(metrics).first()
    assert (summary.num_features, summary.num_drifted_features, summary.mvr) == (1, 1, None)


def test_only_shared_numeric_columns_are_compared(spark):
    reference = spark.createDataFrame([(1, 2.0, "a")], "n int, x double, s string")
    current = spark.createDataFrame([(3.0, "b", 1)], "x double, s string, other int")
    assert drift.two_sided(reference, current).columns == ["x", "side"]


def test_missing_values_are_left_out(spark):
    df = sided(spark, [1, 2, None, float("nan")], [1, 2, 3, None], y=([1] * 4, [1] * 4))
    counts = {r.feature: (r.n_ref, r.n_cur, r.compared) for r in drift.feature_counts(df, ["x", "y"]).collect()}
    assert counts == {"x": (2, 3, 0), "y": (4, 4, 0)}
    assert drift.ks_statistic(drift.sliced_values(df, ["x"])).first().n_ref == 2


def test_weights_stand_for_pairs(spark):
    """Weighted measures equal those of the pairs a many-to-many join would make."""
    rng = np.random.default_rng(8)
    reference = spark.createDataFrame(
        [(str(int(c)), float(v)) for c, v in zip(rng.integers(0, 12, 300), rng.random(300))],
        "customer_id string, amount double",
    )
    predictions = spark.createDataFrame(
        [(str(int(c)), 1.0) for c in rng.integers(0, 9, 80)], "customer_id string, prediction double"
    )
    sample, features, weight = monitoring.matched_sample(reference, predictions)
    assert features == ["amount"]
    pairs = reference.join(predictions, "customer_id").select("amount")
    plain = drift.two_sided(reference, pairs)
    for method in ("minmax", "own", "reference"):
        weighted = drift.drift_metrics(sample, features, method, weight).first()
        assert tuple(weighted)[1:] == pytest.approx(
            tuple(drift.drift_metrics(plain, features, method).first())[1:], abs=1e-9
        )


def test_monitor_join_suffixes_and_fallback(spark, rows):
    reference = spark.createDataFrame([("a", 1, 2.0)], "customer_id string, mob int, x double")
    predictions = spark.createDataFrame([("a", 3, 0.5)], "customer_id string, mob int, prediction double")
    joined = drift.monitor_join(reference, predictions)
    assert set(joined.columns) == {"customer_id", "mob_ref", "x", "mob_pred", "prediction"}
    assert drift.monitor_join(reference.drop("customer_id"), predictions).columns == ["mob", "x"]


def test_monotonicity_matches_a_plain_loop(spark):
    import hashlib

    rng = np.random.default_rng(9)
    # one entity owns a third of the rows, many of them at the same time
    entity = np.where(rng.random(3000) < 0.34, 0, rng.integers(1, 60, 3000))
    data = [
        (int(e), int(t), str(i), None if rng.random() < 0.05 else float(v))
        for i, (e, t, v) in enumerate(zip(entity, rng.integers(0, 4, 3000), rng.random(3000)))
    ]
    df = spark.createDataFrame(data, "e int, t int, id string, v double")
    before, expected = {}, 0
    for e, t, i, v in sorted(data, key=lambda r: (r[0], r[1], hashlib.md5(r[2].encode()).hexdigest())):
        last = before.get(e)
        expected += last is not None and v is not None and v - last > 0
        before[e] = v
    got = drift.monotonicity_violation_rate(df, "e", "t", "id", "v").first()
    assert (got.n_rows, got.n_violations) == (3000, expected)
    assert got.mvr == pytest.approx(expected / 3000)


def test_report_tables_grow(spark, tmp_path):
    rng = np.random.default_rng(2)
    df = sided(spark, rng.random(50), rng.random(50) + 1)
    for _ in range(2):
        summary = monitoring.report(df, ["x"], str(tmp_path / "reports"))
    assert summary.first().num_drifted_features == 1
    for table in ("metrics", "alerts", "summary"):
        assert spark.read.parquet(str(tmp_path / "reports" / table)).count() == 2


def test_several_predictions_for_a_key_are_refused(spark):
    reference = spark.createDataFrame([("a", 1), ("a", 2)], "customer_id string, x int")
    single = spark.createDataFrame([("a", 0.5)], "customer_id string, prediction double")
    assert drift.monitor_join(reference, single).count() == 2
    with pytest.raises(Exception, match="several predictions"):
        drift.monitor_join(reference, single.union(single)).collect()


@pytest.mark.parametrize("name", ["psi_quantile_refined", "drift_summary", "monitor_report", "monitor_matched"])
def test_cutoff_and_sides_read_the_written_loans(spark, monkeypatch, name):
    read, cutoff = [], drifting.oot_cutoff
    monkeypatch.setattr(drifting, "oot_cutoff", lambda df, *more: read.append(df.inputFiles()) or cutoff(df, *more))
    QUERIES[name](spark, SF_DIR)
    assert len(read) == 1 and not any(SF_DIR in f for f in read[0])


def test_raw_months_are_written_by_many_tasks(spark, monkeypatch):
    plans, write = [], profiles.raw.write_csv
    monkeypatch.setattr(profiles.raw, "write_csv", lambda df, path: plans.append(df._jdf.queryExecution().toString()) or write(df, path))
    QUERIES["empty_snapshot"](spark, SF_DIR)
    assert len(plans) == 2 and not any("Coalesce" in p or "Repartition" in p for p in plans)
