import datetime as dt

import numpy as np
import pytest
from pyspark.sql import Observation, functions as F

from loanmart.operators import evaluate, features, model, profile, score, split
from loanmart.plans import training
from loanmart.sources import registry


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(1200):
        x, y = rng.normal(), rng.normal()
        month = dt.date(2023, 1 + i % 8, 1)
        label = int(rng.random() < 1 / (1 + np.exp(-(2 * x - 1))))
        rows.append((f"C{i}", month, float(x), float(y) if i % 9 else None, i % 12, label, "text"))
    return spark.createDataFrame(
        rows, "customer_id string, snapshot_date date, x double, y double, mob int, label int, job string"
    )


@pytest.fixture(scope="module")
def champion(table):
    grid = [model.Candidate("LogisticRegression", 0.01), model.Candidate("RandomForest", 3)]
    return training.train(table, ["customer_id", "snapshot_date"], grid, trees=5)


def test_grid_is_the_search_space():
    assert [(c.name, c.parameter) for c in model.grid()] == [
        ("LogisticRegression", 0.01), ("LogisticRegression", 0.05), ("LogisticRegression", 0.1),
        ("RandomForest", 6), ("RandomForest", 8),
    ]


def test_features_are_chosen_by_type(table):
    clean, names = model.prepared(table)
    assert names == ["x", "y", "mob"]
    assert clean.where("y IS NULL").count() == 0
    assert dict(clean.dtypes)["label"] == "double"


def test_champion_record(table, champion):
    record = champion.metrics.first()
    sizes = record.train_rows, record.val_rows, record.hist_test_rows, record.oot_rows
    assert sum(sizes) == table.count() and record.oot_rows == 450
    assert min(record.val_auc, record.hist_test_auc, record.oot_auc) > 0.7


def test_saved_model_scores_the_same(spark, table, champion, rows, tmp_path):
    bank = str(tmp_path / "bank")
    training.publish(spark, champion, bank, "20250101_000000")
    loaded = registry.load_latest_model(spark, bank, champion.candidate.name)
    assert score.expected_inputs(loaded) == ["x", "y", "mob"]
    first = score.score_batch(champion.model, table)
    second = score.score_batch(loaded, table)
    assert first.columns == ["customer_id", "prediction", "probability", "rawPrediction"]
    assert first.count() == table.count() and first.where("prediction IS NULL").count() == 0
    assert rows(first) == rows(second)
    gaps = table.where("y IS NULL").count()
    kept = score.score_batch(loaded, table, nulls="keep")
    assert kept.count() == table.count()
    assert kept.where("prediction IS NULL AND probability IS NULL AND missing_inputs = 1").count() == gaps
    assert score.score_batch(loaded, table, nulls="skip").count() == table.count() - gaps
    with pytest.raises(ValueError):
        score.score_batch(loaded, table, nulls="drop")
    assert spark.read.parquet(f"{bank}/metrics").count() == 1
    with pytest.raises(FileNotFoundError):
        registry.load_latest_model(spark, bank, "Unknown")


def test_stored_samples(spark, table, champion, tmp_path):
    again = training.train(
        table, ["customer_id", "snapshot_date"], [champion.candidate], trees=5, samples=str(tmp_path)
    )
    parts = {name: spark.read.parquet(f"{tmp_path}/{name}") for name in ("train", "oot")}
    record = again.metrics.first()
    assert (parts["train"].count(), parts["oot"].count()) == (record.train_rows, record.oot_rows)
    assert set(parts["oot"].columns) == set(table.columns)
    assert again.areas == [(champion.candidate, record.val_auc)]


def test_rows_are_dealt_equally(spark, monkeypatch):
    """A scan of 12,000 well packed rows is a partition or a few; fits get whole rounds of equal ones."""
    monkeypatch.setattr(training, "ROWS_PER_TASK", 1000, raising=False)
    seen, fit = {}, model.train_and_evaluate

    def watched(candidate, scaled, train, validation, **kw):
        for name, frame in (("train", train), ("val", validation)):
            seen[name] = [r["count"] for r in frame.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        return fit(candidate, scaled, train, validation, **kw)

    monkeypatch.setattr(model, "train_and_evaluate", watched)
    table = spark.range(12_000, numPartitions=1).select(
        F.concat(F.lit("C"), "id").alias("customer_id"),
        F.add_months(F.lit("2023-01-01").cast("date"), F.col("id").cast("int") % 8).alias("snapshot_date"),
        (F.col("id") % 2).cast("double").alias("x"),  # nearly all rows are equal
        (F.col("id") % 3 == 0).cast("int").alias("label"),
    )
    best = training.train(table, ["customer_id", "snapshot_date"], [model.Candidate("LogisticRegression", 0.01)])
    sizes = best.metrics.first()
    for name, rows, tasks in (("train", sizes.train_rows, 8), ("val", sizes.val_rows, 2)):  # tests have 4 cores
        assert sum(seen[name]) == rows and len(seen[name]) == tasks
        assert max(seen[name]) < 1.4 * rows / tasks


def test_number_of_tasks():
    wanted = {(0, 8): 1, (9_000, 8): 1, (30_000, 8): 3, (300_000, 8): 8, (2_100_000, 8): 16, (7_630_547, 8): 32}
    assert {k: training.tasks_for(*k) for k in wanted} == wanted


def test_rows_are_scored_once(spark, table):
    """A filter on the score, pushed below the model, would have it score each row twice."""
    calls = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def scored(x):
        calls.add(1)
        return x

    rows = table.select(scored("x").alias("score"), "label")
    areas = evaluate.evaluate_scores(rows).first()
    assert calls.value == 1200
    plain = table.select(F.col("x").alias("score"), "label")
    gaps = plain.union(plain.select(F.lit(None).cast("double"), F.lit(1)))
    assert evaluate.evaluate_scores(plain).first() == areas == evaluate.evaluate_scores(gaps).first()


def test_scoring_fills_what_the_model_lacks(table, champion):
    scored = score.score_batch(champion.model, table.drop("y").withColumnRenamed("mob", "m"), {"mob": "m"})
    assert scored.count() == table.count()


def test_schema_guard(spark, rows):
    df = spark.createDataFrame([("a", "1.5", 2), ("b", "bad", None)], "k string, x string, n int")
    guarded = score.ensure_columns(df, ["x", "n", "z"])
    assert rows(guarded) == [("a", 1.5, 2.0, 0.0), ("b", None, None, 0.0)]
    assert score.available(guarded, ["k", "absent"]).columns == ["k"]


def test_oot_needs_an_older_month(spark):
    days = [(dt.date(2023, m, 1),) for m in (1, 2, 3)]
    df = spark.createDataFrame(days, "snapshot_date date")
    with pytest.raises(Exception, match="monthly snapshots"):
        split.with_oot_part(df).collect()
    df = df.unionByName(spark.createDataFrame([(dt.date(2023, 4, 1),)] * 3, df.schema))
    historical, oot = split.oot_split(df)
    assert (historical.count(), oot.count()) == (1, 5)


def test_hash_split_ignores_partitioning(table, rows):
    first = split.with_hash_split(table, "customer_id")
    second = split.with_hash_split(table.repartition(7), "customer_id")
    assert rows(first, "customer_id", "split") == rows(second, "customer_id", "split")
    shares = {r["split"]: r["count"] / 1200 for r in first.groupBy("split").count().collect()}
    assert shares["train"] == pytest.approx(0.7, abs=0.05)
    assert split.with_random_split(table).count() == 1200


def test_scaling_divides_by_the_deviation(spark, rows):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, c double")
    scaled = model.standard_scaled(df, ["x", "c"])
    deviation = float(np.std([1, 3], ddof=1))
    assert rows(scaled, "x_scaled", "c_scaled") == [(1 / deviation, 0.0), (3 / deviation, 0.0)]


def test_engagement(spark, rows):
    df = spark.createDataFrame(
        [(1.0, 2.0, 2.0), (0.0, 0.0, 0.0), (None, 3.0, -1.0)], "fe_1 double, fe_2 double, fe_3 double"
    )
    picked = features.with_engagement(df).select("total_engagement", "activity_diversity", "favorite_action")
    assert [tuple(r) for r in picked.collect()] == [(5.0, 3, "fe_2"), (0.0, 0, None), (2.0, 2, "fe_2")]


def test_ratios_and_bands(spark):
    df = spark.createDataFrame(
        [(100.0, 10, 0.0, 5.0, 1.0, 2.0)],
        "loan_amt double, tenure int, annual_income double, monthly_inhand_salary double, "
        "total_emi_per_month double, outstanding_debt double",
    )
    row = features.with_ratios(df).first()
    assert (row.debt_to_income, row.emi_burden, row.monthly_payment) == (None, 0.2, 10.0)
    bands = features.with_income_band(df.withColumn("annual_income", F.lit(7.0)), cuts=[5, 10])
    assert bands.first().income_band == "medium"


def test_one_hot(spark, rows):
    df = spark.createDataFrame([("Data Eng",), ("Lawyer",), (None,)], "job string")
    found = features.categories_of(df, "job")
    assert found == ["Data Eng", "Lawyer"]
    hot = features.with_one_hot(df, "job", found)
    assert hot.columns == ["job", "job_data_eng", "job_lawyer"]
    assert [tuple(r)[1:] for r in hot.collect()] == [(1, 0), (0, 1), (0, 0)]
    clash = spark.createDataFrame([("Data Eng",), ("data_eng",), ("DATA ENG ",), (None,)], "job string")
    hot = features.with_one_hot(clash, "job", features.categories_of(clash, "job"))
    assert len(hot.columns) == 4 and [sum(r[1:]) for r in hot.collect()] == [1, 1, 1, 0]
    many = spark.range(1000).select(F.concat(F.lit("j"), F.col("id")).alias("job"))
    assert len(features.categories_of(many, "job")) == 1000
    vectors = features.with_category_vector(many.union(clash.where("job IS NULL")), "job", "v").collect()
    assert sorted(len(r.v.indices) for r in vectors) == [0] + [1] * 1000 and len({tuple(r.v.indices) for r in vectors}) == 1001


def test_logs_of_skewed_columns_only(spark):
    df = spark.createDataFrame([(float(x), float(x**6)) for x in range(20)] + [(5.0, -2.0)], "a double, b double")
    row = features.with_log(df, ["a", "b"], 1.0).where("b = 64").first()
    assert row.log_a == 2.0 and row.log_b == pytest.approx(np.log(65))
    assert features.with_log(df, ["b"], 1.0).where("b = -2").first().log_b is None


def test_profiles_of_nothing(spark):
    empty = spark.createDataFrame([], "label int, customer_id string")
    assert profile.default_rate(empty).first() == (0, 0, 0.0)
    assert profile.multi_application_share(empty).first() == (0, 0, 0.0)


def test_newest_months_are_found_in_the_written_rows(spark, table, tmp_path, monkeypatch):
    """One job derives the table; the cutoff is no second branch of it."""
    source, seen, cutoff = str(tmp_path / "source"), [], training.oot_cutoff
    table.write.parquet(source)
    monkeypatch.setattr(training, "oot_cutoff", lambda df, *more: seen.append(df.inputFiles()) or cutoff(df, *more))
    grid = [model.Candidate("LogisticRegression", 0.01)]
    best = training.train(spark.read.parquet(source), ["customer_id", "snapshot_date"], grid)
    assert best.metrics.first().oot_rows == 450
    assert len(seen) == 1 and seen[0] and not any(source in f for f in seen[0])


def test_models_score_in_a_session_that_has_observed(spark, table):
    seen = Observation()
    table.observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 1200
    for candidate in (model.Candidate("LogisticRegression", 0.01), model.Candidate("RandomForest", 3)):
        best = training.train(table, ["customer_id", "snapshot_date"], [candidate], trees=2)
        assert score.score_batch(best.model, table).count() == 1200
        assert score.score_batch(best.model, table).agg(F.count_if(F.col("prediction") >= 0)).first()[0] == 1200
