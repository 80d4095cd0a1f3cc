import pytest
from pyspark.sql import functions as F

from loanmart.operators import gold
from loanmart.sources import bucketed, manifest
import workload.catalog  # noqa: F401
from workload.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name, joins", [("training_set_a1_stored", 1), ("gold_features_stored", 3)])
def test_stored_sides_are_not_shuffled(spark, name, joins):
    df = QUERIES[name](spark, SF_DIR)
    df.collect()
    text = plan(df).split("== Initial Plan ==")[0]
    assert "Exchange" not in text and text.count("SortMergeJoin") == joins
    assert text.count("Bucketed: true") == joins + 1


def test_rows_replaced_kept_on_failure_and_old_files_removed(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    frame = spark.createDataFrame([(i, f"v{i}", float(i)) for i in range(50)], "k int, `odd name` string, x double")
    bucketed.write_bucketed(frame, path, ["k"], 4)
    assert rows(bucketed.read_bucketed(spark, path)) == rows(frame)
    broken = frame.withColumn("x", F.when(F.col("k") == 7, F.raise_error(F.lit("stop")).cast("double")).otherwise(F.col("x")))
    with pytest.raises(Exception, match="stop"):
        bucketed.write_bucketed(broken, path, ["k"], 4)
    assert rows(bucketed.read_bucketed(spark, path)) == rows(frame)
    before = bucketed.read_bucketed(spark, path)
    for n in (1, 2, 3):
        bucketed.write_bucketed(frame.limit(n), path, ["k"], 2)
        if n == 1:
            assert before.count() == 50
    assert bucketed.read_bucketed(spark, path).count() == 3
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("_generation")]) == manifest.KEPT
    with pytest.raises(FileNotFoundError):
        bucketed.read_bucketed(spark, str(tmp_path / "none"))


def test_nulls_doubles_of_keys_and_an_empty_side(spark, tmp_path, rows):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, "d")], "k int, x string")
    right = spark.createDataFrame([(1, 10), (1, 11), (None, 12), (3, 13)], "k int, y int")
    stored = []
    for name, frame in (("l", left), ("r", right), ("e", right.where("false"))):
        bucketed.write_bucketed(frame, str(tmp_path / name), ["k"], 3)
        stored.append(bucketed.read_bucketed(spark, str(tmp_path / name)))
    for how in ("inner", "left", "full"):
        for i, side in ((1, right), (2, right.where("false"))):
            found = bucketed.join_stored(stored[0], stored[i], ["k"], how)
            assert sorted(map(str, found.collect())) == sorted(map(str, left.join(side, "k", how).collect()))


def test_a_customer_with_a_third_of_the_loans_fills_no_bucket(spark, tmp_path):
    """Loan and month are keys beside the customer, so the loans of one customer lie apart."""
    n, buckets = 30_000, 16
    customer = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    loans = spark.range(n).select(
        F.col("id").cast("string").alias("loan_id"), customer.alias("customer_id"), F.to_date(F.lit("2023-01-01")).alias("snapshot_date"),
    )
    path = str(tmp_path / "features")
    bucketed.write_bucketed(gold.for_outcome(loans), path, gold.OUTCOME_KEYS, buckets)
    held = bucketed.read_bucketed(spark, path).groupBy(F.input_file_name().alias("file")).count().collect()
    assert len(held) == buckets and max(r["count"] for r in held) < 1.2 * n / buckets
