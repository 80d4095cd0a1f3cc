"""What the plans must look like to hold at scale."""

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from loanmart.operators import gold
from workload.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in ("champion", "train_lr", "train_rf")))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "ArrowEval" not in text


def test_scans_read_only_the_columns_used(spark):
    text = plan(queries()["label_store_a2"](spark, SF_DIR))
    assert "o_orderpriority" not in text and "l_returnflag" in text


def test_filters_reach_the_scan(spark):
    text = queries()["mob0_loans"](spark, SF_DIR)._jdf.queryExecution().toString()
    assert "PushedFilters: [" in text and "GreaterThan(o_totalprice,0.0)" in text


@pytest.mark.parametrize("name", ["ks_statistic", "psi_quantile", "auc_roc", "boxplot_stats"])
def test_values_are_ordered_slice_by_slice(spark, name):
    """The window over the values is fed by a shuffle that includes the slice."""
    df = queries()[name](spark, SF_DIR)
    df.collect()
    text = plan(df).split("== Initial Plan ==")[0]
    lines = text.splitlines()
    windows = [i for i, line in enumerate(lines) if re.search(r"Window \[.*(value|_rank)#\d+ ASC", line)]
    assert windows
    for i in windows:
        exchange = next(line for line in lines[i:] if "Exchange hashpartitioning" in line)
        assert re.search(r"hashpartitioning\((feature#\d+, )?_slice#\d+, ", exchange)


def test_a_customer_with_a_third_of_the_loans_is_split(spark):
    """Adaptive execution cuts the hot partition of the feature join."""
    changes = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in changes}
    for key, value in changes.items():
        spark.conf.set(key, value)
    try:
        n = 60000
        customer = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).cast("string")
        loans = spark.range(0, n, 1, 8).select(
            F.col("id").cast("string").alias("loan_id"),
            customer.alias("customer_id"),
            F.rand(1).alias("loan_amt"),
            F.lit(12).alias("tenure"),
            F.lit(0).alias("mob"),
            F.to_date(F.lit("2023-01-01")).alias("snapshot_date"),
        )
        side = loans.select("customer_id", "snapshot_date").distinct()
        ages, clicks = (side.withColumn(c, F.rand(s)) for c, s in (("age", 2), ("fe_1", 3)))
        store = gold.feature_store(loans, clicks, ages, None)
        # the hash keeps all columns alive up to the last join
        joined = store.agg(
            F.count("age"), F.count("fe_1"), F.bit_xor(F.xxhash64(*store.columns)).alias("h")
        )
        assert [tuple(r)[:2] for r in joined.collect()] == [(n, n)]
        assert plan(joined).count("skew=true") >= 2
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
