import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanmart.operators import drift, ranks
import workload.catalog  # noqa: F401
from workload.registry import QUERIES

PROBABILITIES = [0.0, 0.1, 1 / 3, 0.5, 0.9, 0.999, 1.0]


def expected(values, weights=None):
    data = [v for v, w in zip(values, weights or [1] * len(values)) if v is not None and v == v for _ in range(w or 0)]
    if not data:
        return None
    data = np.sort(np.array(data))
    out = []
    for p in PROBABILITIES:
        x = p * (len(data) - 1)
        low, high = data[math.floor(x)], data[math.ceil(x)]
        out.append(low if low == high else low + (high - low) * (x - math.floor(x)))
    return out


def frame(spark, values, weights=None):
    rows = [(v if v is None else float(v), w) for v, w in zip(values, weights or [1] * len(values))]
    return spark.createDataFrame(rows, "x double, w int").repartition(3)


draw = np.random.default_rng(4)
CASES = {
    "even": list(draw.random(3000)),
    "heavy tails": list(np.exp(40 * draw.standard_normal(3000))) + [0.0, -5.0],
    "one value most of the time": [7.0] * 2000 + list(draw.integers(0, 20, 100)),
    "whole numbers": list(draw.integers(-5, 6, 500)),
    "extremes": [1.7e308, -1.7e308, 5e-324, -5e-324, 0.0, -0.0, 1e-320, math.inf, -math.inf, 1.0, math.nextafter(1.0, 2)] * 3,
    "infinities only": [math.inf, math.inf, -math.inf],
    "odd": [None, math.nan, 3.0],
    "neighbours": [math.nextafter(1.0, 2) if i % 2 else 1.0 for i in range(50)],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("buckets, few", [(4096, 2_000_000), (64, 0), (9, 400)])
def test_equal_to_sorting(spark, name, buckets, few):
    got = ranks.quantiles(frame(spark, CASES[name]), ["x"], PROBABILITIES, buckets=buckets, few=few).first()["q_n"]
    assert list(map(float.__repr__, got)) == [repr(float(x)) for x in expected(CASES[name])]


def test_groups_weights_and_absent_values(spark):
    values, weights = list(draw.integers(0, 30, 400)), [None if i % 50 == 0 else int(i % 4) for i in range(400)]
    df = spark.createDataFrame(
        [(("a", None, "b")[i % 3], float(v), v * 2, None, w) for i, (v, w) in enumerate(zip(map(int, values), weights))],
        "side string, x double, y int, z double, w int",
    )
    got = {(r.side, r.feature): r.q_n for r in ranks.quantiles(df, ["x", "y", "z"], PROBABILITIES, by=["side"], weight="w", buckets=8, few=0).collect()}
    want = {}
    for i, side in enumerate(("a", None, "b")):
        of = [int(v) for v in values[i::3]]
        want |= {(side, "x"): expected(of, weights[i::3]), (side, "y"): expected([2 * v for v in of], weights[i::3])}
    assert got == want
    assert ranks.quantiles(df.where("false"), ["x"], [0.5]).count() == 0


def test_no_value_is_shuffled(spark):
    """What rounds exchange are counts of ranges; no exchange or sort has the values."""
    seen = []
    real = ranks._next_round

    def watched(rows, opened, keys, key_fields, buckets):
        import unittest.mock as mock
        from pyspark.sql.classic.dataframe import DataFrame

        collect = DataFrame.collect

        def noting(df):
            out = collect(df)
            seen.append(df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0])
            return out

        with mock.patch.object(DataFrame, "collect", noting):
            return real(rows, opened, keys, key_fields, buckets)

    import unittest.mock as mock

    with mock.patch.object(ranks, "_next_round", watched):
        ranks.quantiles(frame(spark, CASES["even"]), ["x"], [0.5], buckets=64, few=0)
    assert len(seen) >= 2
    for text in seen:
        exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
        assert exchanges and all("value" not in e for e in exchanges) and "rangepartitioning" not in text


@pytest.mark.parametrize("name, same", [("psi_quantile_refined", "psi_quantile"), ("psi_reference_refined", "psi_reference_edges"), ("income_bands_refined", "income_bands")])
def test_equal_to_the_ordered_form(spark, name, same):
    a, b = (sorted(map(str, QUERIES[n](spark, "/root/testdata/sf0.001").collect())) for n in (name, same))
    assert a == b


def test_input_is_read_once_and_values_are_not_sorted(spark, tmp_path, monkeypatch):
    """All rounds read what was written of the input, and none sorts it for its aggregate."""
    source = str(tmp_path / "source")
    frame(spark, CASES["even"]).withColumn("side", F.lit("ref")).write.parquet(source)
    df, read, plans = spark.read.parquet(source), [], []
    long = ranks._long
    monkeypatch.setattr(ranks, "_long", lambda d, *more: read.append(d.inputFiles()) or long(d, *more))
    ranks.quantiles(df, ["x"], [0.5], buckets=64, few=0)
    ranks.boxplot(df, ["x"])
    drift.psi_refined(df, ["x"])
    assert len(read) == 4 and not any(source in f for files in read for f in files)

    collect = type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda d: plans.append(d) or collect(d))
    ranks.quantiles(df, ["x"], [0.5], buckets=64, few=0)
    texts = [p._jdf.queryExecution().executedPlan().toString() for p in plans]
    assert len(texts) > 2 and not any("SortAggregate" in t for t in texts)
