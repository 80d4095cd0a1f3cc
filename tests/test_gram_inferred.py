import datetime as dt
import itertools
import math

import numpy as np
import pytest

from loanmart.operators import gram
from loanmart.sources import inferred, manifest, tables


def test_pairs_with_gaps_equal_numpy(spark):
    draw = np.random.default_rng(2)
    x = draw.standard_normal((400, 5)) @ draw.standard_normal((5, 5)) + 1e6
    x[:, 4] = 3.0  # constant
    gaps = draw.random(x.shape) < 0.2
    rows = [tuple(None if g else float(v) for v, g in zip(r, h)) for r, h in zip(x, gaps)]
    rows += [(math.inf, 1.0, 2.0, 3.0, 3.0), (math.nan, None, None, 1.0, 3.0)]
    names = list("abcde")
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(5)
    got = {(r.a, r.b): (r.n, r.corr) for r in gram.correlations(df, names).collect()}
    assert list(got) == list(itertools.combinations(names, 2))
    for i, j in itertools.combinations(range(5), 2):
        both = np.array([(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None and math.isfinite(r[i]) and math.isfinite(r[j])])
        n, corr = got[(names[i], names[j])]
        assert n == len(both)
        assert corr is None if j == 4 else corr == pytest.approx(np.corrcoef(both.T)[0, 1], abs=1e-9)


def test_no_rows_one_column_and_one_row(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    assert [tuple(r) for r in gram.correlations(df, ["a", "b"]).collect()] == [("a", "b", 1, None)]
    assert [tuple(r) for r in gram.correlations(df.where("false"), ["a", "b"]).collect()] == [("a", "b", 0, None)]
    assert gram.correlations(df, ["a"]).count() == 0


KINDS = {
    "12": "bigint", " -7 ": "bigint", "1.5": "double", "1e3": "double", "99999999999999999999": "double", "2023-01-31": "date", "2023-02-31": "string", "x": "string",
}


def test_kinds_of_values_and_their_join(spark):
    frame = spark.createDataFrame([(t, i) for i, t in enumerate([*KINDS, None, "", "  "])], "t string, i int")
    bits = [r[0] for r in frame.orderBy("i").select(inferred.kind_of(frame.t)).collect()]
    assert [inferred.type_of(b) for b in bits[: len(KINDS)]] == list(KINDS.values()) and bits[len(KINDS) :] == [0, 0, 0]
    for a, b, c in itertools.product((0, 1, 2, 4, 8), repeat=3):
        ways = [inferred.joined(({"x": p}, {"x": q}, {"x": r})) for p, q, r in itertools.permutations((a, b, c))]
        assert all(w == ways[0] for w in ways)
    assert [inferred.type_of(k) for k in (0, 1, 2, 3, 4, 5, 8, 15)] == ["string", "bigint", "double", "double", "date", "string", "string", "string"]


def test_a_later_month_widens_and_its_removal_narrows(spark, tmp_path):
    path, months = str(tmp_path / "t"), [dt.date(2023, m, 1) for m in (1, 2, 3)]

    def write(month, *values):
        rows = [("007", v, "2023-05-01", month) for v in values]
        frame = spark.createDataFrame(rows, "customer_id string, amount string, due string, snapshot_date date")
        inferred.write_inferred(frame, path, months=[str(month)])

    write(months[0], "1", "2")
    assert dict(inferred.read_inferred(spark, path).dtypes)["amount"] == "bigint"
    write(months[1], "2.5", None)
    table = inferred.read_inferred(spark, path)
    assert dict(table.dtypes) == {"customer_id": "string", "amount": "double", "due": "date", "snapshot_date": "date"}
    assert sorted(r.amount for r in table.where("amount IS NOT NULL").collect()) == [1.0, 2.0, 2.5]
    first = [p for p in (tmp_path / "t").rglob("*.parquet") if "2023-01-01" in str(p)]
    before = {p: p.stat().st_mtime_ns for p in first}
    write(months[2], "unknown")
    table = inferred.read_inferred(spark, path)
    assert sorted(str(r.amount) for r in table.collect()) == ["1", "2", "2.5", "None", "unknown"]
    assert dict(inferred.read_inferred(spark, path, [str(months[0])]).dtypes)["amount"] == "string"
    assert {p: p.stat().st_mtime_ns for p in first} == before  # no stored month was written again
    write(months[2], "7")
    assert dict(inferred.read_inferred(spark, path).dtypes)["amount"] == "double"
    assert inferred.stored_types(spark, str(tmp_path / "none")) == {} and manifest.read(spark, str(tmp_path / "none")) is None
    assert tables.stored_months(spark, path) == [str(m) for m in months]
