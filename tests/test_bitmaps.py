import datetime as dt

from loanmart.sources import bitmaps, tables

MONTHS = [dt.date(2023, m, 1) for m in (1, 2, 3)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "customer_id string, snapshot_date date")


def count(spark, paths, **how):
    return bitmaps.distinct_ids(spark, paths, "customer_id", **how).first()[0]


def test_numbers_are_dense_and_stay(spark, tmp_path):
    path = str(tmp_path / "ids")
    first = {r.id: r.number for r in bitmaps.numbered(frame(spark, [(f"c{i % 500}", None) for i in range(900)] + [(None, None)]).select("customer_id"), path).collect()}
    assert sorted(first.values()) == list(range(500))
    second = {r.id: r.number for r in bitmaps.numbered(frame(spark, [(f"c{i}", None) for i in range(490, 600)]).select("customer_id"), path).collect()}
    assert sorted(second.values()) == list(range(600)) and all(second[k] == v for k, v in first.items())
    version = len(tables.stored_months(spark, path, "added"))
    assert bitmaps.numbered(frame(spark, [("c3", None)]).select("customer_id"), path).count() == 600
    assert len(tables.stored_months(spark, path, "added")) == version  # nothing new, nothing written


def test_merged_over_months_and_tables(spark, tmp_path):
    ids, a, b = (str(tmp_path / n) for n in ("ids", "a", "b"))
    # over 32,768 ids, so that there are several buckets
    many = [(str(i), MONTHS[i % 2]) for i in range(70_000)] + [("1", MONTHS[0]), (None, MONTHS[0]), ("lost", None)]
    bitmaps.write_bitmaps(frame(spark, many), a, {"customer_id": ids})
    bitmaps.write_bitmaps(frame(spark, [("5", MONTHS[1]), ("new", MONTHS[1]), ("new", MONTHS[2])]), b, {"customer_id": ids})
    assert count(spark, [a]) == 70_000 and count(spark, [b]) == 2 and count(spark, [a, b]) == 70_001
    assert count(spark, [a, b], months=["2023-02-01"]) == 35_001 and count(spark, [a], months=["2023-03-01"]) == 0
    profile = bitmaps.store_profile(spark, a, "customer_id").first()
    assert (profile.n_rows, profile.n_customer_id, profile.first_snapshot, profile.last_snapshot) == (70_002, 70_000, MONTHS[0], MONTHS[1])
    # a month written again replaces its bitmaps alone
    bitmaps.write_bitmaps(frame(spark, [("x", MONTHS[1])]), a, {"customer_id": ids})
    assert count(spark, [a]) == 35_002


def test_no_rows(spark, tmp_path):
    ids, a = str(tmp_path / "ids"), str(tmp_path / "a")
    bitmaps.write_bitmaps(frame(spark, [("x", MONTHS[0])]).where("false"), a, {"customer_id": ids})
    assert count(spark, [a]) == 0 and bitmaps.store_profile(spark, a, "customer_id").first().n_rows == 0
