import datetime as dt
import json
import threading

import pytest
from pyspark.sql import functions as F

from loanmart.plans import datamart
from loanmart.sources import manifest, tables
from loanmart.sources.digest import month_digests
from loanmart.sources.manifest import ConcurrentWrite

MONTHS = [dt.date(2023, m, 1) for m in (1, 2, 3)]


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "t")


def frame(spark, values, months=MONTHS):
    return spark.createDataFrame([(v, m) for v, m in zip(values, months)], "x int, snapshot_date date")


def stored(spark, path, **how):
    return sorted((str(r.snapshot_date)[5:7], r.x) for r in tables.read_snapshots(spark, path, **how).collect())


def test_a_failed_write_changes_nothing_and_leaves_nothing(spark, path, tmp_path):
    tables.write_snapshots(frame(spark, [1, 2, 3]), path)
    broken = frame(spark, [4, 5, 6]).withColumn("x", F.when(F.col("x") == 6, F.raise_error(F.lit("stop")).cast("int")).otherwise(F.col("x")))
    for how in ({}, {"whole": True}, {"months": [str(m) for m in MONTHS]}):
        with pytest.raises(Exception, match="stop"):
            tables.write_snapshots(broken, path, **how)
    assert stored(spark, path) == [("01", 1), ("02", 2), ("03", 3)]
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("_generation")]) == 1


def test_an_open_query_survives_the_next_write(spark, path):
    tables.write_snapshots(frame(spark, [1, 2, 3]), path)
    before = tables.read_snapshots(spark, path)
    tables.write_snapshots(tables.read_snapshots(spark, path).withColumn("x", F.col("x") + 10), path, whole=True)
    assert sorted(r.x for r in before.collect()) == [1, 2, 3]
    assert stored(spark, path) == [("01", 11), ("02", 12), ("03", 13)]
    assert stored(spark, path, version=1) == [("01", 1), ("02", 2), ("03", 3)]


def test_what_no_version_names_is_removed(spark, path, tmp_path):
    for i in range(5):
        tables.write_snapshots(frame(spark, [i], MONTHS[:1]), path)
    tables.write_snapshots(frame(spark, [7], MONTHS[1:2]), path)
    assert stored(spark, path) == [("01", 4), ("02", 7)]
    assert manifest.versions(spark, path) == [5, 6]
    folders = [p for p in (tmp_path / "t").iterdir() if p.name.startswith("_generation")]
    assert len(folders) == 2
    (tmp_path / "t" / "_generation=000009-dead").mkdir()
    assert manifest.vacuum(spark, path) == 0  # a writer may still be at work
    assert manifest.vacuum(spark, path, older_than_hours=0) == 1
    with pytest.raises(ValueError, match="versions 5 to 6"):
        tables.read_snapshots(spark, path, version=2)


def between(monkeypatch, other):
    """Runs ``other`` once, after a writer has written its files and before it publishes."""
    real, ran = manifest.publish, []

    def publish(spark, path, change):
        if not ran:
            ran.append(True)
            other()
        return real(spark, path, change)

    monkeypatch.setattr(manifest, "publish", publish)


def test_two_writers_of_different_months_both_stay(spark, path, monkeypatch):
    tables.write_snapshots(frame(spark, [1], MONTHS[:1]), path)
    between(monkeypatch, lambda: tables.write_snapshots(frame(spark, [2], MONTHS[1:2]), path))
    tables.write_snapshots(frame(spark, [3], MONTHS[2:]), path)
    assert stored(spark, path) == [("01", 1), ("02", 2), ("03", 3)]


@pytest.mark.parametrize("how", [{}, {"whole": True}, {"months": ["2023-02-01"]}])
def test_two_writers_of_one_month_the_first_stays(spark, path, monkeypatch, tmp_path, how):
    tables.write_snapshots(frame(spark, [1, 1], MONTHS[:2]), path)
    between(monkeypatch, lambda: tables.write_snapshots(frame(spark, [2], MONTHS[1:2]), path))
    with pytest.raises(ConcurrentWrite, match="2023-02-01"):
        tables.write_snapshots(frame(spark, [3], MONTHS[1:2]), path, **how)
    assert stored(spark, path) == [("01", 1), ("02", 2)]


def test_a_version_is_put_once(spark, path):
    empty = manifest.Manifest(1, None, {})
    assert manifest._put(spark, path, empty) and not manifest._put(spark, path, empty)
    seen = []

    def change(now):
        seen.append(now.version)
        if len(seen) == 1:
            assert manifest._put(spark, path, manifest.Manifest(2, None, {"a": {"generation": None}}))
        return manifest.Manifest(now.version + 1, None, dict(now.months))

    assert manifest.publish(spark, path, change).version == 3
    assert seen == [1, 2] and "a" in manifest.read(spark, path).months


def test_writers_in_threads(spark, path):
    faults = []

    def write(i):
        try:
            tables.write_snapshots(frame(spark, [i], [dt.date(2020, i, 1)]), path)
        except Exception as fault:  # noqa: BLE001
            faults.append(fault)

    threads = [threading.Thread(target=write, args=(i,)) for i in range(1, 7)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not faults and [x for _, x in stored(spark, path)] == [1, 2, 3, 4, 5, 6]


def test_a_table_of_plain_folders_is_taken_over(spark, path):
    old = frame(spark, [1, 2, 3])
    old.write.partitionBy("snapshot_date").parquet(path)
    assert tables.stored_months(spark, path) == [str(m) for m in MONTHS]
    tables.write_snapshots(frame(spark, [9], MONTHS[1:2]).withColumn("y", F.lit("new")), path)
    assert stored(spark, path) == [("01", 1), ("02", 9), ("03", 3)]
    tables.write_snapshots(frame(spark, [8], MONTHS[2:]), path)
    assert stored(spark, path) == [("01", 1), ("02", 9), ("03", 8)]
    assert [r.y for r in tables.read_snapshots(spark, path, ["2023-02-01"]).collect()] == ["new"]


def test_emptied_table_keeps_columns(spark, path):
    tables.write_snapshots(frame(spark, [1, 2, 3]), path)
    tables.write_snapshots(frame(spark, [1]).where("false"), path, whole=True)
    empty = tables.read_snapshots(spark, path)
    assert empty.count() == 0 and empty.columns == ["x", "snapshot_date"] and tables.stored_months(spark, path) == []


def test_digests_see_content_and_nothing_else(spark):
    rows = [(1, "a", None, MONTHS[0]), (2, None, 1.5, MONTHS[0]), (2, None, 1.5, MONTHS[0]), (3, "c", 0.0, MONTHS[1])]
    schema = "k int, t string, v double, snapshot_date date"
    whole = spark.createDataFrame(rows, schema)
    digests = month_digests(whole, "snapshot_date")
    shuffled = spark.createDataFrame(rows[::-1], schema).repartition(5).select("v", "snapshot_date", "t", "k")
    assert month_digests(shuffled, "snapshot_date") == digests
    assert month_digests(whole.withColumn("at", F.current_timestamp()), "snapshot_date", ["at"]) == digests
    for other in (rows[:2] + rows[3:], [(1, None, None, MONTHS[0]), *rows[1:]], [(2, "a", None, MONTHS[0]), (1, None, 1.5, MONTHS[0]), *rows[2:]]):
        changed = month_digests(spark.createDataFrame(other, schema), "snapshot_date")
        assert changed["2023-01-01"] != digests["2023-01-01"] and changed["2023-02-01"] == digests["2023-02-01"]
    swapped = spark.createDataFrame([(1, None, MONTHS[0])], "a int, b int, snapshot_date date")
    assert month_digests(swapped, "snapshot_date") != month_digests(spark.createDataFrame([(None, 1, MONTHS[0])], swapped.schema), "snapshot_date")


def sources(spark, amount=1000.0, age="41", months=("2023-01-01", "2023-02-01")):
    loans = [(f"L{i}", "C1", "2023-01-01", "10", str(i), str(amount if m == "2023-02-01" else 1000.0), "100", "0", "0", "900", m) for i, m in enumerate(months)]
    columns = "loan_id Customer_ID loan_start_date tenure installment_num loan_amt due_amt paid_amt overdue_amt balance snapshot_date"
    people = [("C1", "N", age, "1", "J", "2023-01-01")]
    text = lambda names: ", ".join(f"{n} string" for n in names.split())
    return {
        "loans": spark.createDataFrame(loans, text(columns)),
        "attributes": spark.createDataFrame(people, text("Customer_ID Name Age SSN Occupation snapshot_date")),
    }


def test_refresh_builds_what_changed_and_what_it_feeds(spark, tmp_path):
    root = str(tmp_path / "mart")
    layout, built = datamart.refresh(spark, sources(spark), root)
    assert len(built) == 2 + 2 + 1 + 1 + 2 + 2
    assert datamart.refresh(spark, sources(spark), root)[1] == []
    _, built = datamart.refresh(spark, sources(spark, amount=2000.0), root)
    february = "2023-02-01"
    assert built == [("bronze", "loans", february), ("silver", "loans", february), ("gold", "feature_store", february), ("gold", "label_store", february)]
    # text that is no number reads as null before and after: silver stays what it was and feeds nothing
    _, built = datamart.refresh(spark, sources(spark, amount=2000.0, age="x"), root)
    assert ("gold", "feature_store", "2023-01-01") in built
    _, built = datamart.refresh(spark, sources(spark, amount=2000.0, age="y"), root)
    assert built == [("bronze", "attributes", "2023-01-01"), ("silver", "attributes", "2023-01-01")]
    # another rule builds all months of what it concerns
    _, built = datamart.refresh(spark, sources(spark, amount=2000.0, age="y"), root, threshold=60)
    assert built == [("gold", t, m) for t in ("feature_store", "label_store") for m in ("2023-01-01", february)]
    whole = datamart.run(spark, sources(spark, amount=2000.0, age="y"), str(tmp_path / "whole"), threshold=60)
    for layer, table in (("silver", "loans"), ("silver", "attributes"), ("gold", "feature_store"), ("gold", "label_store")):
        a, b = (tables.read_snapshots(spark, l.table(layer, table)).drop("gold_processing_date") for l in (layout, whole))
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_refresh_empties_vanished_months_and_goes_on_after_a_failure(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "mart")
    datamart.refresh(spark, sources(spark), root)
    real = datamart.silver
    monkeypatch.setattr(datamart, "silver", lambda *a: 1 / 0)
    gone = sources(spark, months=("2023-01-01",))
    with pytest.raises(ZeroDivisionError):
        datamart.refresh(spark, gone, root)
    monkeypatch.setattr(datamart, "silver", real)
    layout, built = datamart.refresh(spark, gone, root)
    assert {(layer, m) for layer, d, m in built if d != "attributes"} == {("silver", "2023-02-01"), ("gold", "2023-02-01")}
    for layer, table in (("bronze", "loans"), ("silver", "loans"), ("gold", "feature_store")):
        assert tables.stored_months(spark, layout.table(layer, table)) == ["2023-01-01"]
    noted = json.loads(manifest.read(spark, layout.table("gold", "feature_store")).months["2023-01-01"]["inputs"])
    assert set(noted) == {"rule", "loans", "attributes"}
