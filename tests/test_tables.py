import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from loanmart.plans import datamart
from loanmart.sources import registry, tables
from workload import ingest, views

def test_emptied_and_vanished_months_go(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    full = spark.createDataFrame([(1, MONTHS[0], 5), (2, MONTHS[1], 6)], "id int, snapshot_date date, x int")
    tables.write_snapshots(full, path, whole=True)
    january = full.where("id = 1")
    tables.write_snapshots(january.where("false"), path, months=[str(MONTHS[1])])
    assert rows(tables.read_snapshots(spark, path), "id") == [(1,)]
    assert tables.stored_months(spark, path) == [str(MONTHS[0])]
    tables.write_snapshots(full.where("id = 2"), path, whole=True)
    assert rows(tables.read_snapshots(spark, path), "id") == [(2,)]


def test_columns_kept_with_a_table_save_the_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, MONTHS[0])], "id int, snapshot_date date")
    tables.write_snapshots(first, path)
    tables.write_snapshots(spark.createDataFrame([(2, MONTHS[1], "a")], "id int, snapshot_date date, y string"), path)
    schema = tables.stored_schema(spark, path)
    assert [f.name for f in schema] == ["id", "snapshot_date", "y"]
    # a file that could not be read does no harm as long as its month is not wanted
    (tmp_path / "t" / f"snapshot_date={MONTHS[2]}").mkdir()
    (tmp_path / "t" / f"snapshot_date={MONTHS[2]}" / "part-0.parquet").write_text("no parquet")
    one = tables.read_snapshots(spark, path, [str(MONTHS[1])])
    assert [(r.id, r.y) for r in one.collect()] == [(2, "a")]


MONTHS = [dt.date(2023, m, 1) for m in (1, 2, 4)]


@pytest.fixture
def loans(spark):
    return spark.createDataFrame(
        [(f"L{i}", m) for m in MONTHS for i in range(5)], "loan_id string, snapshot_date date"
    )


def test_writing_again_changes_only_the_months_given(spark, loans, rows, tmp_path):
    path = str(tmp_path / "t")
    tables.write_snapshots(loans, path)
    tables.write_snapshots(loans, path)
    assert tables.read_snapshots(spark, path).count() == 15
    february = loans.where("snapshot_date = DATE '2023-02-01' AND loan_id = 'L0'")
    tables.write_snapshots(february, path)
    counts = tables.read_snapshots(spark, path).groupBy("snapshot_date").count()
    assert rows(counts) == [(MONTHS[0], 5), (MONTHS[1], 1), (MONTHS[2], 5)]


def test_listed_months_are_pruned(spark, loans, tmp_path):
    path = str(tmp_path / "t")
    tables.write_snapshots(loans, path)
    some = tables.read_snapshots(spark, path, ["2023-02-01", "2023-03-01"])
    assert some.count() == 5
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [snapshot_date" in plan


def test_months_with_other_columns_are_merged(spark, loans, tmp_path):
    path = str(tmp_path / "t")
    tables.write_snapshots(loans, path)
    extra = loans.where("snapshot_date = DATE '2023-04-01'").withColumn("score", F.lit(1.0))
    tables.write_snapshots(extra, path)
    table = tables.read_snapshots(spark, path)
    assert table.where("score IS NULL").count() == 10


def test_latest_snapshot(loans):
    def month(wanted):
        return {r.snapshot_date for r in tables.at_latest_snapshot(loans, wanted).collect()}

    assert month("2023-02-01") == {MONTHS[1]}
    assert month("2023-03-01") == month(None) == {MONTHS[2]}


def test_newest_listed_snapshot(spark, loans):
    other = loans.where("snapshot_date = DATE '2023-01-01'")
    pick = tables.newest_listed_snapshot([other, loans], ["2023-01-01", "2023-02-01", "2023-03-01"])
    assert spark.range(1).select(pick).first()[0] == MONTHS[1]


def test_absent_table_is_none(spark, tmp_path):
    assert tables.read_snapshots_optional(spark, str(tmp_path / "none")) is None


def test_latest_artifact(spark):
    stamps = [("a", "p1", 1), ("a", "p3", 2), ("a", "p2", 2), ("b", "q", 0)]
    frame = spark.createDataFrame(stamps, "name string, path string, created_at int")
    assert registry.latest_artifact(frame).first().path == "p3"
    assert registry.latest_artifact(registry.with_prefix(frame, "b")).first().path == "q"


RAW = {
    "lms_loan_daily.csv": (
        "loan_id,Customer_ID,loan_start_date,tenure,installment_num,loan_amt,due_amt,paid_amt,"
        "overdue_amt,balance,snapshot_date\n"
        "L1,C1,2023-01-01,10,0,1000,0,0,0,1000,2023-01-01\n"
        "L1,C1,2023-01-01,10,6,1000,100,0,250,600,1/7/2023\n"
        "L2,C2,2023-01-01,10,0,500,0,0,0,500,2023-01-01\n"
        "L9,C9,2023-01-01,10,0,500,0,0,0,500,2023-01-15\n"
        "L8,C8,2023-01-01,10,0,500,0,0,0,500,unknown\n"
    ),
    "features_attributes.csv": "Customer_ID,Name,Age,SSN,Occupation,snapshot_date\nC1,N,41_,1,J,2023-01-01\n",
    "feature_clickstream.csv": "fe_1,fe_2,Customer_ID,snapshot_date\n1,x,C1,2023-01-01\n",
}


@pytest.fixture
def sources(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for name, text in RAW.items():
        (folder / name).write_text(text)
    return datamart.raw_sources(spark, str(folder))


@pytest.mark.parametrize("generation", ["typed", "flat"])
def test_one_month_equals_its_part_of_the_backfill(spark, sources, rows, tmp_path, generation):
    assert set(sources) == {"loans", "attributes", "clickstream"}
    full = datamart.run(spark, sources, str(tmp_path / "full"), generation=generation)
    part = datamart.run(spark, sources, str(tmp_path / "part"), ["2023-01-01"], generation)
    for store in ("feature_store", "label_store"):
        whole = tables.read_snapshots(spark, full.table("gold", store)).drop("gold_processing_date")
        month = whole.where("snapshot_date = DATE '2023-01-01'")
        again = tables.read_snapshots_optional(spark, part.table("gold", store))
        if again is None:
            assert month.count() == 0
        else:
            again = again.drop("gold_processing_date")
            assert rows(again.select(*sorted(again.columns))) == rows(month.select(*sorted(month.columns)))


def test_backfill_layers(spark, sources, rows, tmp_path):
    layout = datamart.run(spark, sources, str(tmp_path / "mart"))
    counts = datamart.layer_counts(spark, layout, sources)
    january, july = dt.date(2023, 1, 1), dt.date(2023, 7, 1)
    assert set(rows(counts)) == {
        ("bronze.loans", january, 2), ("bronze.loans", july, 1),
        ("bronze.attributes", january, 1), ("bronze.clickstream", january, 1),
        ("silver.loans", january, 2), ("silver.loans", july, 1),
        ("silver.attributes", january, 1), ("silver.clickstream", january, 1),
        ("gold.feature_store", january, 2), ("gold.label_store", july, 1),
    }
    features = tables.read_snapshots(spark, layout.table("gold", "feature_store"))
    assert rows(features, "loan_id", "age", "fe_1", "fe_2") == [
        ("L1", 0.0, 1.0, 0.0), ("L2", None, None, None),
    ]
    labels = tables.read_snapshots(spark, layout.table("gold", "label_store"))
    assert rows(labels, "loan_id", "label", "dpd") == [("L1", 1, 91)]


def test_one_month_rerun_leaves_the_others(spark, sources, tmp_path):
    root = str(tmp_path / "mart")
    layout = datamart.run(spark, sources, root)
    datamart.run(spark, sources, root, ["2023-01-01"])
    assert tables.read_snapshots(spark, layout.table("silver", "loans")).count() == 3


def test_source_without_dates_needs_one_month(spark, rows):
    frame = spark.createDataFrame([("a",)], "customer_id string")
    assert rows(datamart.bronze(frame, ["2023-01-01"])) == [("a", dt.date(2023, 1, 1))]
    with pytest.raises(ValueError):
        datamart.bronze(frame)


def test_a_month_without_rows_keeps_its_columns(spark, sources, tmp_path):
    layout = datamart.run(spark, sources, str(tmp_path / "mart"), ["2023-03-01"])
    assert datamart.layer_counts(spark, layout, sources).count() == 0


def test_first_available_place(spark, loans, tmp_path):
    path = str(tmp_path / "second")
    tables.write_snapshots(loans, path)
    assert tables.read_first_available(spark, [str(tmp_path / "first"), path]).count() == 15
    assert tables.read_first_available(spark, [str(tmp_path / "first")]) is None


def mart_sources(spark):
    loans = [(f"L{i}", f"C{i % 3}", "1/1/2023" if i % 2 else "2023-02-01", "12", "0", "100.0", "10.0", "10.0", "0.0", "90.0") for i in range(12)]
    names = "loan_id customer_id snapshot_date tenure installment_num loan_amt due_amt paid_amt overdue_amt balance"
    ages = [(f"C{i}", "40", "1/1/2023") for i in range(3)]
    return {
        "loans": spark.createDataFrame(loans, ", ".join(f"{n} string" for n in names.split())),
        "attributes": spark.createDataFrame(ages, "customer_id string, age string, snapshot_date string"),
    }


def writes(monkeypatch):
    """Table, rows, whether regrouped by the writer and thread of each write of the datamart."""
    seen, real = [], datamart.write_snapshots

    def noted(df, path, *args, **kwargs):
        seen.append((path.split("/")[-1], df, kwargs.get("regroup", True), threading.get_ident()))
        return real(df, path, *args, **kwargs)

    monkeypatch.setattr(datamart, "write_snapshots", noted)
    return seen


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_raw_date_is_parsed_once_a_row(spark):
    rows = datamart.bronze(mart_sources(spark)["loans"], ["2023-01-01"])
    assert rows.count() == 6
    assert optimized(rows).lower().count("gettimestamp(") == 2  # once a layout


def test_stamps_are_not_shuffled(spark, tmp_path, monkeypatch):
    for job in (datamart.run, datamart.refresh):
        seen = writes(monkeypatch)
        job(spark, mart_sources(spark), str(tmp_path / job.__name__))
        name, rows, regroup, _ = seen[0]
        above, shuffled, _ = optimized(rows).partition("RebalancePartitions")
        assert shuffled and not regroup and "bronze_ingestion_timestamp" in above


def test_sources_are_built_side_by_side_and_labels_derived_once(spark, tmp_path, monkeypatch):
    seen = writes(monkeypatch)
    layout = datamart.run(spark, mart_sources(spark), str(tmp_path / "flat"), generation="flat")
    assert len({thread for name, _, _, thread in seen if name in ("loans", "attributes")}) == 2
    features = next(rows for name, rows, _, _ in seen if name == "feature_store")
    assert any("/label_store/" in f for f in features.inputFiles())
    assert tables.read_snapshots(spark, layout.table("gold", "feature_store")).where("label IS NULL").count() == 0


def test_a_fault_in_one_source_is_raised(spark, tmp_path):
    broken = mart_sources(spark)
    broken["attributes"] = broken["attributes"].withColumn("age", F.raise_error(F.lit("no age")))
    with pytest.raises(Exception, match="no age"):
        datamart.run(spark, broken, str(tmp_path / "broken"))


def test_refreshed_sources_are_written_tables(spark, tmp_path):
    for name, schema in views.SCHEMAS.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    sources = ingest._written_sources(spark, str(tmp_path))
    for rows in [*sources.values(), *ingest._changed(sources).values()]:
        assert "Join" not in optimized(rows) and "Aggregate" not in optimized(rows)
