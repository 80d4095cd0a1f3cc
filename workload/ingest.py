"""Sources, sinks, cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanmart.functions import dates, text
from loanmart.operators import cleaning, snapshots
from loanmart.plans import datamart
from loanmart.session import cut_lineage, scratch_path
from loanmart.sources import inferred, raw, registry, tables
from workload import views
from workload.registry import query

LOAN_KEYS = "loan_id, customer_id, installment_num, snapshot_date"
ATTRIBUTES = "customer_id, name, age, ssn, occupation, snapshot_date"


@query(f"SELECT {ATTRIBUTES} FROM raw_attributes WHERE snapshot_date IS NOT NULL", dates="snapshot_date")
def bronze_ingest(spark, sf_dir):
    """Raw CSV, written and read as text, to bronze rows of every month."""
    path = scratch_path(spark, "raw-attributes")
    raw.write_csv(views.raw_attributes(spark, sf_dir), path)
    return datamart.bronze(raw.read_raw(spark, path)).select(*ATTRIBUTES.split(", "))


@query(
    "SELECT loan_id, customer_id, cast(installment_num AS varchar) installment_num, snapshot_date FROM loans",
    dates="snapshot_date",
)
def bronze_ingest_normalized(spark, sf_dir):
    """Text rows in two date layouts to bronze rows."""
    return datamart.bronze(views.dirty_loans(spark, sf_dir)).select(*LOAN_KEYS.split(", "))


@query(
    "SELECT customer_id, annual_income, num_of_loan, outstanding_debt, snapshot_date FROM raw_financials",
    rounded="annual_income outstanding_debt", dates="snapshot_date", ints="num_of_loan",
)
def csv_roundtrip(spark, sf_dir):
    """CSV out and back in under an explicit schema."""
    columns = ["customer_id", "annual_income", "num_of_loan", "outstanding_debt", "snapshot_date"]
    rows = views.raw_financials(spark, sf_dir).select(*columns)
    path = scratch_path(spark, "csv-financials")
    raw.write_csv(rows, path)
    return raw.read_raw(spark, path, rows.schema)


def _written_loans(spark, sf_dir):
    path = scratch_path(spark, "silver-loans")
    tables.write_snapshots(views.silver_loans(spark, sf_dir), path)
    return path


@query(
    f"SELECT {LOAN_KEYS}, dpd FROM silver_loans WHERE snapshot_date = DATE '1997-03-01'",
    dates="snapshot_date",
)
def partition_scan(spark, sf_dir):
    """One month of a partitioned table; other months are not opened."""
    month = tables.read_snapshots(spark, _written_loans(spark, sf_dir), ["1997-03-01"])
    return month.select(*LOAN_KEYS.split(", "), "dpd")


@query(
    "SELECT snapshot_date, mob, count(*) n_rows, sum(loan_amt) amount FROM silver_loans GROUP BY 1, 2",
    rounded="amount", digits=2, dates="snapshot_date", ints="n_rows",
)
def all_months_scan(spark, sf_dir):
    """All months of a partitioned table."""
    table = tables.read_snapshots(spark, _written_loans(spark, sf_dir))
    return table.groupBy("snapshot_date", "mob").agg(
        F.count("*").alias("n_rows"), F.sum("loan_amt").alias("amount")
    )


@query(
    """SELECT loan_id, mob, dpd, snapshot_date, strftime(snapshot_date, '%b %Y') data_month FROM silver_loans
       WHERE snapshot_date IN (DATE '1997-01-01', DATE '1997-02-01', DATE '1990-01-01')""",
    dates="snapshot_date",
)
def load_months(spark, sf_dir):
    """Listed months, the missing one skipped, each row tagged with its month."""
    months = ["1997-01-01", "1997-02-01", "1990-01-01"]
    listed = snapshots.listed_months(views.silver_loans(spark, sf_dir), months)
    return listed.select("loan_id", "mob", "dpd", "snapshot_date", "data_month")


@query(
    "SELECT snapshot_date, count(*) n_rows FROM silver_loans GROUP BY 1",
    dates="snapshot_date", ints="n_rows",
)
def idempotent_overwrite(spark, sf_dir):
    """Writing one month again leaves the table as it was."""
    path = _written_loans(spark, sf_dir)
    again = snapshots.only_month(views.silver_loans(spark, sf_dir), "1997-03-01")
    tables.write_snapshots(again, path)
    return tables.read_snapshots(spark, path).groupBy("snapshot_date").agg(
        F.count("*").alias("n_rows")
    )


@query(
    f"SELECT {LOAN_KEYS} FROM loans WHERE snapshot_date = (SELECT max(snapshot_date) FROM loans)",
    dates="snapshot_date",
)
def latest_snapshot(spark, sf_dir):
    """The newest month, as the wanted one does not exist."""
    loans = views.loans(spark, sf_dir)
    return tables.at_latest_snapshot(loans, "2030-01-01").select(*LOAN_KEYS.split(", "))


@query(
    """SELECT name, path, created_at FROM
         (SELECT *, row_number() OVER (PARTITION BY name ORDER BY created_at DESC, path DESC) k FROM
           (SELECT o_orderpriority AS name, 'model_' || o_orderkey AS path,
                   cast(o_orderdate AS date) created_at FROM orders)) WHERE k = 1""",
    dates="created_at",
)
def latest_artifact(spark, sf_dir):
    """Newest entry per name of a registry-shaped table."""
    entries = views.table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("name"),
        F.concat(F.lit("model_"), F.col("o_orderkey").cast("string")).alias("path"),
        F.col("o_orderdate").cast("date").alias("created_at"),
    )
    return registry.latest_artifact(entries, ["name"])


@query(
    """SELECT cast(unnest(generate_series(date_trunc('month', min(o_orderdate)), max(o_orderdate),
                                          INTERVAL 1 MONTH)) AS date) snapshot_date FROM orders""",
    dates="snapshot_date",
)
def snapshot_calendar(spark, sf_dir):
    """Every month between the first and the last order."""
    return snapshots.calendar(views.table(spark, sf_dir, "orders"), "o_orderdate")


@query(
    """SELECT 'all' AS output, snapshot_date, count(*) n_rows FROM silver_loans GROUP BY ALL
       UNION ALL SELECT 'mob0', snapshot_date, count(*) FROM applications GROUP BY ALL""",
    dates="snapshot_date", ints="n_rows",
)
def silver_two_outputs(spark, sf_dir):
    """The table of all months on book and its month-0 part, both written."""
    every, first = _written_loans(spark, sf_dir), scratch_path(spark, "silver-loans-mob0")
    tables.write_snapshots(cleaning.at_mob(tables.read_snapshots(spark, every), 0), first)
    counts = [
        snapshots.rows_by_month(tables.read_snapshots(spark, path), name)
        for name, path in (("all", every), ("mob0", first))
    ]
    return counts[0].unionByName(counts[1]).withColumnRenamed("layer", "output")


BACKFILL_SQL = " UNION ALL ".join(
    f"SELECT '{layer}' AS layer, snapshot_date, count(*) n_rows FROM {view} "
    "WHERE snapshot_date IS NOT NULL GROUP BY ALL"
    for layer, view in {
        "bronze.loans": "loans",
        "bronze.attributes": "raw_attributes",
        "bronze.financials": "raw_financials",
        "bronze.clickstream": "clickstream",
        "silver.loans": "silver_loans",
        "silver.attributes": "attributes",
        "silver.financials": "financials",
        "silver.clickstream": "clickstream",
        "gold.feature_store": "features",
        "gold.label_store": "labels_a1",
    }.items()
)


def raw_sources(spark, sf_dir):
    return {
        "loans": views.dirty_loans(spark, sf_dir),
        "attributes": views.as_text(views.raw_attributes(spark, sf_dir)),
        "financials": views.as_text(views.raw_financials(spark, sf_dir)),
        "clickstream": views.as_text(views.raw_clickstream(spark, sf_dir)),
    }


@query(BACKFILL_SQL, dates="snapshot_date", ints="n_rows")
def backfill_counts(spark, sf_dir):
    """The whole datamart written from text sources; rows per table and month."""
    sources = raw_sources(spark, sf_dir)
    layout = datamart.run(spark, sources, scratch_path(spark, "datamart"))
    return datamart.layer_counts(spark, layout, sources)


@query(f"SELECT {LOAN_KEYS} FROM loans WHERE snapshot_date = DATE '1997-03-01'", dates="snapshot_date")
def snapshot_filter(spark, sf_dir):
    rows = snapshots.only_month(views.loans(spark, sf_dir), "1997-03-01")
    return rows.select(*LOAN_KEYS.split(", "))


@query(
    "SELECT c_custkey, c_mktsegment, DATE '1997-03-01' snapshot_date FROM customer",
    dates="snapshot_date",
)
def default_snapshot(spark, sf_dir):
    """A source without snapshot dates gets the month being processed."""
    customers = views.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return snapshots.with_default_snapshot(customers, "1997-03-01")


@query(
    """SELECT o_orderkey, raw_date,
              coalesce(try_strptime(raw_date, '%Y-%m-%d'), try_strptime(raw_date, '%-d/%-m/%Y')) AS parsed
       FROM dirty_dates""",
    dates="parsed",
)
def normalize_date(spark, sf_dir):
    """Two date layouts; unreadable text gives null."""
    rows = views.dirty_dates(spark, sf_dir)
    return rows.withColumn("parsed", dates.parse_date(F.col("raw_date")))


@query(
    """SELECT o_orderkey, cast(date_trunc('month', o_orderdate) AS date) month_start,
              strftime(date_trunc('month', o_orderdate), '%Y_%m_%d') tag FROM orders""",
    dates="month_start",
)
def month_start(spark, sf_dir):
    day = F.col("o_orderdate")
    return views.table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.month_start(day).alias("month_start"), dates.month_tag(day).alias("tag")
    )


@query(
    """SELECT o_orderkey, cast(date_trunc('month', o_orderdate) AS date) snapshot_date FROM orders""",
    dates="snapshot_date",
)
def tag_to_date(spark, sf_dir):
    """The date inside a path."""
    tag = dates.month_tag(F.col("o_orderdate"))
    path = F.concat(F.lit("gold/gold_feature_store_"), tag, F.lit(".parquet"))
    return views.table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.tag_to_date(path).alias("snapshot_date")
    )


@query(
    """SELECT customer_id, name, try_cast(age AS double) age, ssn, occupation, snapshot_date
       FROM raw_attributes""",
    rounded="age", dates="snapshot_date",
)
def typed_projection(spark, sf_dir):
    """Text to declared types; what does not fit is null."""
    rows = views.as_text(views.raw_attributes(spark, sf_dir))
    return cleaning.typed(rows, cleaning.ATTRIBUTE_TYPES)


@query(
    "SELECT customer_id, fe_1, fe_2, fe_3, fe_4, fe_5, snapshot_date FROM clickstream",
    rounded="fe_1 fe_2 fe_3 fe_4 fe_5", dates="snapshot_date",
)
def click_cast(spark, sf_dir):
    """Only the click features are cast, by prefix."""
    rows = views.as_text(views.raw_clickstream(spark, sf_dir))
    cast = cleaning.cast_prefix(rows, "fe_")
    return cast.withColumn("snapshot_date", F.col("snapshot_date").cast("date"))


@query(
    """SELECT user_key, event_type, value FROM
         (SELECT CASE WHEN event_id % 7 = 0 THEN NULL ELSE user_id END user_key, event_type, value FROM events)
       WHERE user_key IS NOT NULL""",
    rounded="value",
)
def require_keys(spark, sf_dir):
    rows = views.table(spark, sf_dir, "events").select(
        F.when(F.col("event_id") % 7 != 0, F.col("user_id")).alias("user_key"),
        "event_type",
        "value",
    )
    return cleaning.require_keys(rows, "user_key")


@query(
    """SELECT loan_id, mob, loan_amt FROM
         (SELECT loan_id, installment_num mob, loan_amt - 250000 loan_amt FROM loans) WHERE loan_amt > 0""",
    rounded="loan_amt",
)
def valid_loans(spark, sf_dir):
    rows = views.loans(spark, sf_dir).select(
        "loan_id", F.col("installment_num").alias("mob"), (F.col("loan_amt") - 250000).alias("loan_amt")
    )
    return cleaning.valid_loans(rows)


@query(
    """SELECT loan_id, coalesce(dpd, 0) dpd, coalesce(loan_amt, 0) loan_amt,
              coalesce(annual_income, 0) annual_income
       FROM applications a LEFT JOIN financials f
         ON a.customer_id = f.customer_id AND a.snapshot_date = f.snapshot_date""",
    rounded="loan_amt annual_income",
)
def fill_numeric(spark, sf_dir):
    """Nulls of numeric columns become 0."""
    keys = ["customer_id", "snapshot_date"]
    finances = views.silver_financials(spark, sf_dir).select(*keys, "annual_income")
    rows = views.applications(spark, sf_dir).join(finances, keys, "left")
    return cleaning.fill_numeric(rows.select("loan_id", "dpd", "loan_amt", "annual_income"))


@query(
    """SELECT event_id, CASE WHEN event_id % 5 IN (0, 1) THEN NULL ELSE value END AS value,
              CASE WHEN event_id % 3 = 0 THEN NULL ELSE value * 2 END doubled FROM events""",
    rounded="value doubled",
)
def inf_to_null(spark, sf_dir):
    """Both infinities become null."""
    infinity = F.lit(float("inf"))
    value, key = F.col("value"), F.col("event_id")
    rows = views.table(spark, sf_dir, "events").select(
        "event_id",
        F.when(key % 5 == 0, infinity).when(key % 5 == 1, -infinity).otherwise(value).alias("value"),
        F.when(key % 3 == 0, infinity).otherwise(value * 2).alias("doubled"),
    )
    return cleaning.infinite_to_null(rows, ["value", "doubled"])


@query("SELECT loan_id, customer_id, installment_num, loan_amt FROM loans", rounded="loan_amt")
def drop_system_columns(spark, sf_dir):
    """Lineage columns added and dropped again; names that are absent do not matter."""
    rows = views.loans(spark, sf_dir).select(
        "loan_id", "customer_id", "installment_num", "loan_amt", "snapshot_date"
    )
    return cleaning.drop_system_columns(snapshots.with_lineage(rows, "bronze"))


@query(
    "SELECT loan_id, customer_id, loan_amt, snapshot_date FROM silver_loans WHERE mob = 0",
    rounded="loan_amt", dates="snapshot_date",
)
def mob0_loans(spark, sf_dir):
    loans = cleaning.with_mob(views.loans(spark, sf_dir))
    rows = cleaning.at_mob(cleaning.valid_loans(loans), 0)
    return rows.select("loan_id", "customer_id", "loan_amt", "snapshot_date")


@query(
    """SELECT customer_id, name,
              CASE WHEN try_cast(rtrim(age, '_') AS double) BETWEEN 0 AND 120
                   THEN try_cast(rtrim(age, '_') AS double) END age,
              CASE WHEN regexp_full_match(ssn, '[0-9]{3}-[0-9]{2}-[0-9]{4}') THEN ssn END ssn,
              CASE WHEN replace(occupation, '_', '') <> '' THEN occupation END occupation, snapshot_date
       FROM raw_attributes""",
    rounded="age", dates="snapshot_date",
)
def repair_attributes(spark, sf_dir):
    """The opt-in cleaning that mends what can be mended."""
    return cleaning.silver_attributes(views.raw_attributes(spark, sf_dir), "repair")


@query(
    """SELECT customer_id, ssn, CASE WHEN regexp_full_match(ssn, '[0-9]{3}-[0-9]{2}-[0-9]{4}')
              THEN 1 ELSE 0 END ssn_valid FROM raw_attributes""",
)
def ssn_validity(spark, sf_dir):
    valid = text.ssn_is_valid(F.col("ssn")).cast("int").alias("ssn_valid")
    return views.raw_attributes(spark, sf_dir).select("customer_id", "ssn", valid)


@query(
    """SELECT snapshot_date, count(*) n_loans, sum(CASE WHEN dpd IS NULL THEN 1 ELSE 0 END) n_null_dpd,
              max(dpd) max_dpd, sum(installments_missed) n_missed
       FROM silver_loans GROUP BY 1""",
    dates="snapshot_date", ints="n_loans n_null_dpd n_missed",
)
def silver_from_text(spark, sf_dir):
    """Text rows through bronze and silver in one plan."""
    silver = datamart.silver("loans", datamart.bronze(views.dirty_loans(spark, sf_dir)))
    return silver.groupBy("snapshot_date").agg(
        F.count("*").alias("n_loans"),
        F.count_if(F.col("dpd").isNull()).alias("n_null_dpd"),
        F.max("dpd").alias("max_dpd"),
        F.sum("installments_missed").alias("n_missed"),
    )


@query(
    """SELECT layer, snapshot_date, n_rows FROM (
         SELECT 'bronze.loans' AS layer, snapshot_date, count(*) n_rows FROM loans GROUP BY ALL
         UNION ALL SELECT 'silver.loans', snapshot_date, count(*) FROM silver_loans GROUP BY ALL
         UNION ALL SELECT 'gold.feature_store', snapshot_date, count(*) FROM silver_loans WHERE mob = 0 GROUP BY ALL
         UNION ALL SELECT 'gold.label_store', snapshot_date, count(*) FROM labels_a1 GROUP BY ALL)
       WHERE snapshot_date IN (DATE '1997-01-01', DATE '1997-03-01')""",
    dates="snapshot_date", ints="n_rows",
)
def rerun_emptied_month(spark, sf_dir):
    """Three months written, one rerun after its rows have gone: no layer keeps them."""
    loans, root = views.loans(spark, sf_dir), scratch_path(spark, "datamart")
    months = ["1997-01-01", "1997-02-01", "1997-03-01"]
    layout = datamart.run(spark, {"loans": views.as_text(loans)}, root, months)
    emptied = loans.where("snapshot_date <> DATE '1997-02-01'")
    datamart.run(spark, {"loans": views.as_text(emptied)}, root, months[1:2])
    return datamart.layer_counts(spark, layout, ["loans"])


@query(
    "SELECT snapshot_date, count(*) n_rows, sum(loan_amt) amount FROM silver_loans GROUP BY 1",
    rounded="amount", digits=2, dates="snapshot_date", ints="n_rows",
)
def failed_write(spark, sf_dir):
    """All months rewritten by a job that breaks while it writes: readers find the months as they were."""
    path = _written_loans(spark, sf_dir)
    held = tables.read_snapshots(spark, path)
    broken = F.when(F.xxhash64("loan_id", "mob") % 100 == 0, F.raise_error(F.lit("no such rate"))).otherwise(F.col("loan_amt") + 1)
    try:
        tables.write_snapshots(held.withColumn("loan_amt", broken), path, whole=True)
    except Exception as fault:
        if "no such rate" not in str(fault):
            raise
    return tables.read_snapshots(spark, path).groupBy("snapshot_date").agg(F.count("*").alias("n_rows"), F.sum("loan_amt").alias("amount"))


REFRESH_SQL = """
    WITH l AS (SELECT DISTINCT snapshot_date FROM loans WHERE cast(loan_id AS bigint) % 5000 = 1),
         a AS (SELECT DISTINCT snapshot_date FROM raw_attributes WHERE cast(customer_id AS bigint) % 400 = 1 AND snapshot_date IS NOT NULL),
         g AS (SELECT snapshot_date FROM l UNION SELECT a.snapshot_date FROM a WHERE a.snapshot_date IN (SELECT snapshot_date FROM loans))
    SELECT 'bronze' AS layer, 'loans' AS dataset, snapshot_date FROM l UNION ALL SELECT 'silver', 'loans', snapshot_date FROM l
    UNION ALL SELECT 'bronze', 'attributes', snapshot_date FROM a UNION ALL SELECT 'silver', 'attributes', snapshot_date FROM a
    UNION ALL SELECT 'gold', 'feature_store', snapshot_date FROM g UNION ALL SELECT 'gold', 'label_store', snapshot_date FROM l"""


def _written_sources(spark, sf_dir):
    """The text sources as files, as a datamart gets them: a refresh reads each twice, to digest it and to build from it."""
    return {name: cut_lineage(rows) for name, rows in raw_sources(spark, sf_dir).items()}


def _changed(found):
    """Some loans are a little larger, some customers have another occupation, a text no number is made of differs."""
    loan, customer = F.col("loan_id").cast("bigint"), F.col("customer_id").cast("bigint")
    grown = F.when(loan % 5000 == 1, (F.col("loan_amt").cast("double") + 1).cast("string")).otherwise(F.col("loan_amt"))
    moved = F.when(customer % 400 == 1, F.lit("clerk")).otherwise(F.col("occupation"))
    return found | {
        "loans": found["loans"].withColumn("loan_amt", grown), "attributes": found["attributes"].withColumn("occupation", moved),
    }


@query(REFRESH_SQL, dates="snapshot_date")
def incremental_refresh(spark, sf_dir):
    """The months of each table that a second run builds anew after some rows of two sources have changed."""
    root, sources = scratch_path(spark, "datamart"), _written_sources(spark, sf_dir)
    datamart.refresh(spark, sources, root)
    _, built = datamart.refresh(spark, _changed(sources), root)
    return spark.createDataFrame(built, "layer string, dataset string, snapshot_date string").withColumn(
        "snapshot_date", F.col("snapshot_date").cast("date")
    )


@query(BACKFILL_SQL, dates="snapshot_date", ints="n_rows")
def refreshed_counts(spark, sf_dir):
    """Rows per table and month after two refreshes, the second after a change: as many as a backfill writes."""
    root, sources = scratch_path(spark, "datamart"), _written_sources(spark, sf_dir)
    datamart.refresh(spark, _changed(sources), root)
    layout, _ = datamart.refresh(spark, sources, root)
    return datamart.layer_counts(spark, layout, sources)


TURNED = ("1996-01-01", "1996-02-01", "1996-03-01")


@query(
    """SELECT m.snapshot_date, count(f.customer_id) n_rows, sum(cast(f.outstanding_debt AS double)) debt,
              count(f.annual_income) n_income, 'string' income_type, 'double' debt_type, 'bigint' rate_type
       FROM (SELECT unnest([DATE '1996-01-01', DATE '1996-02-01', DATE '1996-03-01']) snapshot_date) m
       LEFT JOIN raw_financials f ON f.snapshot_date = m.snapshot_date GROUP BY 1""",
    rounded="debt", digits=2, dates="snapshot_date", ints="n_rows n_income",
)
def widened_column(spark, sf_dir):
    """Three months written one after the other; in the third some incomes are words. All three are read, with one type a column."""
    path = scratch_path(spark, "inferred")
    rows = views.as_text(views.raw_financials(spark, sf_dir)).where(F.col("snapshot_date").isin(*TURNED))
    words = (F.col("snapshot_date") == TURNED[2]) & (F.col("customer_id").cast("bigint") % 2 == 0)
    spoiled = rows.withColumn("annual_income", F.when(words, "not told").otherwise(F.col("annual_income")))
    for month in TURNED:
        one = spoiled.where(F.col("snapshot_date") == month)
        inferred.write_inferred(one.withColumn("snapshot_date", F.col("snapshot_date").cast("date")), path, months=[month])
    table = inferred.read_inferred(spark, path)
    kinds = dict(table.dtypes)
    return table.groupBy("snapshot_date").agg(
        F.count("*").alias("n_rows"), F.sum("outstanding_debt").alias("debt"), F.count("annual_income").alias("n_income")
    ).withColumns({f"{n}_type": F.lit(kinds[c]) for n, c in (("income", "annual_income"), ("debt", "outstanding_debt"), ("rate", "interest_rate"))})


REJECTED = {
    "marked": """
        SELECT CASE cast(loan_id AS bigint) % 50 WHEN 10 THEN 'unreadable date' WHEN 11 THEN 'not the first of a month'
                    WHEN 12 THEN 'no key' WHEN 13 THEN 'no amount' WHEN 14 THEN 'no amount' ELSE 'kept' END reason FROM loans""",
}


@query(
    "SELECT reason, count(*) n_rows, true adds_up FROM marked GROUP BY 1",
    ints="n_rows", views=REJECTED,
)
def rejected_rows(spark, sf_dir):
    """Raw loans spoiled in five ways: rows of the silver table, and those left out by reason; together all that came in."""
    loans = views.dirty_loans(spark, sf_dir)
    kind = F.col("loan_id").cast("bigint") % 50
    spoiled = loans.withColumns(
        {
            "snapshot_date": F.when(kind == 10, "unknown").when(kind == 11, "1997-03-15").otherwise(F.col("snapshot_date")),
            "customer_id": F.when(kind != 12, F.col("customer_id")),
            "loan_amt": F.when(kind == 13, "-5").when(kind == 14, "a lot").otherwise(F.col("loan_amt")),
        }
    )
    layout = datamart.Layout(scratch_path(spark, "datamart"))
    counts = datamart.bronze_with_rejects(spark, layout, "loans", spoiled)
    silver = datamart.silver("loans", tables.read_snapshots(spark, layout.table("bronze", "loans")).drop(*datamart.LINEAGE))
    rejects = tables.read_snapshots(spark, layout.table("rejects", "loans"), month="reason")
    kept = silver.select(F.lit("kept").alias("reason"))
    rows = kept.unionByName(rejects.select("reason")).groupBy("reason").agg(F.count("*").alias("n_rows"))
    observed = {**{r: counts[r] for r in datamart.REASONS}, "kept": counts["raw"] - sum(counts[r] for r in datamart.REASONS)}
    expected = F.create_map(*[F.lit(x) for pair in observed.items() for x in pair])
    return rows.withColumn("adds_up", F.element_at(expected, F.col("reason")) == F.col("n_rows"))


FLAT_SQL = " UNION ALL ".join(
    f"SELECT '{layer}' AS layer, snapshot_date, count(*) n_rows FROM {view} "
    "WHERE snapshot_date IS NOT NULL GROUP BY ALL"
    for layer, view in {
        "bronze.loans": "loans",
        "bronze.attributes": "raw_attributes",
        "bronze.financials": "raw_financials",
        "bronze.clickstream": "clickstream",
        "silver.loans": "flat_loans",
        "silver.attributes": "raw_attributes",
        "silver.financials": "raw_financials",
        "silver.clickstream": "clickstream",
        "gold.feature_store": "states",
        "gold.label_store": "labels_a2",
    }.items()
)


def _flat_datamart(spark, sf_dir):
    sources = raw_sources(spark, sf_dir)
    return sources, datamart.run(spark, sources, scratch_path(spark, "datamart"), generation="flat")


@query(FLAT_SQL, dates="snapshot_date", ints="n_rows")
def backfill_counts_flat(spark, sf_dir):
    """The datamart of the flat generation."""
    sources, layout = _flat_datamart(spark, sf_dir)
    return datamart.layer_counts(spark, layout, sources)


@query(
    """SELECT unnest(['loan_amt', 'tenure', 'mob', 'monthly_inhand_salary', 'annual_income', 'interest_rate', 'num_of_loan',
                      'outstanding_debt', 'total_emi_per_month', 'credit_utilization_ratio', 'fe_1', 'fe_2', 'fe_3', 'fe_4', 'fe_5']) feature"""
)
def gold_types_flat(spark, sf_dir):
    """What training finds numeric in the flat gold table."""
    _, layout = _flat_datamart(spark, sf_dir)
    rows = tables.read_snapshots(spark, layout.table("gold", "feature_store"))
    names = cleaning.numeric_columns(rows, ["label"])
    return spark.range(1).select(F.explode(F.array(*[F.lit(n) for n in names])).alias("feature"))


@query("SELECT count(*) n_rows, count(DISTINCT snapshot_date) n_months FROM silver_loans")
def first_available(spark, sf_dir):
    """The first place that holds the table; the one before it does not exist."""
    places = [scratch_path(spark, "nowhere"), _written_loans(spark, sf_dir)]
    found = tables.read_first_available(spark, places)
    return found.agg(F.count("*").alias("n_rows"), F.count_distinct("snapshot_date").alias("n_months"))


@query("SELECT count(*) n_rows, false other_found FROM raw_attributes", ints="n_rows")
def optional_sources(spark, sf_dir):
    """Raw files that exist; the others are left out."""
    folder = scratch_path(spark, "raw")
    raw.write_csv(views.raw_attributes(spark, sf_dir), f"{folder}/{datamart.RAW_FILES['attributes']}")
    found = datamart.raw_sources(spark, folder)
    counted = found["attributes"].agg(F.count("*").alias("n_rows"))
    return counted.withColumn("other_found", F.lit(len(found) > 1))


@query(
    "SELECT loan_id, mob, strftime(snapshot_date, '%Y-%m-%d') silver_processing_date, true stamped FROM silver_loans"
)
def lineage_columns(spark, sf_dir):
    """Processing month as text, and a clock that is only known to be there."""
    rows = snapshots.with_lineage(views.silver_loans(spark, sf_dir), "silver")
    stamped = F.col("silver_ingestion_timestamp").isNotNull()
    return rows.select("loan_id", "mob", "silver_processing_date", stamped.alias("stamped"))


@query("SELECT loan_id, mob, overdue_amt amount FROM silver_loans", rounded="amount")
def first_present_column(spark, sf_dir):
    """The first of several spellings that the table has."""
    rows = views.silver_loans(spark, sf_dir)
    return rows.select("loan_id", "mob", F.col(cleaning.first_present(rows, ["amt_overdue", "overdue_amt", "balance"])).alias("amount"))


@query(
    """SELECT max(snapshot_date) latest FROM (
         SELECT snapshot_date FROM loans UNION ALL SELECT snapshot_date FROM attributes)
       WHERE snapshot_date IN (DATE '1996-05-01', DATE '1997-03-01', DATE '2030-01-01')""",
    dates="latest",
)
def newest_listed_snapshot(spark, sf_dir):
    """Newest of the wanted months that some table holds."""
    held = [views.loans(spark, sf_dir), views.silver_attributes(spark, sf_dir)]
    newest = tables.newest_listed_snapshot(held, ["1996-05-01", "1997-03-01", "2030-01-01"])
    return spark.range(1).select(newest.alias("latest"))
