"""Loan-shaped views over the given tables.

``loans`` has one row per order and line number (a loan and its month on book); customers give
the attributes and financials, events the click features. Every view exists twice: as a Spark
DataFrame here and as SQL text in :mod:`workload.sql`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loanmart.functions.dates import month_start
from loanmart.operators import cleaning

# Event types behind the click features fe_1 .. fe_5.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
ISO = "yyyy-MM-dd"

# Columns used of the given tables; a known schema saves a job per read.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_returnflag string",
    "events": "event_id bigint, user_id bigint, event_type string, value double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def tenure_of(order_key: str) -> Column:
    return (6 + 2 * (F.col(order_key) % 3)).cast("int")


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw loans, typed, without days past due.

    Line items are aggregated before they are shuffled, so an order with very many items
    arrives as at most one row per line number and task.
    """
    items = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.min("l_extendedprice").alias("px"),
        F.max("l_quantity").alias("q"),
        F.max(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("r"),
    )
    orders = table(spark, sf_dir, "orders")
    late = F.col("px") * (F.col("q").cast("int") % 3 + 1) * F.lit(0.6)
    number = (F.col("l_linenumber") - 1).cast("int")
    due = F.when(F.col("l_linenumber") == 1, F.lit(0.0)).otherwise(F.col("px"))
    overdue = F.when(F.col("r") == 1, late).otherwise(F.lit(0.0))
    start = month_start(F.col("o_orderdate"))
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").cast("string").alias("loan_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        start.alias("loan_start_date"),
        tenure_of("o_orderkey").alias("tenure"),
        number.alias("installment_num"),
        F.col("o_totalprice").alias("loan_amt"),
        due.alias("due_amt"),
        F.greatest(due - overdue, F.lit(0.0)).alias("paid_amt"),
        overdue.alias("overdue_amt"),
        (F.col("o_totalprice") - number * F.col("px")).alias("balance"),
        F.add_months(start, number).alias("snapshot_date"),
    )


def silver_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.silver_loans(loans(spark, sf_dir))


def first_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's side tables carry the month of the first order."""
    return table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(
        month_start(F.min("o_orderdate")).alias("snapshot_date")
    )


def raw_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer attributes as dirty text."""
    key = F.col("c_custkey")
    years = (18 + key % 50).cast("string")
    ssn = F.concat_ws(
        "-",
        F.lpad((key % 1000).cast("string"), 3, "0"),
        F.lpad((key % 100).cast("string"), 2, "0"),
        F.lpad((key % 10000).cast("string"), 4, "0"),
    )
    return (
        table(spark, sf_dir, "customer")
        .join(first_months(spark, sf_dir), key == F.col("k"), "left")
        .select(
            key.cast("string").alias("customer_id"),
            F.col("c_name").alias("name"),
            F.when(key % 121 == 0, "-500")
            .when(key % 20 == 0, F.concat(years, F.lit("_")))
            .otherwise(years)
            .alias("age"),
            F.when(key % 17 == 0, "#F%$D@*&8").otherwise(ssn).alias("ssn"),
            F.when(key % 14 == 0, "_______").otherwise(F.col("c_mktsegment")).alias("occupation"),
            "snapshot_date",
        )
    )


def raw_financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer finances; incomes can be negative."""
    open_debt = F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice"))
    instalment = F.col("o_totalprice") / tenure_of("o_orderkey")
    per_customer = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(
        F.count("o_orderkey").alias("n"),
        F.sum(open_debt).alias("debt"),
        F.sum(instalment).alias("emi"),
        month_start(F.min("o_orderdate")).alias("snapshot_date"),
    )
    income = 12 * F.col("c_acctbal")
    debt = F.coalesce("debt", F.lit(0.0))
    return (
        table(spark, sf_dir, "customer")
        .join(per_customer, F.col("c_custkey") == F.col("k"), "left")
        .select(
            F.col("c_custkey").cast("string").alias("customer_id"),
            F.col("c_acctbal").alias("monthly_inhand_salary"),
            income.alias("annual_income"),
            F.col("c_nationkey").alias("interest_rate"),
            F.coalesce("n", F.lit(0)).alias("num_of_loan"),
            debt.alias("outstanding_debt"),
            F.coalesce("emi", F.lit(0.0)).alias("total_emi_per_month"),
            (debt / (F.abs(income) + 1) * 100).alias("credit_utilization_ratio"),
            "snapshot_date",
        )
    )


def raw_clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click features: event values summed per type."""
    sums = [
        F.coalesce(F.sum(F.when(F.col("event_type") == kind, F.col("value"))), F.lit(0.0)).alias(
            f"fe_{i}"
        )
        for i, kind in enumerate(EVENT_TYPES, 1)
    ]
    clicks = table(spark, sf_dir, "events").groupBy("user_id").agg(*sums)
    return clicks.join(first_months(spark, sf_dir), F.col("user_id") == F.col("k"), "left").select(
        F.col("user_id").cast("string").alias("customer_id"),
        *[f"fe_{i}" for i in range(1, 6)],
        "snapshot_date",
    )


def silver_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.silver_attributes(raw_attributes(spark, sf_dir))


def silver_financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.silver_financials(raw_financials(spark, sf_dir))


def silver_clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.silver_clickstream(raw_clickstream(spark, sf_dir))


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loans at month 0."""
    return cleaning.at_mob(silver_loans(spark, sf_dir), 0)


def dirty_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates as text in two layouts, some unreadable."""
    day = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 50 == 0, "unknown")
        .when(F.col("o_orderkey") % 2 == 0, F.date_format(day, ISO))
        .otherwise(F.date_format(day, "d/M/yyyy"))
        .alias("raw_date"),
    )


def as_text(df: DataFrame) -> DataFrame:
    """All columns as text, as they come from a CSV file."""
    return df.select([F.col(c).cast("string").alias(c) for c in df.columns])


def dirty_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw loans as text: every odd loan writes its snapshot as day/month/year."""
    raw = loans(spark, sf_dir)
    odd = F.col("loan_id").cast("bigint") % 2 == 1
    written = F.when(odd, F.date_format("snapshot_date", "d/M/yyyy")).otherwise(
        F.date_format("snapshot_date", ISO)
    )
    return as_text(raw.withColumn("snapshot_date", written))
