"""Portfolio profiles and data quality."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from loanmart.operators import ranks
from loanmart.operators.bins import bin_start, with_equal_width_bin
from loanmart.operators.ordered import quantiles_of, spread, value_weights

# Limits and plotted ranges of the portfolio reports, and how many values a plotted column may have.
HIGH_VALUE = 50000
DTI_LIMIT, DTI_RANGE = 0.43, (0, 2)
UTILIZATION_LIMIT, UTILIZATION_RANGE = 70, (0, 100)
MAX_CATEGORIES = 15


def share_pct(part: Column, whole: Column) -> Column:
    """Percentage, 0 of nothing being 0."""
    return F.coalesce(100 * F.try_divide(part, whole), F.lit(0.0))


def _n() -> Column:
    return F.count(F.lit(1))


def store_profile(df: DataFrame, *keys: str) -> DataFrame:
    """Rows, distinct keys and date range of a store, in one pass.

    Spark shuffles the distinct keys themselves, so the counting is spread over all tasks.
    """
    return df.agg(
        _n().alias("n_rows"),
        *[F.count_distinct(key).alias(f"n_{key}") for key in keys],
        F.min("snapshot_date").alias("first_snapshot"),
        F.max("snapshot_date").alias("last_snapshot"),
    )


def label_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows and share of each label value; the window sees one row per value."""
    counts = df.groupBy(label).agg(_n().alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return counts.withColumn("share_pct", share_pct(F.col("n"), total)).orderBy(label)


def default_rate(df: DataFrame, label: str = "label") -> DataFrame:
    bad = F.coalesce(F.sum(F.when(F.col(label) == 1, 1)), F.lit(0))
    return df.agg(
        _n().alias("n_loans"),
        bad.alias("n_defaults"),
        share_pct(bad, _n()).alias("default_rate_pct"),
    )


def column_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation and range per column, in one pass."""
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("n"),
            F.avg(c).alias("mean"),
            F.stddev(c).alias("stddev"),
            F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
        )
        for c in columns
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def _texts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in columns])


def _counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    long = _texts(df, columns).unpivot([], list(columns), "column", "value")
    return long.where("value IS NOT NULL").groupBy("column", "value").agg(_n().alias("n"))


def columns_with_few_values(df: DataFrame, columns: Sequence[str], most: int) -> tuple[list[str], list[str]]:
    """Columns that may have at most ``most`` values, and those that certainly have more.

    One pass with a sketch of fixed size a column; no value is shuffled. The sketch holds hashes as they are while they are
    few, so it is off only where two hashes of 26 bits agree. A column is put with those that have more only if the
    estimate is over twice ``most`` and over the error of a large sketch, so none is put there wrongly.
    """
    if not columns:
        return [], []
    sketched = _texts(df, columns).agg(*[F.hll_sketch_estimate(F.hll_sketch_agg(c, F.lit(12))).alias(c) for c in columns])
    found = sketched.first()
    many = [c for c in columns if (found[c] or 0) > 2 * most + 16]
    return [c for c in columns if c not in many], many


def value_counts(
    df: DataFrame, columns: Sequence[str], max_categories: int | None = MAX_CATEGORIES
) -> DataFrame:
    """Rows per value of each column, nulls left out.

    A column with more than ``max_categories`` values is left out as a whole; its values are never shuffled.
    """
    if max_categories is None:
        return _counts(df, columns)
    likely, _ = columns_with_few_values(df, columns, max_categories)
    counts = _counts(df, likely) if likely else _counts(df, columns).where("false")
    few = counts.groupBy("column").agg(_n().alias("k")).where(F.col("k") <= max_categories)
    return counts.join(few.select("column"), "column", "left_semi")


def value_counts_reported(df: DataFrame, columns: Sequence[str], max_categories: int = MAX_CATEGORIES) -> DataFrame:
    """As ``value_counts`` with ``at_least``, null for a value; a column left out is one row without a value, with the number
    of values it is known to have at least."""
    counts = value_counts(df, columns, max_categories).withColumn("at_least", F.lit(None).cast("bigint"))
    likely, many = columns_with_few_values(df, columns, max_categories)
    shown = _counts(df, likely).groupBy("column").agg(_n().alias("k")) if likely else None
    over = df.sparkSession.createDataFrame([(c,) for c in many], "column string")
    if shown is not None:
        over = over.unionByName(shown.where(F.col("k") > max_categories).select("column"))
    nothing = over.select("column", F.lit(None).cast("string").alias("value"), F.lit(None).cast("bigint").alias("n"))
    return counts.unionByName(nothing.withColumn("at_least", F.lit(max_categories + 1).cast("bigint")))


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [name for name, kind in df.dtypes if kind == "string" and name not in exclude]


def flag_share_by_group(df: DataFrame, group: str, flag: Column) -> DataFrame:
    """Share of true and false per group, nulls left out."""
    yes, no = F.count_if(flag), F.count_if(~flag)
    return df.groupBy(group).agg(
        F.try_divide(no, yes + no).alias("share_false"),
        F.try_divide(yes, yes + no).alias("share_true"),
    )


def missing_pct(datasets: Mapping[str, DataFrame], month: str = "data_month") -> DataFrame:
    """Mean percentage of nulls over all columns, per dataset and month."""
    result = None
    for name, df in datasets.items():
        shares = [F.avg(F.col(c).isNull().cast("double")) for c in df.columns]
        rows = df.groupBy(month).agg(
            (100 * sum(shares, F.lit(0.0)) / F.lit(float(len(shares)))).alias("missing_pct")
        )
        rows = rows.select(F.lit(name).alias("dataset"), month, "missing_pct")
        result = rows if result is None else result.unionByName(rows)
    return result


def missing_pct_pivot(missing: DataFrame, months: Sequence[str], month: str = "data_month"):
    return missing.groupBy("dataset").pivot(month, list(months)).agg(F.first("missing_pct"))


def applications_by_month(applications: DataFrame) -> DataFrame:
    return applications.groupBy("snapshot_date").agg(F.count("loan_id").alias("n_applications"))


def mean_per_month(by_month: DataFrame) -> DataFrame:
    return by_month.agg(
        F.sum("n_applications").alias("n_applications"),
        F.avg("n_applications").alias("mean_per_month"),
    )


def multi_application_share(applications: DataFrame) -> DataFrame:
    """Customers with one and with several applications."""
    per_customer = applications.where("customer_id IS NOT NULL").groupBy("customer_id").agg(
        _n().alias("n")
    )
    single, several = F.count_if(F.col("n") == 1), F.count_if(F.col("n") > 1)
    return per_customer.agg(
        single.alias("n_single"),
        several.alias("n_multiple"),
        share_pct(several, _n()).alias("multiple_pct"),
    )


def key_uniqueness(df: DataFrame, key: str) -> DataFrame:
    """Distinct keys as a share of rows; distinct before count, as one key may be most rows."""
    per_key = df.groupBy(key).agg(_n().alias("n"))
    unique, rows = F.count(key), F.sum("n")
    return per_key.agg(
        unique.alias("n_distinct"),
        rows.alias("n_rows"),
        share_pct(unique, rows).alias("uniqueness_pct"),
    )


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair, rows with a null in either left out; one pass."""
    rows = []
    for a, b in combinations(columns, 2):
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        rows.append(
            F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.corr(x, y).alias("corr"))
        )
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def top_correlations(df: DataFrame, columns: Sequence[str], k: int = 5) -> DataFrame:
    known = correlation_pairs(df, columns).where("corr IS NOT NULL AND NOT isnan(corr)")
    return known.orderBy(F.abs("corr").desc(), "a", "b").limit(k)


def activity_totals(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Total and mean per activity column, in one pass."""
    rows = [
        F.struct(
            F.lit(c).alias("activity"),
            F.coalesce(F.sum(c), F.lit(0.0)).alias("total"),
            F.avg(c).alias("mean"),
        )
        for c in columns
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def top_activities(df: DataFrame, columns: Sequence[str], k: int = 5, by: str = "total"):
    return activity_totals(df, columns).orderBy(F.desc(by), "activity").limit(k)


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width histogram with empty bins; the last bin includes the maximum."""
    values = df.select(F.col(column).cast("double").alias("x")).where("x IS NOT NULL")
    ends = values.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi")).alias("e")).scalar()
    binned = with_equal_width_bin(values, "x", ends["lo"], ends["hi"], bins)
    counts = binned.groupBy("bin").agg(_n().alias("n"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return grid.join(counts, "bin", "left").select(
        "bin",
        bin_start(F.col("bin"), ends["lo"], ends["hi"], bins).alias("low"),
        bin_start(F.col("bin") + 1, ends["lo"], ends["hi"], bins).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def boxplot_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers (outermost values within 1.5 times the quartile distance) and the
    number of values beyond them. One row per column is broadcast."""
    slices = spread(value_weights(df.select(*columns), columns), ["feature"], "value")
    quartiles = quantiles_of(slices, ["feature"], [0.25, 0.5, 0.75])
    q1, median, q3 = (F.element_at("q_n", i) for i in (1, 2, 3))
    reach = 1.5 * (q3 - q1)
    inside = F.col("value").between(q1 - reach, q3 + reach)
    fenced = (
        slices.join(F.broadcast(quartiles), "feature")
        .groupBy("feature", "q_n")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.sum(F.when(~inside, F.col("n")).otherwise(0)).alias("n_outliers"),
        )
    )
    return fenced.select(
        "feature",
        "whisker_low",
        q1.alias("q1"),
        median.alias("median"),
        q3.alias("q3"),
        "whisker_high",
        "n_outliers",
    )


def most_common(df: DataFrame, column: str) -> DataFrame:
    """Mode; the lowest value wins a tie."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(_n().alias("n"))
    return counts.orderBy(F.desc("n"), column).limit(1)


def _spread(df: DataFrame, column: str) -> Column:
    """Minimum, median and maximum of a column as a struct, nulls where it has no value."""
    found = ranks.spread_of(df.select(column), [column])
    return found.agg(F.struct(*[F.max(c).alias(c) for c in ("min", "median", "max")]).alias("s")).scalar()


def applicant_facts(attributes: DataFrame, financials: DataFrame, dti: str) -> dict[str, Column]:
    """Ranges and medians of age, income and debt-to-income ratio, as columns to put beside others."""
    age, income, debt = _spread(attributes, "age"), _spread(financials, "annual_income"), _spread(financials, dti)
    return {
        "min_age": age["min"], "max_age": age["max"], "median_age": age["median"],
        "min_income": income["min"], "max_income": income["max"], "median_income": income["median"],
        "median_dti": debt["median"],
    }


def application_profile(applications: DataFrame) -> DataFrame:
    """Amount and tenure of the applications in one row.

    The data are read once: everything follows from the counts of the distinct values.
    """
    columns = ["loan_amt", "tenure"]
    slices = spread(value_weights(applications.select(*columns), columns), ["feature"], "value")
    value, n = F.col("value"), F.col("n")
    # most rows first, then the lowest value
    mode = F.max(F.struct("n", (-value).alias("v")))["v"] * -1
    facts = slices.groupBy("feature").agg(
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.coalesce(F.sum(F.when(value >= HIGH_VALUE, n)), F.lit(0)).alias("n_high"),
        F.sum("n").alias("n"),
        mode.alias("mode"),
    )
    facts = facts.join(quantiles_of(slices, ["feature"], [0.5]), "feature")

    def of(feature: str, fact: Column) -> Column:
        return F.max(F.when(F.col("feature") == feature, fact))

    median = F.element_at("q_n", 1)
    high = F.coalesce(of("loan_amt", F.col("n_high")), F.lit(0))
    return facts.agg(
        of("loan_amt", F.col("min")).alias("min_amount"),
        of("loan_amt", F.col("max")).alias("max_amount"),
        high.alias("n_high_value"),
        share_pct(high, of("loan_amt", F.col("n"))).alias("high_value_pct"),
        of("loan_amt", median).alias("median_amount"),
        of("tenure", median).alias("median_tenure"),
        of("tenure", F.col("mode")).cast("int").alias("mode_tenure"),
    )


def risk_shares(df: DataFrame, dti: str, utilization: str) -> DataFrame:
    """Shares above the debt and utilisation limits, and values inside the plotted ranges."""
    d, u = F.col(dti), F.col(utilization)
    return df.agg(
        F.count(d).alias("n_dti"),
        F.count_if(d.between(*DTI_RANGE)).alias("n_dti_plotted"),
        share_pct(F.count_if(d > DTI_LIMIT), F.count(d)).alias("high_dti_pct"),
        F.count(u).alias("n_utilization"),
        F.count_if(u.between(*UTILIZATION_RANGE)).alias("n_utilization_plotted"),
        share_pct(F.count_if(u > UTILIZATION_LIMIT), F.count(u)).alias("high_utilization_pct"),
    )


def distinct_over_tables(tables: Sequence[DataFrame], key: str) -> DataFrame:
    """Number of distinct keys found in any of several tables."""
    ids = None
    for table in tables:
        own = table.select(key).where(F.col(key).isNotNull())
        ids = own if ids is None else ids.unionByName(own)
    return ids.distinct().agg(_n().alias("n_distinct"))


def stable_sample(df: DataFrame, key: Sequence[str], n: int = 1000) -> DataFrame:
    """At most ``n`` rows in the order of the key's hash: random, yet the same every run."""
    return df.orderBy(F.md5(F.concat_ws("|", *key)), *key).limit(n)


def union_by_name(tables: Sequence[DataFrame]) -> DataFrame:
    """Bag union; a column a table lacks is null there."""
    result = tables[0]
    for table in tables[1:]:
        result = result.unionByName(table, allowMissingColumns=True)
    return result
