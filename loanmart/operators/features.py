"""Derived features: ratios, engagement, bands, interactions, transforms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import Column, DataFrame, functions as F

from loanmart.functions.numbers import ratio, right_closed_band
from loanmart.operators import ranks
from loanmart.operators.ordered import exact_quantiles

# Bands are closed on the right.
AGE_EDGES = (0, 25, 35, 45, 55, 65, 100)
AGE_LABELS = ("<25", "25-34", "35-44", "45-54", "55-64", "65+")
DTI_EDGES = (0, 0.3, 0.5, 0.7, 1.0, float("inf"))
DTI_LABELS = ("Excellent (5)", "Good (4)", "Fair (3)", "Poor (2)", "Critical (1)")
INCOME_LABELS = ("low", "medium", "high")


def with_ratios(df: DataFrame) -> DataFrame:
    """Income and payment ratios; a zero denominator gives null."""
    return df.withColumns(
        {
            "debt_to_income": ratio(F.col("loan_amt"), F.col("annual_income")),
            "emi_burden": ratio(F.col("total_emi_per_month"), F.col("monthly_inhand_salary")),
            "debt_service_ratio": ratio(F.col("outstanding_debt"), F.col("annual_income")),
            "monthly_payment": ratio(F.col("loan_amt"), F.col("tenure")),
        }
    )


def click_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("fe_")]


def with_engagement(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Sum, number of active features, and the most used one (lowest name on ties)."""
    columns = sorted(columns or click_columns(df))
    values = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in columns}
    largest = F.greatest(*values.values()) if len(columns) > 1 else values[columns[0]]
    favourite = F.coalesce(*[F.when(values[c] == largest, F.lit(c)) for c in columns])
    diversity = sum((values[c] != 0).cast("int") for c in columns)
    return df.withColumns(
        {
            "total_engagement": sum(values.values()),
            "activity_diversity": diversity,
            "favorite_action": F.when(diversity > 0, favourite),
        }
    )


def with_age_group(df: DataFrame, age: str = "age") -> DataFrame:
    return df.withColumn("age_group", right_closed_band(F.col(age), AGE_EDGES, AGE_LABELS))


def dti_band(dti: Column) -> Column:
    return right_closed_band(dti, DTI_EDGES, DTI_LABELS)


def dti_bands(df: DataFrame, dti: str) -> DataFrame:
    """Rows per financial health band; values outside all bands are left out."""
    banded = df.select(dti_band(F.col(dti)).alias("band")).where("band IS NOT NULL")
    return banded.groupBy("band").agg(F.count(F.lit(1)).alias("n"))


def with_income_band(
    df: DataFrame, income: str = "annual_income", cuts: Sequence[float] | None = None
) -> DataFrame:
    """Low, medium, high by explicit cuts or by exact terciles of the data."""
    if cuts is None:
        terciles = exact_quantiles(df.select(income), [income], [1 / 3, 2 / 3])
        edges = terciles.select("q_n").scalar()
        first, second = F.get(edges, F.lit(0)), F.get(edges, F.lit(1))
    else:
        first, second = (F.lit(float(c)) for c in cuts)
    value, (low, medium, high) = F.col(income), INCOME_LABELS
    band = F.when(value <= first, low).when(value <= second, medium)
    return df.withColumn("income_band", band.when(value.isNotNull(), high))


def with_income_band_refined(df: DataFrame, income: str = "annual_income") -> DataFrame:
    """Bands by the exact terciles, found by refining ranges instead of ordering the values."""
    found = ranks.quantiles(df.select(income), [income], [1 / 3, 2 / 3]).first()
    return with_income_band(df, income, found["q_n"] if found else (0.0, 0.0))


def with_interactions(df: DataFrame) -> DataFrame:
    """Products of the pairs that are present, and the squared amount."""
    pairs = {
        "loan_amt_x_utilization": ("loan_amt", "credit_utilization_ratio"),
        "tenure_x_interest_rate": ("tenure", "interest_rate"),
        "age_x_credit_cards": ("age", "num_credit_card"),
        "loan_amt_squared": ("loan_amt", "loan_amt"),
    }
    return df.withColumns(
        {
            name: F.col(a) * F.col(b)
            for name, (a, b) in pairs.items()
            if a in df.columns and b in df.columns
        }
    )


def with_log(df: DataFrame, columns: Sequence[str], threshold: float = 1.0) -> DataFrame:
    """``log1p`` of each column whose skewness exceeds the threshold, else the column as is.

    Values of -1 and below have no logarithm and become null.
    """
    skew = df.agg(F.struct(*[F.skewness(c).alias(c) for c in columns]).alias("s")).scalar()
    logs = {c: F.when(F.col(c) > -1, F.log1p(c)) for c in columns}
    return df.withColumns(
        {
            f"log_{c}": F.when(F.abs(skew[c]) > threshold, logs[c]).otherwise(F.col(c))
            for c in columns
        }
    )


def categories_of(df: DataFrame, column: str) -> list[str]:
    """Distinct labels of a categorical column, sorted: as many names as ``with_one_hot`` adds columns.

    A column whose labels are too many to be columns is for ``with_category_vector``.
    """
    found = df.select(column).where(F.col(column).isNotNull()).distinct()
    return sorted(row[0] for row in found.collect())


def one_hot_names(column: str, categories: Sequence[str]) -> dict[str, str]:
    """``<column>_<category>`` in lower case for each category; where two would share a name, later ones are numbered."""
    names: dict[str, str] = {}
    for label in categories:
        plain = f"{column}_{label.strip().lower().replace(' ', '_')}"
        name, n = plain, 1
        while name in names.values():
            n += 1
            name = f"{plain}_{n}"
        names[label] = name
    return names


def with_one_hot(df: DataFrame, column: str, categories: Sequence[str]) -> DataFrame:
    """A 0/1 column per category; no two categories share one."""
    return df.withColumns(
        {
            name: F.coalesce((F.col(column) == label).cast("int"), F.lit(0))
            for label, name in one_hot_names(column, categories).items()
        }
    )


def with_category_vector(df: DataFrame, column: str, output: str) -> DataFrame:
    """A sparse 0/1 vector over the column's labels in alphabetical order, however many there are; null gives all 0."""
    indexer = StringIndexer(
        inputCol=column, outputCol="_index", handleInvalid="keep", stringOrderType="alphabetAsc"
    ).fit(df.where(F.col(column).isNotNull()))
    encoder = OneHotEncoder(inputCol="_index", outputCol=output, dropLast=True)
    indexed = indexer.transform(df)
    return encoder.fit(indexed).transform(indexed).drop("_index")
