"""Silver layer: typed, cleaned tables from raw text."""

from __future__ import annotations

from collections.abc import Collection, Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from loanmart.functions import delinquency, text
from loanmart.functions.numbers import finite_or_null, to_double, to_int

# Column types per source; a column that is not listed becomes double.
LOAN_TYPES = {
    "loan_id": "string",
    "customer_id": "string",
    "loan_start_date": "date",
    "tenure": "int",
    "installment_num": "int",
    "loan_amt": "double",
    "due_amt": "double",
    "paid_amt": "double",
    "overdue_amt": "double",
    "balance": "double",
    "snapshot_date": "date",
}
CLICK_TYPES = {"customer_id": "string", "snapshot_date": "date"}
ATTRIBUTE_TYPES = {
    "customer_id": "string",
    "snapshot_date": "date",
    "ssn": "string",
    "name": "string",
    "occupation": "string",
}
FINANCIAL_TYPES = ATTRIBUTE_TYPES
# Financial columns that hold text; the plain rule turns them into 0.0.
FINANCIAL_TEXT = (
    "type_of_loan",
    "credit_mix",
    "credit_history_age",
    "payment_of_min_amount",
    "payment_behaviour",
)
# Operational columns dropped before the gold layer.
SYSTEM_COLUMNS = (
    "bronze_ingestion_timestamp",
    "bronze_processing_date",
    "silver_processing_date",
    "normalized_snapshot_date",
    "snapshot_date",
)


def cast_dirty(column: Column, kind: str) -> Column:
    """Cast that yields null for text that does not fit."""
    if kind == "double":
        return to_double(column)
    if kind == "int":
        return to_int(column)
    return column.try_cast(kind)


def typed(df: DataFrame, types: Mapping[str, str], default: str = "double") -> DataFrame:
    """All columns cast in a single projection."""
    return df.select(
        [cast_dirty(F.col(c), types.get(c.lower(), default)).alias(c) for c in df.columns]
    )


def cast_prefix(df: DataFrame, prefix: str, kind: str = "double") -> DataFrame:
    chosen = [c for c in df.columns if c.startswith(prefix)]
    return df.withColumns({c: cast_dirty(F.col(c), kind) for c in chosen})


def require_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.dropna(subset=list(keys))


def numeric_columns(df: DataFrame, exclude: Collection[str] = ()) -> list[str]:
    """Columns a model can use, judged by type."""
    kinds = ("int", "bigint", "float", "double")
    return [name for name, kind in df.dtypes if kind in kinds and name not in exclude]


def fill_numeric(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    return df.fillna(0.0, subset=list(columns or numeric_columns(df)))


def infinite_to_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: finite_or_null(F.col(c)) for c in columns})


def drop_system_columns(df: DataFrame, columns: Iterable[str] = SYSTEM_COLUMNS) -> DataFrame:
    return df.drop(*columns)


def typed_by_content(df: DataFrame, keep: Iterable[str] = ("customer_id", "snapshot_date")) -> DataFrame:
    """Text columns whose every known value is a number become doubles; others, and ``keep``, stay.

    One pass over the table, whose result is one flag per column. A column without any value stays text.
    """
    candidates = [c for c, kind in df.dtypes if kind == "string" and c not in set(keep)]
    if not candidates:
        return df
    number = {c: to_double(F.trim(F.col(c))) for c in candidates}
    clean = [
        ((F.count(c) > 0) & (F.count(c) == F.count(number[c]))).alias(c) for c in candidates
    ]
    numeric = df.agg(*clean).first()
    return df.withColumns({c: number[c] for c in candidates if numeric[c]})


def valid_loans(df: DataFrame) -> DataFrame:
    return df.where(F.col("loan_amt") > 0)


def first_present(df: DataFrame, names: Iterable[str]) -> str | None:
    """First of several spellings of a column that the table has."""
    return next((name for name in names if name in df.columns), None)


def silver_clickstream(raw: DataFrame) -> DataFrame:
    return fill_numeric(require_keys(typed(raw, CLICK_TYPES), "customer_id"))


def silver_attributes(raw: DataFrame, clean: str = "plain") -> DataFrame:
    """``plain`` turns an unreadable age into 0; ``repair`` mends or blanks dirty values."""
    raw = require_keys(raw, "customer_id")
    if clean == "plain":
        return fill_numeric(typed(raw, ATTRIBUTE_TYPES))
    if clean != "repair":
        raise ValueError(f"unknown cleaning mode {clean!r}")
    mended = raw.withColumns(
        {
            "age": text.repaired_age(F.col("age")),
            "ssn": text.repaired_ssn(F.col("ssn")),
            "occupation": text.repaired_label(F.col("occupation")),
        }
    )
    return typed(mended, ATTRIBUTE_TYPES)


def silver_financials(raw: DataFrame, clean: str = "plain") -> DataFrame:
    """``plain`` makes every unlisted column a number; ``repair`` keeps the text columns and
    drops trailing underscores before casting."""
    raw = require_keys(raw, "customer_id")
    if clean == "plain":
        return fill_numeric(typed(raw, FINANCIAL_TYPES))
    if clean != "repair":
        raise ValueError(f"unknown cleaning mode {clean!r}")
    kept = {**FINANCIAL_TYPES, **dict.fromkeys(FINANCIAL_TEXT, "string")}
    numbers = [c for c in raw.columns if c.lower() not in kept]
    mended = raw.withColumns({c: text.repaired_number(F.col(c)) for c in numbers})
    labels = [c for c in raw.columns if c.lower() in FINANCIAL_TEXT]
    mended = mended.withColumns({c: text.repaired_label(F.col(c)) for c in labels})
    return fill_numeric(typed(mended, kept))


def with_mob(df: DataFrame) -> DataFrame:
    """Months on book."""
    return df.withColumn("mob", to_int(F.col("installment_num")))


def at_mob(df: DataFrame, mob: int) -> DataFrame:
    return df.where(F.col("mob") == mob)


def with_days_past_due(df: DataFrame) -> DataFrame:
    missed = delinquency.installments_missed(F.col("overdue_amt"), F.col("due_amt"))
    snapshot = F.col("snapshot_date")
    return (
        df.withColumn("installments_missed", missed)
        .withColumn(
            "first_missed_date",
            delinquency.first_missed_date(snapshot, F.col("installments_missed")),
        )
        .withColumn(
            "dpd",
            delinquency.days_past_due(F.col("overdue_amt"), snapshot, F.col("first_missed_date")),
        )
    )


def cast_listed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the listed columns that are present and leave the others alone."""
    present = {c: kind for c, kind in types.items() if c in df.columns}
    return df.withColumns({c: cast_dirty(F.col(c), kind) for c, kind in present.items()})


def silver_loans(raw: DataFrame) -> DataFrame:
    """Typed loans of every month on book with days past due."""
    kept = valid_loans(require_keys(cast_listed(raw, LOAN_TYPES), "loan_id", "customer_id"))
    return with_days_past_due(with_mob(kept))


def silver_loans_flat(raw: DataFrame) -> DataFrame:
    """Typed loans, none dropped, with the constant delay rule."""
    return with_mob(cast_listed(raw, LOAN_TYPES)).withColumn(
        "dpd", delinquency.flat_days_past_due(F.col("overdue_amt"))
    )
