"""Months: normalising, filtering, calendars, gaps."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from loanmart.functions.dates import month_label, month_start, parse_date

SNAPSHOT = "snapshot_date"
NORMALIZED = "normalized_snapshot_date"


def only_month(df: DataFrame, month: str, column: str = SNAPSHOT) -> DataFrame:
    return df.where(F.col(column) == F.lit(month).cast("date"))


def with_default_snapshot(df: DataFrame, month: str, column: str = SNAPSHOT) -> DataFrame:
    """Stamp a source that carries no snapshot date with the month being processed."""
    if column in df.columns:
        return df
    return df.withColumn(column, F.lit(month).cast("date"))


def with_normalized_snapshot(df: DataFrame, column: str = SNAPSHOT) -> DataFrame:
    return df.withColumn(NORMALIZED, parse_date(F.col(column)))


def with_lineage(df: DataFrame, layer: str, month_column: str = SNAPSHOT) -> DataFrame:
    """Clock and processing-month columns for operations; never part of a comparison."""
    return df.withColumns(
        {
            f"{layer}_ingestion_timestamp": F.current_timestamp(),
            f"{layer}_processing_date": F.date_format(month_column, "yyyy-MM-dd"),
        }
    )


def calendar(df: DataFrame, start: str = SNAPSHOT, end: str | None = None) -> DataFrame:
    """Every first-of-month between the earliest and the latest date found in ``df``."""
    bounds = df.agg(
        month_start(F.min(start)).alias("first"), F.max(end or start).cast("date").alias("last")
    ).where("first IS NOT NULL")
    months = F.sequence("first", "last", F.expr("INTERVAL 1 MONTH"))
    return bounds.select(F.explode(months).alias(SNAPSHOT))


def missing_months(months: DataFrame, table: DataFrame) -> DataFrame:
    """Calendar months for which the table holds no row."""
    return months.join(table.select(SNAPSHOT).distinct(), SNAPSHOT, "left_anti")


def listed_months(df: DataFrame, months: Iterable[str]) -> DataFrame:
    """Rows of the listed months that exist, tagged with a readable month."""
    wanted = [F.lit(m).cast("date") for m in months]
    return df.where(F.col(SNAPSHOT).isin(wanted)).withColumn(
        "data_month", month_label(F.col(SNAPSHOT))
    )


def rows_by_month(df: DataFrame, layer: str) -> DataFrame:
    return (
        df.groupBy(SNAPSHOT)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(layer).alias("layer"), SNAPSHOT, "n_rows")
    )
