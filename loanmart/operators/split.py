"""Out-of-time and random splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from loanmart.functions.numbers import unit_hash

# Newest months kept apart, and the shares of the random split.
OOT_MONTHS = 3
TRAIN_SHARE, VALIDATION_SHARE = 0.70, 0.15


def oot_cutoff(df: DataFrame, months: int = OOT_MONTHS, date: str = "snapshot_date") -> Column:
    """First of the newest ``months`` snapshots, as a scalar subquery.

    Fails when that would leave no older snapshot. The set holds one entry per month.
    """
    seen = F.sort_array(F.collect_set(date), asc=False)
    short = F.raise_error(F.lit(f"need more than {months} monthly snapshots")).cast("date")
    return df.agg(
        F.when(F.size(seen) <= months, short).otherwise(F.get(seen, F.lit(months - 1))).alias("c")
    ).scalar()


def with_oot_part(
    df: DataFrame, months: int = OOT_MONTHS, date: str = "snapshot_date"
) -> DataFrame:
    newest = F.col(date) >= oot_cutoff(df, months, date)
    return df.withColumn("part", F.when(newest, "oot").otherwise("historical"))


def oot_split(
    df: DataFrame, months: int = OOT_MONTHS, date: str = "snapshot_date"
) -> tuple[DataFrame, DataFrame]:
    """``(historical, out_of_time)``."""
    cutoff = oot_cutoff(df, months, date)
    return df.where(F.col(date) < cutoff), df.where(F.col(date) >= cutoff)


def split_name(
    draw: Column, train: float = TRAIN_SHARE, validation: float = VALIDATION_SHARE
) -> Column:
    return (
        F.when(draw < train, "train").when(draw < train + validation, "val").otherwise("test")
    )


def with_hash_split(df: DataFrame, *key: str) -> DataFrame:
    """70/15/15 by the hash of a row key: the same for every partitioning and every run."""
    return df.withColumn("split", split_name(unit_hash(F.concat_ws("|", *key))))


def with_random_split(df: DataFrame, seed: int = 42) -> DataFrame:
    """70/15/15 by a seeded generator; depends on how the rows are partitioned."""
    return df.withColumn("_draw", F.rand(seed)).withColumn("split", split_name(F.col("_draw"))).drop("_draw")
