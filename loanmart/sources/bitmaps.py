"""Distinct counts that are stored and merged: one bitmap of ids a month, ORed over any months and tables.

Ids get dense numbers from a dictionary, a table that only grows: each run numbers the ids it has not seen. A month's ids are
the set bits, cut into buckets of 32,768 numbers, so a month of a table is read once, when its bitmaps are written; counting over
any choice of months and tables reads bitmaps only and is exact.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from loanmart.session import cut_lineage
from loanmart.sources import manifest
from loanmart.sources.tables import SNAPSHOT, read_snapshots, stored_months, write_snapshots

ADDED = "added"  # a dictionary's snapshots are the runs that added to it


def _dictionary(spark: SparkSession, path: str) -> DataFrame | None:
    found = manifest.read(spark, path)
    return None if found is None else read_snapshots(spark, path, month=ADDED)


def numbered(ids: DataFrame, path: str) -> DataFrame:
    """``id, number`` of all ids of a dictionary, after giving numbers to those in the one column of ``ids`` that have none.

    Null is no id. New ids are written once with the partition they are in; the driver adds up one count a partition, so
    that each partition numbers its own.
    """
    spark = ids.sparkSession
    wanted = ids.select(F.col(ids.columns[0]).cast("string").alias("id")).where("id IS NOT NULL").distinct()
    held = _dictionary(spark, path)
    new = wanted if held is None else wanted.join(held, "id", "left_anti")
    parted = cut_lineage(new.withColumn("part", F.spark_partition_id()))
    counts = sorted((r["part"], r["count"]) for r in parted.groupBy("part").count().collect())
    found = manifest.read(spark, path)
    start = sum(e["ids"] for e in found.live().values()) if found else 0
    if counts or held is None:
        offsets, run = [], found.version + 1 if found else 1
        for part, n in counts:
            offsets.append((part, start))
            start += n
        first = F.broadcast(spark.createDataFrame(offsets, "part int, first long"))
        row = F.row_number().over(Window.partitionBy("part").orderBy("id"))
        added = parted.join(first, "part").select("id", (F.col("first") + row - 1).alias("number"), F.lit(str(run)).alias(ADDED))
        write_snapshots(added, path, month=ADDED, regroup=False, months=[str(run)], notes={str(run): {"ids": sum(n for _, n in counts)}})
    return read_snapshots(spark, path, month=ADDED).select("id", "number")


def write_bitmaps(
    df: DataFrame, path: str, dictionaries: dict[str, str], month: str = SNAPSHOT, months: Iterable[str] | None = None
) -> None:
    """Replace the bitmaps of the months in ``df`` (of ``months``, where listed): ``column, bucket, bits`` for each id column named in
    ``dictionaries`` with its dictionary, and the number of rows. Rows without a month have none."""
    dated = df.where(F.col(month).isNotNull())
    parts = [
        dated.groupBy(month).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit("").alias("column"), F.lit(0).cast("bigint").alias("bucket"), F.lit(None).cast("binary").alias("bits"), "n", month
        )
    ]
    for column, path_of in dictionaries.items():
        ids = dated.select(month, F.col(column).cast("string").alias("id")).where("id IS NOT NULL").distinct()
        # the functions count bits from one
        at = numbered(dated.select(column), path_of).withColumn("number", F.col("number") + 1)
        bits = ids.join(at, "id").groupBy(month, F.bitmap_bucket_number("number").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")
        )
        parts.append(bits.select(F.lit(column).alias("column"), "bucket", "bits", F.lit(None).cast("bigint").alias("n"), month))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    write_snapshots(rows, path, month, months=months)


def _merged(spark: SparkSession, paths: Sequence[str], column: str, months: Iterable[str] | None) -> DataFrame:
    held = None
    for path in paths:
        part = read_snapshots(spark, path, months).where(F.col("column") == column).select("bucket", "bits")
        held = part if held is None else held.unionByName(part)
    return held.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_ids(spark: SparkSession, paths: Sequence[str], column: str, months: Iterable[str] | None = None) -> DataFrame:
    """``n_distinct``: ids found in any of the tables, in all or the listed months. The tables share the column's dictionary."""
    merged = _merged(spark, paths, column, None if months is None else list(months))
    return merged.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("n_distinct"))


def store_profile(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """Rows, distinct ids and date range of a table from its bitmaps; no row of the table is read."""
    months = stored_months(spark, path)
    rows = read_snapshots(spark, path).where(F.col("column") == "").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))
    counts = {f"n_{c}": distinct_ids(spark, [path], c).select("n_distinct").scalar() for c in columns}
    ends = {"first_snapshot": months[0] if months else None, "last_snapshot": months[-1] if months else None}
    return rows.withColumns(counts | {n: F.lit(v).cast("date") for n, v in ends.items()})
