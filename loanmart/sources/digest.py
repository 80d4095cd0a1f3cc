"""Digests of months that do not depend on the order of rows or on how they are split into files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

SALTS = (0x5DEECE66D, 0x2545F491)


def month_digests(df: DataFrame, month: str, leave_out: Iterable[str] = ()) -> dict[str, str]:
    """Digest of the rows of each month: their number and the sums of two 64-bit hashes of each row.

    Columns enter by name, so their order does not matter; a null differs from every value. Rows are reduced on the map
    side; one row a month reaches the driver.
    """
    columns = sorted(set(df.columns) - {month, *leave_out})
    values = [F.col(c) for c in columns] + [F.col(c).isNull() for c in columns]
    sums = [F.sum(F.xxhash64(F.lit(s), F.lit(",".join(columns)), *values).cast("decimal(38,0)")) for s in SALTS]
    whole = F.concat_ws(":", F.count(F.lit(1)).cast("string"), *[s.cast("string") for s in sums])
    found = df.groupBy(F.col(month).cast("string").alias("month")).agg(whole.alias("digest"))
    return {r.month: r.digest for r in found.collect()}
