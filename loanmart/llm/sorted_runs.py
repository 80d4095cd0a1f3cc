"""Equal neighbours in a distributed sort: sampled splitters, local multikey sort, compare across boundaries.

Rows are range-partitioned on all their columns, so a key of any frequency is spread over as many
buckets as it fills. Each bucket is sorted in one task; what a row needs of the bucket before or
after it is that bucket's last or first row, and these few rows are compared in a table of their own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from loanmart.llm.shared import forget, partitions, written

ROWS_PER_BUCKET = 400_000


def multikey_order(columns: list[np.ndarray]) -> np.ndarray:
    """Sorting order by several columns: only runs that tie so far are split by the next column."""
    order = np.argsort(columns[0], kind="stable")
    run = np.zeros(len(order), np.int64)
    np.cumsum(columns[0][order[1:]] != columns[0][order[:-1]], out=run[1:])
    for column in columns[1:]:
        tied = np.zeros(len(order), bool)
        tied[1:] = run[1:] == run[:-1]
        tied[:-1] |= tied[1:]
        places = np.flatnonzero(tied)
        if not len(places):
            break
        rows = order[places]
        order[places] = rows[np.lexsort((column[rows], run[places]))]
        new = run[1:] != run[:-1]
        new |= column[order[1:]] != column[order[:-1]]
        run = np.concatenate([[0], np.cumsum(new)])
    return order


def mark(table: DataFrame, columns: list[str], outer: int, inner: int) -> DataFrame:
    """Rows of a table of longs that share their first ``outer`` columns with another row.

    Adds ``earlier`` and ``later``: whether another row with the same first ``inner`` columns sorts
    before or after; and ``mixed``: false only if all rows sharing the outer columns are known to share
    the inner ones too. Of rows equal in every column one is kept.
    """
    spark, table = table.sparkSession, written(table)
    n = partitions(spark, table.count(), ROWS_PER_BUCKET)

    def run(batches):
        got = pa.Table.from_batches(list(batches), schema=None) if (batches := list(batches)) else None
        if got is None or not got.num_rows:
            return
        arrays = [got.column(c).to_numpy() for c in columns]
        order = multikey_order(arrays)
        arrays = [a[order] for a in arrays]
        differs = np.array([a[1:] != a[:-1] for a in arrays])
        keep = np.concatenate([[True], differs.any(axis=0)])
        if not keep.all():
            arrays = [a[keep] for a in arrays]
            differs = np.array([a[1:] != a[:-1] for a in arrays])
        size = len(arrays[0])
        out_new = np.concatenate([[True], differs[:outer].any(axis=0), [True]])
        in_new = np.concatenate([[True], differs[:inner].any(axis=0), [True]])
        edge = np.zeros(size, np.int32)
        edge[0] |= 1
        edge[-1] |= 2
        starts = np.flatnonzero(out_new)
        kinds = np.add.reduceat(in_new[:-1], starts[:-1], dtype=np.int64)
        mixed = np.repeat(kinds > 1, np.diff(starts))
        mixed[: starts[1]] = True  # may go on in the bucket before or after
        mixed[starts[-2] :] = True
        wanted = ~(out_new[:-1] & out_new[1:]) | (edge > 0)
        bucket = TaskContext.get().partitionId()
        for at in range(0, size, 100_000):
            w = np.flatnonzero(wanted[at : at + 100_000]) + at
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[w]) for a in arrays]
                + [
                    pa.array(~in_new[:-1][w]), pa.array(~in_new[1:][w]), pa.array(mixed[w]),
                    pa.array(~(out_new[:-1] & out_new[1:])[w]),
                    pa.array(np.full(len(w), bucket, np.int32)), pa.array(edge[w]),
                ],
                [*columns, "earlier", "later", "mixed", "shared", "bucket", "edge"],
            )

    schema = ", ".join(f"{c} long" for c in columns)
    flags = "earlier boolean, later boolean, mixed boolean, shared boolean, bucket int, edge int"
    marked = written(
        table.select(*columns).repartitionByRange(n, *columns).mapInArrow(run, f"{schema}, {flags}")
    )
    forget(table)
    # at most two rows a bucket: a window over them is as long as the number of buckets
    ends = marked.where("edge > 0").withColumn("_at", F.struct("bucket", F.col("edge") == 2))
    along = Window.orderBy("_at")

    def same(step: int, width: int):
        equal = F.lit(True)
        for c in columns[:width]:
            equal = equal & F.coalesce(F.lag(c, step).over(along) == F.col(c), F.lit(False))
        return equal

    first, last = F.col("edge").bitwiseAND(1) > 0, F.col("edge").bitwiseAND(2) > 0
    joined = ends.select(
        *columns,
        (F.col("earlier") | first & same(1, inner)).alias("earlier"),
        (F.col("later") | last & same(-1, inner)).alias("later"),
        "mixed",
        (F.col("shared") | first & same(1, outer) | last & same(-1, outer)).alias("shared"),
    )
    inside = marked.where("edge = 0").select(*columns, "earlier", "later", "mixed", "shared")
    return inside.union(joined).where("shared").drop("shared")
