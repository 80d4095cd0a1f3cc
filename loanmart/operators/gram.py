"""Correlations of many columns from one Gram matrix.

A row becomes the vector of its values, of flags for those it has, and of their squares; the sum of the outer products of
these vectors holds every count, sum, square and product that the pairs need, each over the rows that have both values. MLlib adds the
products up in the tasks and merges them in a tree, so there is one expression for each column, not one for each pair.
The driver holds the square of three times the number of columns, whatever the number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, functions as F


def _moments(df: DataFrame, columns: Sequence[str]):
    """For each two columns, over rows that have both: their number, sum and squares of the first, sum of products."""
    # neither null, NaN (which is above infinity) nor an infinity
    values = {c: F.when(F.abs(F.col(c).cast("double")) < math.inf, F.col(c).cast("double")) for c in columns}
    # shifted by the mean and scaled, so that sums of squares do not cancel; correlations stay the same
    shift = df.agg(*[F.struct(F.avg(v).alias("m"), F.stddev(v).alias("s")).alias(str(i)) for i, v in enumerate(values.values())]).first()
    scaled = [
        (v - F.lit(float(s["m"] or 0.0))) / F.lit(float(s["s"]) if s["s"] else 1.0) for v, s in zip(values.values(), shift)
    ]
    wide = df.select(
        *[F.coalesce(v, F.lit(0.0)).alias(f"x{i}") for i, v in enumerate(scaled)],
        *[v.isNotNull().cast("double").alias(f"m{i}") for i, v in enumerate(scaled)],
    )
    names = range(len(columns))
    squared = wide.withColumns({f"s{i}": F.col(f"x{i}") * F.col(f"x{i}") for i in names})
    vectors = VectorAssembler(inputCols=[f"{k}{i}" for k in "xms" for i in names], outputCol="v").transform(squared).select("v")
    matrix = RowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "v"), 0, 3 * len(columns))
    gram = matrix.computeGramianMatrix().toArray()
    k = len(columns)
    x, m, s = slice(0, k), slice(k, 2 * k), slice(2 * k, 3 * k)
    return gram[m, m], gram[x, m], gram[s, m], gram[x, x]


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``a, b, n, corr`` of every pair in the order of the columns; rows with a null, NaN or infinity in either left out.

    ``corr`` is null with fewer than two such rows or where either column is constant on them. Few columns or none give few rows or none.
    """
    spark = df.sparkSession
    schema = "a string, b string, n bigint, corr double"
    if len(columns) < 2 or df.isEmpty():
        pairs = [(a, b, 0, None) for i, a in enumerate(columns) for b in columns[i + 1 :]]
        return spark.createDataFrame(pairs, schema)
    n, one, square, product = _moments(df, columns)
    spread = n * square - one**2  # of the first column of each pair
    flat = spread <= 1e-12 * np.maximum(n * square, 1e-300)
    with np.errstate(divide="ignore", invalid="ignore"):
        corr = (n * product - one * one.T) / np.sqrt(spread * spread.T)
    rows = []
    for i, a in enumerate(columns):
        for j in range(i + 1, len(columns)):
            defined = n[i, j] >= 2 and not flat[i, j] and not flat[j, i]
            rows.append((a, columns[j], int(round(n[i, j])), float(np.clip(corr[i, j], -1, 1)) if defined else None))
    return spark.createDataFrame(rows, schema)
