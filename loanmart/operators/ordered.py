"""Running totals, exact quantiles and rank curves without a global window.

Counts per distinct value are spread over range partitions, so each task orders one slice of
the values of a group; slice totals (a few rows per group) carry the running sum across slices.
A hot value is one row, because values are counted before they are spread.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from loanmart.session import cut_lineage

SLICE = "_slice"
ROWS_PER_SLICE = 1_000_000  # distinct values that one task orders


def value_weights(
    df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), measures=None
) -> DataFrame:
    """Long form ``(keep..., feature, value, measures...)``, one row per distinct value.

    Missing values (null or NaN) are left out. Rows multiply by the number of columns before
    the map-side aggregation, never across the shuffle.
    """
    measures = measures or {"n": F.count(F.lit(1))}
    carried = [c for c in df.columns if c not in columns]
    long = df.select(*carried, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        carried, list(columns), "feature", "value"
    )
    known = long.where(F.col("value").isNotNull() & ~F.isnan("value"))
    return known.groupBy(*keep, "feature", "value").agg(
        *[measure.alias(name) for name, measure in measures.items()]
    )


def spread(counts: DataFrame, group: Sequence[str], order: str) -> DataFrame:
    """Put counts into contiguous slices by ``order`` within ``group``.

    The counts are written first, so that the number of slices follows from how many there are. The
    range partitioning is written as well: the slice a row gets must not change between the
    branches that use it, nor when a lost executor makes Spark run a task again.
    """
    spark = counts.sparkSession
    known = cut_lineage(counts)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slices = max(least, -(-known.count() // ROWS_PER_SLICE))
    ranged = known.repartitionByRange(slices, *group, order)
    return cut_lineage(ranged.withColumn(SLICE, F.spark_partition_id()))


def with_running_totals(
    slices: DataFrame, group: Sequence[str], order: str, measures: Sequence[str]
) -> DataFrame:
    """Add ``cum_<m>``, the group's sum up to and including the row, and ``total_<m>``.

    ``slices`` comes from :func:`spread` with one row per group and order value; groups are
    few (the compared columns). As slices are contiguous, the slice totals are at most as many
    as groups and range partitions together. They are broadcast, so that the rows are shuffled
    by group and slice and never by group alone. Rows that have the totals already are returned as they are.
    """
    if all(f"cum_{m}" in slices.columns for m in measures):
        return slices
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*group, SLICE).orderBy(order)
    per_slice = slices.groupBy(*group, SLICE).agg(*[F.sum(m).alias(f"_{m}") for m in measures])
    carried = per_slice.select(
        *group,
        SLICE,
        *[F.coalesce(F.sum(f"_{m}").over(earlier), F.lit(0)).alias(f"_{m}") for m in measures],
        *[F.sum(f"_{m}").over(whole).alias(f"total_{m}") for m in measures],
    )
    return (
        slices.join(F.broadcast(carried), [*group, SLICE])
        .withColumns({f"cum_{m}": F.col(f"_{m}") + F.sum(m).over(inside) for m in measures})
        .drop(SLICE, *[f"_{m}" for m in measures])
    )


def quantiles_of(
    slices: DataFrame,
    group: Sequence[str],
    probabilities: Sequence[float],
    measures: Sequence[str] = ("n",),
) -> DataFrame:
    """Exact quantiles with linear interpolation, an array ``q_<m>`` per group and measure.

    A value covers the 0-based ranks from ``cum - n`` to ``cum - 1``; only the rows at the
    wanted ranks survive.
    """
    ranked = with_running_totals(slices, group, "value", measures)
    wanted = F.array(*[F.lit(float(p)) for p in probabilities])
    probes = ranked.select("*", F.posexplode(wanted).alias("_i", "_p"))

    def position(m: str) -> Column:
        return F.col("_p") * (F.col(f"total_{m}") - 1)

    def at(m: str, rank: Column) -> Column:
        to = F.col(f"cum_{m}")
        return F.when((to - F.col(m) <= rank) & (rank < to), F.col("value"))

    hits = {}
    for m in measures:
        hits[f"_low_{m}"] = at(m, F.floor(position(m)))
        hits[f"_high_{m}"] = at(m, F.ceil(position(m)))
        hits[f"_part_{m}"] = position(m) - F.floor(position(m))
    seen = F.coalesce(*[hits[f"_{end}_{m}"] for m in measures for end in ("low", "high")])
    points = (
        probes.where(seen.isNotNull())
        .select(*group, "_i", *[hit.alias(name) for name, hit in hits.items()])
        .groupBy(*group, "_i")
        .agg(*[F.max(name).alias(name) for name in hits])
    )

    def value(m: str) -> Column:
        low, high = F.col(f"_low_{m}"), F.col(f"_high_{m}")
        return low + (high - low) * F.col(f"_part_{m}")

    def in_order(m: str) -> Column:
        return F.sort_array(F.collect_list(F.struct("_i", value(m).alias("q"))))["q"]

    return points.groupBy(*group).agg(*[in_order(m).alias(f"q_{m}") for m in measures])


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> DataFrame:
    """``(feature, q_n)`` for each column; the probabilities set the array's order."""
    slices = spread(value_weights(df, columns), ["feature"], "value")
    return quantiles_of(slices, ["feature"], probabilities)
