"""Exact quantiles by refinement: count values into ranges, then look only into ranges that hold a wanted rank.

Each round is one scan with a map-side count into at most ``BUCKETS`` ranges for every feature, group and range still open,
so what is shuffled is bounded by ranges and tasks and never grows with the number of values. A range whose values are all
the same is settled, so a hot value costs nothing; with distinct values a round divides the rows still looked at by
about ``BUCKETS``. The columns looked at are written once, so that no round derives its input again; when the rows still looked at
are few, they are written as well and later rounds read only them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from loanmart.session import cut_lineage

BUCKETS = 4096
FEW = 2_000_000  # open rows that are written and then read again instead of the table


def _long(df: DataFrame, columns: Sequence[str], by: Sequence[str], weight: str | None) -> DataFrame:
    """``by..., feature, value, n`` of all known values (neither null nor NaN)."""
    carried = [F.col(c) for c in by] + [(F.lit(1) if weight is None else F.col(weight)).cast("long").alias("n")]
    values = [F.col(c).cast("double").alias(c) for c in columns]
    long = df.select(*carried, *values).unpivot([*by, "n"], list(columns), "feature", "value")
    return long.where(F.col("value").isNotNull() & ~F.isnan("value") & (F.col("n") > 0))


def kept_for(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """The columns that are looked at, written once: every round reads them, and ``df`` may be costly to derive."""
    carried = dict.fromkeys([*by, *([] if weight is None else [weight])])
    values = [F.col(c).cast("double").alias(c) for c in columns if c not in carried]
    return cut_lineage(df.select(*carried, *values))


def _ends(value: Column) -> list[Column]:
    """Smallest and largest value of all, of the finite ones, and those next to zero on either side."""
    finite = F.when(F.abs(value) < math.inf, value)
    return [
        F.min(value).alias("lo"), F.max(value).alias("hi"), F.min(finite).alias("flo"), F.max(finite).alias("fhi"),
        F.max(F.when(finite < 0, finite)).alias("neg"), F.min(F.when(finite > 0, finite)).alias("pos"),
    ]


ENDS = ("lo", "hi", "flo", "fhi", "neg", "pos")


def _part(x: Column, low: Column, high: Column, parts: int) -> Column:
    """Which of ``parts`` equal parts of a range ``x`` is in; never falls as ``x`` rises."""
    share = F.coalesce((x - low) / F.nullif(high - low, F.lit(0.0)), F.lit(0.0))
    return F.greatest(F.lit(0), F.least(F.lit(parts - 1), F.floor(share * parts)))


def _range_of(value: Column, ends: Column, buckets: int) -> Column:
    """Number of the range a value is in; never falls as the value rises.

    Ranges are equal where the largest finite value is at most twice the smallest, else equal on a logarithmic scale on
    either side of zero (the logarithm is semi-monotonic), so that a few huge values do not leave all others in one range. Both
    ends have ranges of their own, so a range always gets smaller; infinities have theirs.
    """
    low, high = ends["flo"], ends["fhi"]
    half = (buckets - 3) // 2
    near = (low > 0) & (high / 2 <= low) | (high < 0) & (low / 2 >= high)
    below = half - _part(F.log(-value), F.log(-F.coalesce(ends["neg"], low)), F.log(-low), half)
    above = half + 2 + _part(F.log(value), F.log(F.coalesce(ends["pos"], high)), F.log(high), half)
    spread = F.when(value < 0, below).when(value == 0, half + 1).otherwise(above)
    inner = F.when(near, 1 + _part(value, low, high, buckets - 2)).otherwise(spread)
    return (
        F.when(value == -math.inf, -1).when(value == math.inf, buckets).when(value == low, 0).when(value == high, buckets - 1)
        .otherwise(inner).cast("int")
    )


def _wanted_ranks(total: int, probabilities: Sequence[float]) -> list[int]:
    places = [p * (total - 1) for p in probabilities]
    return sorted({int(f(x)) for x in places for f in (math.floor, math.ceil)})


def quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], by: Sequence[str] = (), weight: str | None = None,
    buckets: int = BUCKETS, few: int = FEW, kept: bool = False,
) -> DataFrame:
    """``by..., feature, q_n``: exact quantiles with linear interpolation, in the order of the probabilities.

    Null and NaN are left out, infinities are values. ``by`` names a column or more with few values, such as the side of
    a comparison. ``weight`` repeats rows; one of zero or null leaves a row out. A group without values has no row. The driver
    receives a row for each open range: at most two a probability, feature and group. ``kept`` says that ``df`` comes from
    :func:`kept_for`, so that a caller who reads it too does not have it written twice.
    """
    if buckets < 8:
        raise ValueError("eight ranges at least")
    spark, keys = df.sparkSession, [*by, "feature"]
    rows = _long(df if kept else kept_for(df, columns, by, weight), columns, by, weight)
    ends = rows.groupBy(*keys).agg(F.sum("n").alias("n"), *_ends(F.col("value"))).collect()
    found: dict[tuple, dict[int, float]] = {tuple(r[k] for k in keys): {} for r in ends}
    totals = {tuple(r[k] for k in keys): r["n"] for r in ends}
    still = [_Range(tuple(r[k] for k in keys), [r[e] for e in ENDS], r["n"], 0, _wanted_ranks(r["n"], probabilities)) for r in ends]
    kinds = {f.name: f.dataType for f in df.schema}
    key_fields = [StructField(k, kinds[k]) for k in by] + [StructField("feature", StringType())]
    narrowed = False
    while True:
        opened = []
        for r in still:
            if r.ends[0] == r.ends[1]:
                found[r.key].update(dict.fromkeys(r.ranks, r.ends[0]))
            else:
                opened.append(r)
        if not opened:
            break
        if not narrowed and sum(r.n for r in opened) <= few:
            rows = cut_lineage(_open(rows, opened, keys, key_fields).groupBy(*keys, "value").agg(F.sum("n").alias("n")))
            narrowed = True
        still = _next_round(rows, opened, keys, key_fields, buckets)
    result = []
    for key, ranks in found.items():
        places = [p * (totals[key] - 1) for p in probabilities]
        ends_of = [(ranks[math.floor(x)], ranks[math.ceil(x)], x - math.floor(x)) for x in places]
        result.append((*key, [low if low == high else low + (high - low) * part for low, high, part in ends_of]))
    schema = StructType([*key_fields, StructField("q_n", ArrayType(DoubleType()))])
    return spark.createDataFrame(result, schema)


@dataclass(frozen=True)
class _Range:
    """A range of one feature and group: its ends, rows, the rank of its first row, and the ranks wanted in it."""

    key: tuple
    ends: list
    n: int
    first: int
    ranks: list[int]


def _ranges(spark, opened: list[_Range], key_fields) -> DataFrame:
    """A row a key with its open ranges, which do not overlap."""
    by: dict[tuple, list] = {}
    for i, r in enumerate(opened):
        by.setdefault(r.key, []).append((i, *r.ends))
    doubles = [StructField(n, DoubleType()) for n in ENDS]
    one = StructType([StructField("i", IntegerType()), *doubles])
    schema = StructType([*key_fields, StructField("ranges", ArrayType(one))])
    return spark.createDataFrame([(*key, ranges) for key, ranges in by.items()], schema)


def _open(rows: DataFrame, opened, keys, key_fields) -> DataFrame:
    """Rows within an open range, with that range as ``r``. A row a feature and group is broadcast."""
    spec = F.broadcast(_ranges(rows.sparkSession, opened, key_fields))
    same = [rows[k].eqNullSafe(spec[k]) for k in keys]
    joined = rows.join(spec, same).select(*[rows[k] for k in keys], "value", "n", "ranges")

    def holds(r: Column) -> Column:
        return (F.col("value") >= r["lo"]) & (F.col("value") <= r["hi"])

    alone = F.get("ranges", F.lit(0))  # the first round has one range a key and needs no search
    inside = F.when(holds(alone), alone) if len({r.key for r in opened}) == len(opened) else F.get(F.filter("ranges", holds), 0)
    return joined.withColumn("r", inside).where("r IS NOT NULL").drop("ranges")


def _next_round(rows: DataFrame, opened: list[_Range], keys, key_fields, buckets: int) -> list[_Range]:
    value = F.col("value")
    placed = _open(rows, opened, keys, key_fields).withColumn("bucket", _range_of(value, F.col("r"), buckets))
    # the wanted ranks are joined afterwards: an array among the aggregates would have all values sorted
    counted = placed.groupBy("r.i", "bucket").agg(F.sum("n").alias("n"), *_ends(value))
    wanted = [(i, [k - r.first for k in r.ranks]) for i, r in enumerate(opened)]
    ranks = rows.sparkSession.createDataFrame(wanted, "i int, ranks array<bigint>")
    before = F.sum("n").over(Window.partitionBy("i").orderBy("bucket")) - F.col("n")
    held = counted.withColumn("first", before).join(F.broadcast(ranks), "i").withColumn(
        "held", F.filter("ranks", lambda k: (k >= F.col("first")) & (k < F.col("first") + F.col("n")))
    )
    still = []
    for r in held.where(F.size("held") > 0).collect():
        whole = opened[r["i"]]
        still.append(_Range(whole.key, [r[e] for e in ENDS], r["n"], whole.first + r["first"], [whole.first + k for k in r["held"]]))
    return still


def spread_of(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``feature, n, min, median, max`` of each column that has a known value."""
    stored = kept_for(df, columns)
    known = _long(stored, columns, (), None)
    ends = known.groupBy("feature").agg(F.sum("n").alias("n"), F.min("value").alias("min"), F.max("value").alias("max"))
    return ends.join(F.broadcast(quantiles(stored, columns, [0.5], kept=True)), "feature").select(
        "feature", "n", "min", F.element_at("q_n", 1).alias("median"), "max"
    )


def boxplot(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers and the number of values beyond them; a second look at the data, with a row a feature broadcast."""
    stored = kept_for(df, columns)
    quartiles = quantiles(stored, columns, [0.25, 0.5, 0.75], kept=True)
    q1, median, q3 = (F.element_at("q_n", i) for i in (1, 2, 3))
    reach = 1.5 * (q3 - q1)
    inside = F.col("value").between(q1 - reach, q3 + reach)
    fenced = _long(stored, columns, (), None).join(F.broadcast(quartiles), "feature").groupBy("feature", "q_n").agg(
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.sum(F.when(~inside, F.col("n")).otherwise(0)).alias("n_outliers"),
    )
    return fenced.select("feature", "whisker_low", q1.alias("q1"), median.alias("median"), q3.alias("q3"), "whisker_high", "n_outliers")
