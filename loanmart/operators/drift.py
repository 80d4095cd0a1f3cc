"""Drift between a reference sample and a current sample.

Both samples travel in one frame with a ``side`` column (``ref`` or ``cur``), so the data are
scanned once. An optional weight column repeats rows without materialising the copies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from loanmart.functions.numbers import known
from loanmart.operators import ranks
from loanmart.operators.bins import with_equal_width_bin
from loanmart.operators.cleaning import numeric_columns
from loanmart.operators.ordered import (
    quantiles_of,
    spread,
    value_weights,
    with_running_totals,
)
from loanmart.session import cut_lineage

SIDE = "side"
# Thresholds and constants of the drift reports.
BINS = 10
EPSILON_MINMAX = 1e-8
EPSILON_QUANTILE = 1e-6
PSI_FLAG = 0.25
PSI_ALERT = 0.2
P_VALUE_ALERT = 0.05
MIN_ROWS = 10
KOLMOGOROV_TERMS = 100


def two_sided(reference: DataFrame, current: DataFrame, zero_fill: bool = False) -> DataFrame:
    """Both samples in one frame, reduced to the numeric columns they share.

    ``zero_fill`` counts a missing value as 0 instead of leaving it out.
    """
    shared = set(numeric_columns(current))
    columns = [c for c in numeric_columns(reference) if c in shared]
    both = (
        reference.select(*columns, F.lit("ref").alias(SIDE))
        .unionByName(current.select(*columns, F.lit("cur").alias(SIDE)))
    )
    return both.fillna(0, subset=columns) if zero_fill else both


def sided_by(df: DataFrame, is_current: Column) -> DataFrame:
    """Split one frame into samples by a condition."""
    return df.withColumn(SIDE, F.when(is_current, "cur").otherwise("ref"))


def _weight(weight: str | None) -> Column:
    return F.lit(1) if weight is None else F.col(weight)


def _on(side: str, value: Column) -> Column:
    return F.when(F.col(SIDE) == side, value)


def feature_counts(sided: DataFrame, features: Sequence[str], weight=None) -> DataFrame:
    """Known values per feature and side, and whether both suffice for a comparison."""
    measures = []
    for f in features:
        seen = F.when(known(F.col(f).cast("double")).isNotNull(), _weight(weight))
        measures.append(
            F.struct(
                F.lit(f).alias("feature"),
                *[
                    F.coalesce(F.sum(_on(s, seen)), F.lit(0)).cast("bigint").alias(f"n_{s}")
                    for s in ("ref", "cur")
                ],
            )
        )
    counted = sided.agg(F.array(*measures).alias("rows")).select(F.inline("rows"))
    enough = (F.col("n_ref") >= MIN_ROWS) & (F.col("n_cur") >= MIN_ROWS)
    return counted.withColumn("compared", enough.cast("int"))


def _share(count: Column, total: Column) -> Column:
    return F.try_divide(count, total)


def psi_of_bins(binned: DataFrame, epsilon: float) -> DataFrame:
    """PSI per feature from ``(feature, bin, n_ref, n_cur)``.

    There is one row per feature and bin, so the windows are tiny. A bin empty on both sides
    adds nothing to the sum and needs no row.
    """
    per_feature = Window.partitionBy("feature")
    ref = _share(F.col("n_ref"), F.sum("n_ref").over(per_feature))
    cur = _share(F.col("n_cur"), F.sum("n_cur").over(per_feature))
    shares = binned.select("feature", ref.alias("r"), cur.alias("c"))
    term = (F.col("c") - F.col("r")) * F.log((F.col("c") + epsilon) / (F.col("r") + epsilon))
    return shares.groupBy("feature").agg(F.sum(term).alias("psi"))


def _sum_sides(weight: str | None) -> list[Column]:
    return [
        F.coalesce(F.sum(_on(s, _weight(weight))), F.lit(0)).cast("bigint").alias(f"n_{s}")
        for s in ("ref", "cur")
    ]


def psi_minmax(
    sided: DataFrame, features: Sequence[str], bins: int = BINS, weight: str | None = None
) -> DataFrame:
    """PSI with each side scaled by its own range and cut into equal-width bins.

    Two passes over the data. The ranges are broadcast: two rows per feature. Nothing is
    shuffled but ranges and bin counts.
    """
    values = {f: known(F.col(f).cast("double")).alias(f) for f in features}
    carried = [SIDE] if weight is None else [SIDE, weight]
    wide = sided.select(*carried, *values.values())
    ranges = wide.groupBy(SIDE).agg(
        F.array(
            *[
                F.struct(
                    F.lit(f).alias("feature"), F.min(f).alias("_lo"), F.max(f).alias("_hi")
                )
                for f in features
            ]
        ).alias("ranges")
    )
    ranges = ranges.select(SIDE, F.inline("ranges"))
    width = F.col("_hi") - F.col("_lo")
    scaled = (
        wide.unpivot(carried, list(features), "feature", "value")
        .where("value IS NOT NULL")
        .join(F.broadcast(ranges), [SIDE, "feature"])
        .withColumns(
            {
                "_x": (F.col("value") - F.col("_lo")) / (width + EPSILON_MINMAX),
                "_top": width / (width + EPSILON_MINMAX),
            }
        )
    )
    binned = with_equal_width_bin(scaled, "_x", F.lit(0.0), F.col("_top"), bins)
    counted = binned.groupBy("feature", "bin").agg(*_sum_sides(weight))
    return psi_of_bins(counted, EPSILON_MINMAX)


def sliced_values(
    sided: DataFrame, features: Sequence[str], weight: str | None = None
) -> DataFrame:
    """Distinct values of every feature with the counts of both sides, in slices by value.

    The one expensive step of the KS and quantile PSI measures; they can share its result.
    """
    carried = [SIDE] if weight is None else [SIDE, weight]
    sums = dict(zip(("n_ref", "n_cur"), _sum_sides(weight)))
    counts = value_weights(sided.select(*carried, *features), features, measures=sums)
    return spread(counts, ["feature"], "value")


def _psi_by_edges(slices: DataFrame, edges: DataFrame, bins: int) -> DataFrame:
    """PSI with bins by each side's edges ``q_ref`` and ``q_cur``.

    A bin is the number of edges strictly below the value, kept within 1..bins. The edges are
    broadcast: one row per feature.
    """

    def bin_of(side: str) -> Column:
        edge = [F.element_at(f"q_{side}", i + 1) for i in range(bins + 1)]
        below = sum(((e < F.col("value")).cast("int") for e in edge), F.lit(0))
        return F.greatest(F.lit(1), F.least(F.lit(bins), below))

    nothing = F.lit(0).cast("bigint")

    def counted(side: str, n_ref: Column, n_cur: Column) -> Column:
        return F.struct(bin_of(side).alias("bin"), n_ref.alias("n_ref"), n_cur.alias("n_cur"))

    pairs = F.array(
        counted("ref", F.col("n_ref"), nothing), counted("cur", nothing, F.col("n_cur"))
    )
    binned = (
        slices.join(F.broadcast(edges), "feature")
        .select("feature", F.inline(pairs))
        .groupBy("feature", "bin")
        .agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
    )
    return psi_of_bins(binned, EPSILON_QUANTILE)


def _steps(bins: int) -> list[float]:
    return [i / bins for i in range(bins + 1)]


def psi_own_quantiles(slices: DataFrame, bins: int = BINS) -> DataFrame:
    """PSI with each side cut at its own quantiles (near 0 for continuous features)."""
    edges = quantiles_of(slices, ["feature"], _steps(bins), ["n_ref", "n_cur"])
    renamed = edges.withColumnsRenamed({"q_n_ref": "q_ref", "q_n_cur": "q_cur"})
    return _psi_by_edges(slices, renamed, bins)


def psi_reference_quantiles(slices: DataFrame, bins: int = BINS) -> DataFrame:
    """PSI with both sides cut at the reference's quantiles, the usual definition."""
    edges = quantiles_of(slices, ["feature"], _steps(bins), ["n_ref"])
    both = edges.select("feature", F.col("q_n_ref").alias("q_ref"), F.col("q_n_ref").alias("q_cur"))
    return _psi_by_edges(slices, both, bins)


def psi_refined(
    sided: DataFrame, features: Sequence[str], own: bool = False, bins: int = BINS, weight: str | None = None
) -> DataFrame:
    """PSI by quantiles (each side's ``own``, else the reference's) that never orders the values.

    The edges come from :func:`loanmart.operators.ranks.quantiles`; then one more scan counts values into bins. What is shuffled are
    counts of ranges and bins.
    """
    stored = ranks.kept_for(sided, features, [SIDE], weight)
    found = ranks.quantiles(stored, features, _steps(bins), by=[SIDE], weight=weight, kept=True)
    q_ref = F.max(_on("ref", F.col("q_n")))
    q_cur = F.max(_on("cur", F.col("q_n")))
    edges = found.groupBy("feature").agg(q_ref.alias("q_ref"), (q_cur if own else q_ref).alias("q_cur"))
    carried = [SIDE] if weight is None else [SIDE, weight]
    values = [F.col(f).cast("double").alias(f) for f in features]
    long = stored.select(*carried, *values).unpivot(carried, list(features), "feature", "value")
    seen = long.where(F.col("value").isNotNull() & ~F.isnan("value"))
    counts = [_on(s, _weight(weight)).alias(f"n_{s}") for s in ("ref", "cur")]
    filled = [F.coalesce(c, F.lit(0)).cast("bigint").alias(f"n_{s}") for c, s in zip(counts, ("ref", "cur"))]
    return _psi_by_edges(seen.select("feature", "value", *filled), edges, bins)


def ks_statistic(slices: DataFrame) -> DataFrame:
    """Largest distance between the two empirical distribution functions per feature."""
    ranked = with_running_totals(slices, ["feature"], "value", ["n_ref", "n_cur"])
    gap = F.abs(
        _share(F.col("cum_n_ref"), F.col("total_n_ref"))
        - _share(F.col("cum_n_cur"), F.col("total_n_cur"))
    )
    return ranked.groupBy("feature").agg(
        F.max(gap).alias("ks_stat"),
        F.max("total_n_ref").alias("n_ref"),
        F.max("total_n_cur").alias("n_cur"),
    )


def ks_p_value(statistic: Column, n_ref: Column, n_cur: Column) -> Column:
    """Asymptotic two-sided p-value (Kolmogorov's series)."""
    n_ref, n_cur = n_ref.cast("double"), n_cur.cast("double")
    lam = F.sqrt(n_ref * n_cur / (n_ref + n_cur)) * statistic
    terms = F.sequence(F.lit(1), F.lit(KOLMOGOROV_TERMS))
    series = F.aggregate(
        terms,
        F.lit(0.0),
        lambda total, k: total
        + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * lam * lam),
    )
    # below 0.2 the series converges too slowly and the true value is 1 to many places
    return F.when(lam < 0.2, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2 * series)))


def ks_test(slices: DataFrame) -> DataFrame:
    return ks_statistic(slices).withColumn(
        "ks_pvalue", ks_p_value(F.col("ks_stat"), F.col("n_ref"), F.col("n_cur"))
    )


def drift_metrics(
    sided: DataFrame,
    features: Sequence[str],
    method: str = "reference",
    weight: str | None = None,
) -> DataFrame:
    """``feature, psi, ks_stat, ks_pvalue`` for features with enough known values."""
    # one pass of running totals feeds both the edges and the distances
    slices = cut_lineage(
        with_running_totals(sliced_values(sided, features, weight), ["feature"], "value", ["n_ref", "n_cur"])
    )
    if method == "minmax":
        psi = psi_minmax(sided, features, weight=weight)
    elif method == "own":
        psi = psi_own_quantiles(slices)
    elif method == "reference":
        psi = psi_reference_quantiles(slices)
    else:
        raise ValueError(f"unknown PSI method {method!r}")
    tested = ks_test(slices).where(
        (F.col("n_ref") >= MIN_ROWS) & (F.col("n_cur") >= MIN_ROWS)
    )
    return tested.join(psi, "feature").select("feature", "psi", "ks_stat", "ks_pvalue")


def with_flags(metrics: DataFrame) -> DataFrame:
    psi, p = F.col("psi"), F.col("ks_pvalue")
    return metrics.withColumns(
        {
            "psi_flag": (psi > PSI_FLAG).cast("int"),
            "ks_flag": (p < P_VALUE_ALERT).cast("int"),
            "alert": ((psi > PSI_ALERT) | (p < P_VALUE_ALERT)).cast("int"),
        }
    )


def drift_alerts(metrics: DataFrame) -> DataFrame:
    """One row per drifting feature, or a single row saying why there is none.

    The metrics hold one row per feature, so they fit into one list; they are computed once.
    """

    def alert(outcome: Column, feature: Column, psi: Column, p: Column) -> Column:
        return F.struct(
            outcome.alias("outcome"),
            feature.cast("string").alias("feature"),
            psi.cast("double").alias("psi"),
            p.cast("double").alias("ks_pvalue"),
        )

    hit = alert(F.lit("drift"), F.col("feature"), F.col("psi"), F.col("ks_pvalue"))
    state = with_flags(metrics).agg(
        F.count(F.lit(1)).alias("n"),
        F.collect_list(F.when(F.col("alert") == 1, hit)).alias("hits"),
    )
    nothing = F.lit(None)
    why = F.when(F.col("n") == 0, "no drift").otherwise("stable")
    quiet = F.array(alert(why, nothing, nothing, nothing))
    return state.select(F.inline(F.when(F.size("hits") > 0, F.col("hits")).otherwise(quiet)))


def drift_summary(metrics: DataFrame, violations: DataFrame | None = None) -> DataFrame:
    """One report row; ``violations`` is the frame of :func:`monotonicity_violation_rate`."""
    flagged = with_flags(metrics)
    mvr = F.lit(None).cast("double") if violations is None else violations.select("mvr").scalar()
    return flagged.agg(
        F.count(F.lit(1)).alias("num_features"),
        F.coalesce(F.sum("psi_flag"), F.lit(0)).alias("num_drifted_features"),
        F.avg("psi").alias("avg_psi"),
        F.avg("ks_stat").alias("avg_ks"),
    ).withColumn("mvr", mvr)


def monotonicity_violation_rate(
    df: DataFrame, entity: str, time: str, tie: str, value: str
) -> DataFrame:
    """Share of rows whose value rises against the entity's row before it.

    Rows are ordered by time; rows of the same time by the MD5 of ``tie``, which has to be
    unique within them. An entity's rows of one time are cut into 256 pieces by the first two
    digits of that hash, so no task orders a whole entity; the last row of a piece is compared
    with the first of the next one on a frame of at most 256 rows per entity and time.
    """
    hashed = df.select(
        entity, time, F.md5(F.col(tie).cast("string")).alias("_h"), F.col(value).alias("_v")
    ).withColumn("_piece", F.substring("_h", 1, 2))
    piece = [entity, time, "_piece"]
    previous = F.lag("_v").over(Window.partitionBy(*piece).orderBy("_h"))
    pieces = (
        hashed.withColumn("_up", (F.col("_v") - previous > 0).cast("int"))
        .groupBy(*piece)
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.sum("_up").alias("_ups"),
            F.min(F.struct("_h", "_v")).alias("_first"),
            F.max(F.struct("_h", "_v")).alias("_last"),
        )
    )
    before = F.lag("_last").over(Window.partitionBy(entity).orderBy(time, "_piece"))
    rising = (F.col("_first._v") - before["_v"] > 0).cast("int")
    return (
        pieces.withColumn("_step", rising)
        .agg(
            F.sum("_n").alias("n_rows"),
            (F.coalesce(F.sum("_ups"), F.lit(0)) + F.coalesce(F.sum("_step"), F.lit(0))).alias(
                "n_violations"
            ),
        )
        .withColumn("mvr", F.try_divide("n_violations", "n_rows"))
    )


def monitor_join(
    reference: DataFrame, predictions: DataFrame, key: str = "customer_id"
) -> DataFrame:
    """Reference rows with the prediction of their key; shared names get ``_ref``/``_pred``.

    ``predictions`` must hold one row per key, else the job fails; use :func:`match_weights` then:
    pairing many rows with many rows of a key would grow with the square of the key's size. Without the
    key on both sides the reference is returned alone.
    """
    if key not in reference.columns or key not in predictions.columns:
        return reference
    shared = [c for c in reference.columns if c in predictions.columns and c != key]
    left = reference.withColumnsRenamed({c: f"{c}_ref" for c in shared})
    right = predictions.withColumnsRenamed({c: f"{c}_pred" for c in shared})
    values = [c for c in right.columns if c != key]
    several = F.raise_error(F.lit(f"several predictions for one {key}")).cast("bigint")
    single = right.groupBy(key).agg(
        *[F.first(c).alias(c) for c in values], F.count(F.lit(1)).alias("_n")
    ).withColumn("_n", F.when(F.col("_n") > 1, several).otherwise(F.col("_n")))
    # the count is a column of the join's input, so that it is looked at
    return left.join(single.where("_n = 1").drop("_n"), key)


def match_weights(
    reference: DataFrame, predictions: DataFrame, key: str = "customer_id"
) -> DataFrame:
    """Reference rows with ``n_matches``, the number of predictions their key has.

    Stands for the many-to-many pairing of both sides as a bag of reference rows: the drift
    measures take ``n_matches`` as the weight and give what the paired rows would give.
    """
    per_key = predictions.groupBy(key).agg(F.count(F.lit(1)).alias("n_matches"))
    return reference.join(per_key, key)
