"""Equal-width bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _widened(low: Column, high: Column) -> tuple[Column, Column]:
    """A range of zero width grows by one half on both sides."""
    flat = low == high
    return F.when(flat, low - 0.5).otherwise(low), F.when(flat, high + 0.5).otherwise(high)


def with_equal_width_bin(
    df: DataFrame, value: str, low: Column, high: Column, bins: int, name: str = "bin"
) -> DataFrame:
    """Add the 0-based bin of a known ``value`` among equal bins on ``[low, high]``.

    The last bin is closed. A bin starts at ``low + i * step`` as a double; the division only
    guesses the bin, and comparing with the two neighbouring starts settles values that lie on
    an edge. The steps are separate columns, as each is used several times.
    """
    first, last = _widened(low, high)
    x, start, step, guess = F.col(value), F.col("_start"), F.col("_step"), F.col("_guess")

    def within(index: Column) -> Column:
        return F.greatest(F.lit(0), F.least(F.lit(bins - 1), index)).cast("int")

    return (
        df.withColumns({"_start": first, "_end": last})
        .withColumn("_step", (F.col("_end") - start) / F.lit(float(bins)))
        .withColumn("_guess", within(F.floor((x - start) / step)))
        .withColumn(
            name,
            within(
                F.when(x < start + guess * step, guess - 1)
                .when(x >= start + (guess + 1) * step, guess + 1)
                .otherwise(guess)
            ),
        )
        .drop("_start", "_end", "_step", "_guess")
    )


def bin_start(index: Column, low: Column, high: Column, bins: int) -> Column:
    first, last = _widened(low, high)
    return first + index * ((last - first) / F.lit(float(bins)))
