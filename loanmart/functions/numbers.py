"""Numeric cleaning, ratios, bands and bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def to_double(value: Column) -> Column:
    """Dirty text becomes null instead of failing the job."""
    return value.try_cast("double")


def to_int(value: Column) -> Column:
    """Whole part of a number given as text or number (``'45.0'`` -> 45)."""
    return value.try_cast("double").try_cast("int")


def finite_or_null(value: Column) -> Column:
    infinite = value.isin(float("inf"), float("-inf"))
    return F.when(infinite, None).otherwise(value)


def known(value: Column) -> Column:
    """NaN counts as missing."""
    return F.when(~F.isnan(value), value)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields null for a zero denominator."""
    return F.try_divide(numerator, denominator)


def right_closed_band(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the band ``(edges[i], edges[i+1]]`` holding ``value``; null outside all bands."""
    if len(labels) != len(edges) - 1:
        raise ValueError("one label per band")
    band = F.when(value <= edges[0], None)
    for upper, label in zip(edges[1:], labels):
        band = band.when(value <= upper, label)
    return band


def unit_hash(key: Column) -> Column:
    """Repeatable value in [0, 1) taken from the first 32 bits of the key's MD5."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") / F.lit(float(2**32))
