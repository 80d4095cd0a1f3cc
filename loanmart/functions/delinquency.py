"""Days past due."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def installments_missed(overdue: Column, due: Column) -> Column:
    """Overdue amount in whole instalments, rounded up; 0 when nothing was due."""
    missed = F.ceil(F.try_divide(overdue, due))
    return F.when(due > 0, missed).otherwise(F.lit(0)).try_cast("int")


def installments_missed_unguarded(overdue: Column, due: Column) -> Column:
    """As above, but a division that fails (nothing due) counts as 0 whatever the sign."""
    return F.coalesce(F.ceil(F.try_divide(overdue, due)).try_cast("int"), F.lit(0))


def first_missed_date(snapshot: Column, missed: Column) -> Column:
    """Snapshot date moved back by the missed instalments; null when none was missed."""
    return F.when(missed > 0, F.add_months(snapshot, -missed))


def days_past_due(overdue: Column, snapshot: Column, first_missed: Column) -> Column:
    """Days since the first missed instalment, 0 when nothing is overdue.

    Null when an amount is overdue but no instalment was due: ``greatest`` would turn that
    null into 0, so negatives are cut off with ``when``.
    """
    days = F.when(overdue > 0, F.datediff(snapshot, first_missed)).otherwise(F.lit(0))
    return F.when(days < 0, F.lit(0)).otherwise(days).cast("int")


def flat_days_past_due(overdue: Column, days: int = 30) -> Column:
    """The simple rule: a constant when anything is overdue."""
    return F.when(overdue > 0, F.lit(days)).otherwise(F.lit(0))


def is_bad(dpd: Column, threshold: int = 30) -> Column:
    """1 when the delay reaches the threshold, else 0 (also for an unknown delay)."""
    return F.when(dpd >= threshold, F.lit(1)).otherwise(F.lit(0))
