"""Text checks and repairs for customer attributes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The shape of a valid SSN and the range of a believable age.
SSN_PATTERN = "^[0-9]{3}-[0-9]{2}-[0-9]{4}$"
AGE_RANGE = (0, 120)


def ssn_is_valid(ssn: Column) -> Column:
    return ssn.rlike(SSN_PATTERN)


def repaired_ssn(ssn: Column) -> Column:
    return F.when(ssn_is_valid(ssn), ssn)


def repaired_number(text: Column) -> Column:
    """``41_`` -> 41.0."""
    return F.regexp_replace(text, "_+$", "").try_cast("double")


def repaired_age(text: Column) -> Column:
    """Trailing underscores removed; ages outside the believable range become null."""
    age = repaired_number(text)
    return F.when(age.between(*AGE_RANGE), age)


def repaired_label(text: Column) -> Column:
    """Placeholders made of underscores only become null."""
    return F.when(~text.rlike("^_*$"), text)
