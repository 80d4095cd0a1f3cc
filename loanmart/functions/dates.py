"""Snapshot dates: parsing, month starts, tags."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Accepted raw date layouts, in order of preference.
RAW_DATE_FORMATS = ("yyyy-MM-dd", "d/M/yyyy")
# texts the raw layouts read as a cast does; there is no year 0 in a layout
ISO_SHAPE = r"\A(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
TURNED_SHAPE = r"\A[0-9]{1,2}/[0-9]{1,2}/(?!0000)[0-9]{4}\z"
TAG_FORMAT = "yyyy_MM_dd"
TAG_PATTERN = r"(\d{4}_\d{2}_\d{2})"


def parse_date(text: Column, formats: tuple[str, ...] = RAW_DATE_FORMATS) -> Column:
    """First layout that fits; null when none does.

    A layout that does not fit costs an exception a row, so texts in the usual shape of one of the raw layouts, which no
    other of them fits, are cast instead; the formatter is asked about all others.
    """
    parsed = F.coalesce(*[F.try_to_date(text, fmt) for fmt in formats])
    if formats != RAW_DATE_FORMATS:
        return parsed
    day, month, year = (F.split_part(text, F.lit("/"), F.lit(i)) for i in (1, 2, 3))
    turned = F.concat(year, F.lit("-"), month, F.lit("-"), day)
    return (
        F.when(text.rlike(ISO_SHAPE), text.try_cast("date")).when(text.rlike(TURNED_SHAPE), turned.try_cast("date")).otherwise(parsed)
    )


def month_start(date: Column) -> Column:
    return F.trunc(date, "month")


def month_tag(date: Column) -> Column:
    """``2023-04-17`` -> ``2023_04_01``."""
    return F.date_format(month_start(date), TAG_FORMAT)


def tag_to_date(text: Column) -> Column:
    """Date held anywhere in a tag or path, null when there is none."""
    return F.try_to_date(F.regexp_extract(text, TAG_PATTERN, 1), TAG_FORMAT)


def month_label(date: Column) -> Column:
    """``2023-04-01`` -> ``Apr 2023``."""
    return F.date_format(date, "MMM yyyy")
