"""Snapshot tables of text whose column types follow from what all their months hold.

For each month and column the manifest notes which kinds of values occur, as bits: whole numbers, other numbers, dates, other
text. Bits of months are joined by OR, in any order, and decide the type a column is read with: the narrowest that holds
all values. Values are stored as they came, so a month that turns a number column into text changes how the table is read and
leaves every stored month readable, without reading or writing any of them.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loanmart.functions.numbers import to_double
from loanmart.sources import manifest
from loanmart.sources.tables import SNAPSHOT, read_snapshots, write_snapshots

WHOLE, NUMBER, DATE, TEXT = 1, 2, 4, 8
NOTE = "kinds"


def kind_of(text: Column) -> Column:
    """Bit of a text's kind; 0 for null and blank. A number too large for 64 bits is one of the other numbers."""
    clean = F.trim(text)
    return (
        F.when(text.isNull() | (clean == ""), 0)
        .when(clean.rlike(r"^[+-]?[0-9]{1,19}$") & clean.try_cast("bigint").isNotNull(), WHOLE)
        .when(to_double(clean).isNotNull(), NUMBER)
        .when(clean.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & clean.try_cast("date").isNotNull(), DATE)
        .otherwise(TEXT)
    )


def type_of(kinds: int) -> str:
    """Narrowest type that holds values of all these kinds; text where there is no value, as nothing is known then."""
    if kinds == WHOLE:
        return "bigint"
    if kinds in (NUMBER, WHOLE | NUMBER):
        return "double"
    return "date" if kinds == DATE else "string"


def joined(several: Iterable[Mapping[str, int]]) -> dict[str, int]:
    """Kinds of columns over several months; a column a month lacks adds nothing."""
    out: dict[str, int] = {}
    for kinds in several:
        for column, bits in kinds.items():
            out[column] = out.get(column, 0) | bits
    return out


def kinds_by_month(df: DataFrame, month: str = SNAPSHOT, keep: Iterable[str] = ("customer_id",)) -> dict[str, dict[str, int]]:
    """Kinds of each text column in each month: one aggregate, one row a month."""
    columns = [c for c, kind in df.dtypes if kind == "string" and c not in {month, *keep}]
    bits = [F.bit_or(kind_of(F.col(c))).alias(str(i)) for i, c in enumerate(columns)]
    found = df.groupBy(F.col(month).cast("string").alias("month")).agg(F.count(F.lit(1)).alias("rows"), *bits)
    return {r["month"]: {c: r[str(i)] for i, c in enumerate(columns)} for r in found.collect()}


def write_inferred(df: DataFrame, path: str, month: str = SNAPSHOT, keep: Iterable[str] = ("customer_id",), **how) -> None:
    """Replace the months in ``df`` as ``write_snapshots`` does, noting their kinds; columns in ``keep`` stay text."""
    notes = {m: {NOTE: kinds} for m, kinds in kinds_by_month(df, month, keep).items()}
    write_snapshots(df, path, month, notes=notes, **how)


def stored_types(spark: SparkSession, path: str) -> dict[str, str]:
    """Type of each text column by what the live months hold."""
    found = manifest.read(spark, path)
    entries = found.live().values() if found else ()
    return {c: type_of(bits) for c, bits in joined(e.get(NOTE, {}) for e in entries).items()}


def read_inferred(spark: SparkSession, path: str, months: Iterable[str] | None = None, month: str = SNAPSHOT) -> DataFrame:
    """All months, or some, with the types of the whole table, so that months read apart fit together."""
    df, types = read_snapshots(spark, path, months, month), stored_types(spark, path)
    casts = {}
    for column, kind in types.items():
        clean = F.trim(F.col(column))
        if kind == "double":
            casts[column] = to_double(clean)
        elif kind != "string":
            casts[column] = clean.try_cast(kind)
    return df.withColumns(casts) if casts else df
