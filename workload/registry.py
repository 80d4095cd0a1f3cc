"""Where queries register themselves, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from loanmart.session import apply_settings
from workload.sql import with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _comparable(df: DataFrame, rounded, digits, dates, ints) -> DataFrame:
    changes = {c: F.round(c, digits) for c in rounded}
    changes |= {c: F.date_format(c, "yyyy-MM-dd") for c in dates}
    changes |= {c: F.col(c).cast("bigint") for c in ints}
    return df.withColumns(changes) if changes else df


def _comparable_sql(body: str, rounded, digits, dates, ints) -> str:
    changes = [f'round(cast("{c}" AS double), {digits}) AS "{c}"' for c in rounded]
    changes += [f"strftime({c}, '%Y-%m-%d') AS {c}" for c in dates]
    changes += [f"cast({c} AS bigint) AS {c}" for c in ints]
    return f"SELECT * REPLACE ({', '.join(changes)}) FROM ({body})" if changes else body


def query(
    sql: str | None = None,
    rounded: str | list[str] = "",
    digits: int = 6,
    dates: str = "",
    ints: str = "",
    views: dict[str, str] | None = None,
):
    """Register a function under its name.

    Both sides show doubles with ``digits`` places, dates as ISO text and counts as 64-bit
    integers, so that equal results compare equal.
    """
    rounded = rounded.split() if isinstance(rounded, str) else rounded
    shape = (rounded, digits, dates.split(), ints.split())

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _comparable(build(apply_settings(spark), sf_dir), *shape)

        name = build.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(_comparable_sql(sql, *shape), views)
        return build

    return register
