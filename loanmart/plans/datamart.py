"""Backfill of the datamart: raw sources to bronze, silver and gold snapshot tables.

One job per table covers all months; a run over some months replaces only those months; a refresh finds out which
months must be replaced.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import DateType, StructField, StructType

from loanmart.functions.dates import month_start, parse_date
from loanmart.operators import cleaning, gold
from loanmart.operators.snapshots import (
    NORMALIZED,
    SNAPSHOT,
    rows_by_month,
    with_default_snapshot,
    with_lineage,
    with_normalized_snapshot,
)
from loanmart.session import apply_settings
from loanmart.sources import manifest
from loanmart.sources.digest import month_digests
from loanmart.sources.raw import lower_names, read_raw_optional
from loanmart.sources.tables import read_snapshots, regrouped, stored_schema, write_snapshots

# Raw files per dataset.
RAW_FILES = {
    "loans": "lms_loan_daily.csv",
    "attributes": "features_attributes.csv",
    "financials": "features_financials.csv",
    "clickstream": "feature_clickstream.csv",
}
# counting rows per month opens no column
MONTH_ONLY = StructType([StructField(SNAPSHOT, DateType())])
SIDES = ("clickstream", "attributes", "financials")


@dataclass(frozen=True)
class Layout:
    """Where the tables of a datamart live."""

    root: str

    def table(self, layer: str, dataset: str) -> str:
        return f"{self.root}/{layer}/{dataset}"


def raw_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The raw files that exist in a folder."""
    found = {name: read_raw_optional(spark, f"{folder}/{f}") for name, f in RAW_FILES.items()}
    return {name: df for name, df in found.items() if df is not None}


def bronze(raw: DataFrame, months: Iterable[str] | None = None) -> DataFrame:
    """Raw rows of first-of-month snapshots, dates normalised, everything else untouched."""
    raw = lower_names(raw)
    months = None if months is None else list(months)
    if SNAPSHOT not in raw.columns:
        if months is None or len(months) != 1:
            raise ValueError("a source without snapshot dates needs exactly one month")
        raw = with_default_snapshot(raw, months[0]).withColumn(
            SNAPSHOT, F.col(SNAPSHOT).cast("string")
        )
    # a condition on the parsed date would parse it again for each mention; an array of it does so once a row
    others = [c for c in raw.columns if c not in (SNAPSHOT, NORMALIZED)]
    found = F.filter(F.array(parse_date(F.col(SNAPSHOT))), lambda day: day == month_start(day))
    kept = raw.select(*others, F.explode(found).alias(SNAPSHOT))
    return kept if months is None else kept.where(_in(months))


# why a raw row is in no table, in the order in which the rules are applied
REASONS = ("unreadable date", "not the first of a month", "no key", "no amount")


def with_reason(raw: DataFrame, dataset: str, generation: str = "typed") -> DataFrame:
    """Raw rows with the normalised date and ``reason``: the first rule that keeps the row out of bronze or silver, else null.

    The flat generation keeps every row that has a date.
    """
    dated = with_normalized_snapshot(lower_names(raw))
    day = F.col(NORMALIZED)
    found = F.when(day.isNull(), REASONS[0]).when(day != month_start(day), REASONS[1])
    if generation == "typed":
        keys = ("loan_id", "customer_id") if dataset == "loans" else ("customer_id",)
        without = F.lit(False)
        for key in keys:
            without = without | F.col(key).isNull()
        found = found.when(without, REASONS[2])
        if dataset == "loans":
            paid = F.coalesce(cleaning.cast_dirty(F.col("loan_amt"), "double") > 0, F.lit(False))
            found = found.when(~paid, REASONS[3])
    return dated.withColumn("reason", found)


def write_rejects(raw: DataFrame, dataset: str, path: str, counts: Mapping[str, int]) -> None:
    """The rows left out, by reason, as a table of its own; the source is read for it only where some were counted."""
    if any(counts.values()):
        left = raw.where(F.col("reason").isNotNull()).drop(NORMALIZED)
        write_snapshots(left, path, month="reason", whole=True)
    else:
        write_snapshots(raw.drop(NORMALIZED).where("false"), path, month="reason", regroup=False, whole=True)


def bronze_with_rejects(
    spark: SparkSession, layout: Layout, name: str, source: DataFrame, generation: str = "typed"
) -> dict[str, int]:
    """Write the bronze table of all months of a source, and what is rejected; returns the raw rows and those of each reason.

    The counts are observed while bronze is written, so no pass is made for them.
    """
    marked, seen = with_reason(source, name, generation), Observation()
    counted = marked.observe(
        seen, F.count(F.lit(1)).alias("raw"), *[F.count_if(F.col("reason") == r).alias(r) for r in REASONS]
    )
    in_bronze = F.col("reason").isNull() | F.col("reason").isin(*REASONS[2:])
    rows = counted.where(in_bronze).drop("reason", SNAPSHOT).withColumnRenamed(NORMALIZED, SNAPSHOT)
    write_snapshots(with_lineage(rows, "bronze"), layout.table("bronze", name), whole=True)
    counts = {k: int(v) for k, v in seen.get.items()}
    write_rejects(marked, name, layout.table("rejects", name), {r: counts[r] for r in REASONS})
    return counts


def silver(
    dataset: str, table: DataFrame, generation: str = "typed", clean: str = "plain"
) -> DataFrame:
    """Cleaned rows; ``generation`` picks the delay rule and how much is cast."""
    if generation == "typed":
        return {
            "loans": cleaning.silver_loans,
            "clickstream": cleaning.silver_clickstream,
            "attributes": lambda df: cleaning.silver_attributes(df, clean),
            "financials": lambda df: cleaning.silver_financials(df, clean),
        }[dataset](table)
    if generation != "flat":
        raise ValueError(f"unknown generation {generation!r}")
    if dataset == "loans":
        return cleaning.silver_loans_flat(table)
    if dataset == "clickstream":
        return cleaning.cast_prefix(table, "fe_")
    return cleaning.typed_by_content(table)


def gold_stores(
    tables: Mapping[str, DataFrame | None], generation: str = "typed", threshold: int = 30,
    mob: int = 6, keep: Callable[[DataFrame], DataFrame] = lambda labels: labels,
) -> tuple[DataFrame, DataFrame]:
    """``(features, labels)``; loans are required, the other tables optional.

    ``keep`` may write the labels and return what is stored, so that features that have labels do not derive them again.
    """
    loans = tables.get("loans")
    if loans is None:
        raise FileNotFoundError("the gold layer needs the silver loans table")
    sides = {
        name: tables[name].drop(*[c for c in cleaning.SYSTEM_COLUMNS if c != SNAPSHOT])
        for name in SIDES
        if tables.get(name) is not None
    }
    if generation == "typed":
        features = gold.feature_store(
            loans, sides.get("clickstream"), sides.get("attributes"), sides.get("financials")
        )
        return features, keep(gold.label_store_at_mob(loans, threshold, mob))
    states = gold.feature_store_by_state(
        loans, sides.get("financials"), sides.get("attributes"), sides.get("clickstream")
    )
    labels = keep(gold.label_store_by_customer(loans, threshold))
    return gold.attach_labels(states, labels), labels


def _stamped(rows: DataFrame) -> DataFrame:
    """Bronze rows brought together by month, then stamped, so that the stamps are not shuffled."""
    return with_lineage(regrouped(rows, SNAPSHOT), "bronze")


def run(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    root: str,
    months: Iterable[str] | None = None,
    generation: str = "typed",
    clean: str = "plain",
    threshold: int = 30,
    mob: int = 6,
) -> Layout:
    """Write all layers of the given months (all months when none are listed).

    Listed months end with exactly the source's rows, none if it has none; a run over all
    months also removes those that have vanished from the source.
    """
    apply_settings(spark)
    layout = Layout(root)
    months = None if months is None else list(months)

    def stored(rows: DataFrame, layer: str, dataset: str, regroup: bool) -> DataFrame:
        """Write a table and go on from it; an empty one keeps its columns and types."""
        path = layout.table(layer, dataset)
        write_snapshots(rows, path, regroup=regroup, months=months, whole=months is None)
        return read_snapshots(spark, path, months, schema=rows.schema)

    def to_silver(name: str) -> DataFrame:
        rows = stored(_stamped(bronze(raw[name], months)), "bronze", name, False)
        rows = rows.drop("bronze_ingestion_timestamp", "bronze_processing_date")
        cleaned = silver(name, rows, generation, clean)
        if months is not None:
            cleaned = as_stored(cleaned, stored_schema(spark, layout.table("silver", name)))
        return stored(cleaned, "silver", name, False)

    # sources do not depend on each other: the small ones run where the large one leaves cores idle
    with ThreadPoolExecutor(max(1, len(raw))) as pool:
        tables = dict(zip(raw, pool.map(inheritable_thread_target(spark)(to_silver), raw)))
    # labels at one month on book are filtered silver rows; labels by customer are aggregated
    features, _ = gold_stores(
        tables, generation, threshold, mob, keep=lambda labels: stored(labels, "gold", "label_store", generation != "typed")
    )
    stamped = features.withColumn("gold_processing_date", F.current_timestamp())
    write_snapshots(stamped, layout.table("gold", "feature_store"), months=months, whole=months is None)
    return layout


# columns that tell when a row was processed; they are no part of its content
LINEAGE = ("bronze_ingestion_timestamp", "bronze_processing_date", "gold_processing_date")


def _entries(spark: SparkSession, path: str) -> dict[str, dict]:
    found = manifest.read(spark, path)
    return dict(found.months) if found else {}


def _rebuild(
    spark: SparkSession, path: str, inputs: Mapping[str, dict[str, str]], build: Callable[[list[str]], DataFrame], regroup: bool
) -> list[str]:
    """Replace the months of a table whose ``inputs`` differ from those noted when they were last built.

    ``inputs`` names what each month is made of, by digest; a month that has none any more is emptied. The digest
    of the new rows is noted with them, so that tables made of this one see whether it has changed.
    """
    known = manifest.read(spark, path)
    before = {m: e.get("inputs") for m, e in (known.months if known else {}).items()}
    wanted = {m: json.dumps(of, sort_keys=True) for m, of in inputs.items()}
    stale = sorted(m for m in {*before, *wanted} if before.get(m) != wanted.get(m))
    if stale or known is None:
        notes = {m: {"inputs": wanted[m]} for m in stale if m in wanted}
        write_snapshots(build(stale), path, regroup=regroup, months=stale, notes=notes, digest_without=LINEAGE)
    return stale


def refresh(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    root: str,
    generation: str = "typed",
    clean: str = "plain",
    threshold: int = 30,
    mob: int = 6,
) -> tuple[Layout, list[tuple[str, str, str]]]:
    """Bring all layers up to date with the sources; returns ``(layer, dataset, month)`` of every month built anew.

    Each source is read once to digest its months and once more for what is to be built, so one that is costly to derive
    should be a written table; of every table only those months are written whose inputs, or whose rule,
    differ from those noted in its manifest. A month of a gold table depends on the same month of the silver
    tables, so a month that comes out of silver as it was feeds nothing. A run that fails leaves tables whose
    notes are those of what they hold, and the next one goes on from there.
    """
    apply_settings(spark)
    layout, built = Layout(root), []

    def done(layer: str, dataset: str, months: list[str]) -> None:
        built.extend((layer, dataset, m) for m in months)

    for name, source in raw.items():
        rows = bronze(source)
        digests = month_digests(rows, SNAPSHOT)
        path = layout.table("bronze", name)
        done("bronze", name, _rebuild(
            spark, path, {m: {"source": d} for m, d in digests.items()},
            lambda months: _stamped(rows.where(_in(months))), False,
        ))
        silver_path, rule = layout.table("silver", name), f"{generation} {clean}"

        def cleaned(months: list[str]) -> DataFrame:
            held = read_snapshots(spark, path, months).drop(*LINEAGE)
            return as_stored(silver(name, held, generation, clean), stored_schema(spark, silver_path))

        feeds = {m: {"bronze": e["digest"], "rule": rule} for m, e in _entries(spark, path).items() if "digest" in e}
        done("silver", name, _rebuild(spark, silver_path, feeds, cleaned, False))
    entries = {name: _entries(spark, layout.table("silver", name)) for name in raw}

    def feeds_of(names: Iterable[str], rule: str) -> dict[str, dict[str, str]]:
        """Months of loans, with the digest of that month in each table."""
        live = [m for m, e in entries.get("loans", {}).items() if "digest" in e]
        return {m: {"rule": rule} | {n: entries[n][m]["digest"] for n in names if "digest" in entries[n].get(m, {})} for m in live}

    def stores(months: list[str]) -> tuple[DataFrame, DataFrame]:
        tables = {name: read_snapshots(spark, layout.table("silver", name), months) for name in raw}
        return gold_stores(tables, generation, threshold, mob)

    rule = f"{generation} {threshold} {mob}"
    done("gold", "feature_store", _rebuild(
        spark, layout.table("gold", "feature_store"), feeds_of(raw, rule),
        lambda months: stores(months)[0].withColumn("gold_processing_date", F.current_timestamp()), True,
    ))
    done("gold", "label_store", _rebuild(
        spark, layout.table("gold", "label_store"), feeds_of(["loans"], rule), lambda months: stores(months)[1], generation != "typed",
    ))
    return layout, built


def _in(months: Iterable[str]):
    return F.col(SNAPSHOT).isin([F.lit(m).cast("date") for m in months])


def as_stored(rows: DataFrame, schema: StructType | None) -> DataFrame:
    """Some months of a table in the types its other months have.

    Fails, rather than losing the value, where a number is stored and a new row has text.
    """
    if schema is None:
        return rows
    kinds = {field.name: field.dataType for field in schema}
    return rows.withColumns(
        {c: F.col(c).cast(kinds[c]) for c, kind in rows.dtypes if c in kinds and kinds[c].simpleString() != kind}
    )


def layer_counts(spark: SparkSession, layout: Layout, datasets: Iterable[str]) -> DataFrame:
    """Rows per table and month as written."""
    names = [(layer, d) for layer in ("bronze", "silver") for d in datasets]
    names += [("gold", "feature_store"), ("gold", "label_store")]
    result = None
    for layer, dataset in names:
        table = read_snapshots(spark, layout.table(layer, dataset), schema=MONTH_ONLY)
        counted = rows_by_month(table, f"{layer}.{dataset}")
        result = counted if result is None else result.unionByName(counted)
    return result
