"""Monthly snapshot tables: one Parquet table per dataset, partitioned by snapshot month, published by manifest.

What a write replaces stays readable until the new rows are complete; see :mod:`loanmart.sources.manifest`.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from loanmart.sources import manifest
from loanmart.sources.digest import month_digests
from loanmart.sources.manifest import ConcurrentWrite, Manifest

SNAPSHOT = "snapshot_date"


def regrouped(df: DataFrame, month: str = SNAPSHOT) -> DataFrame:
    """Rows of a month together, a large month in several tasks."""
    return df.hint("rebalance", month)


def write_snapshots(
    df: DataFrame,
    path: str,
    month: str = SNAPSHOT,
    regroup: bool = True,
    months: Iterable[str] | None = None,
    whole: bool = False,
    notes: Mapping[str, dict] | None = None,
    digest_without: Iterable[str] | None = None,
) -> Manifest:
    """Replace the months present in ``df``; running twice changes nothing.

    ``months`` lists the months the rows stand for: those without rows end empty. ``whole`` says that the rows are all there
    is, so that months no longer among them vanish. ``df`` may be read from ``path``. ``regroup`` brings rows together by month
    so that files stay few; ``rebalance`` lets adaptive execution cut a large month into several files instead of one giant task.
    Rows that come straight from a snapshot table lie together already and need no shuffle.

    Readers see the old months until all new files are written, then the new ones. If another writer has published some of
    the same months meanwhile, ``ConcurrentWrite`` is raised and its rows stay. The table's columns and types are
    kept in its manifest, as are ``notes`` on each month and, where ``digest_without`` lists columns to leave out, the digest of its rows.
    """
    spark = df.sparkSession
    months = None if months is None else [str(m) for m in months]
    seen = _manifest_or_folders(spark, path, month)
    generation = f"{(seen.version if seen else 0) + 1:06d}-{uuid.uuid4().hex[:12]}"
    place = manifest.place(path, generation)
    try:
        rows = regrouped(df, month) if regroup else df
        rows.write.partitionBy(month).parquet(place)
        written = [n.partition("=")[2] for n in manifest.names(spark, place) if n.startswith(f"{month}=")]
        if not written:
            manifest.remove(spark, place)
        digests = {}
        if digest_without is not None and written:
            digests = month_digests(spark.read.schema(df.schema).parquet(place), month, digest_without)
        entries = {m: {"generation": generation, "share": len(written)} for m in written}
        entries |= {m: {"generation": None} for m in months or () if m not in entries and m in (notes or {})}
        for m, entry in entries.items():
            entry |= (notes or {}).get(m, {}) | ({"digest": digests[m]} if m in digests else {})
        touched = {*written, *(months or ())}

        def change(now: Manifest | None) -> Manifest:
            if now is None or now.version == 0:
                now = _manifest_or_folders(spark, path, month)
            before, there = (seen.months if seen else {}), (now.months if now else {})
            replaced = {*touched, *there, *before} if whole else touched
            if clash := sorted(m for m in replaced if before.get(m) != there.get(m)):
                raise ConcurrentWrite(f"{path}: another writer has published {', '.join(clash)}")
            kept = {} if whole else {m: e for m, e in there.items() if m not in touched}
            schema = df.schema
            if not whole and now is not None and now.schema is not None:
                known = {f.name: f for f in schema}
                schema = StructType([known.pop(f.name, f) for f in now.schema] + list(known.values()))
            return Manifest((now.version if now else 0) + 1, schema, kept | entries)

        published = manifest.publish(spark, path, change)
    except BaseException:
        manifest.remove(spark, place)
        raise
    manifest.drop_old(spark, path)
    return published


# columns of a table without manifests, kept beside its months
SCHEMA_FILE = "_columns.json"


def _manifest_or_folders(spark: SparkSession, path: str, month: str) -> Manifest | None:
    """The newest manifest; for a table written otherwise, version 0 with the month folders found."""
    found = manifest.read(spark, path)
    if found is not None:
        return found
    held = [n.partition("=")[2] for n in manifest.names(spark, path) if n.startswith(f"{month}=")]
    entries = {m: {"generation": "", "share": 0} for m in held}
    return Manifest(0, stored_schema(spark, path), entries) if held else None


def stored_schema(spark: SparkSession, path: str) -> StructType | None:
    """Columns and types of a table as its writer left them; None for a table written otherwise."""
    found = manifest.read(spark, path)
    if found is not None:
        return found.schema
    text = manifest.read_text(spark, f"{path}/{SCHEMA_FILE}")
    return None if text is None else StructType.fromJson(json.loads(text))


def stored_months(spark: SparkSession, path: str, month: str = SNAPSHOT) -> list[str]:
    """Months a table has rows of, oldest first, without looking into them."""
    found = _manifest_or_folders(spark, path, month)
    return sorted(m for m in (found.live() if found else {}) if not m.startswith("__HIVE"))


def read_snapshots(
    spark: SparkSession,
    path: str,
    months: Iterable[str] | None = None,
    month: str = SNAPSHOT,
    schema: StructType | None = None,
    version: int | None = None,
) -> DataFrame:
    """All months of a table, or only the listed ones (partition pruning), as of its newest or a given version.

    Columns and types are those kept with the table, or a given ``schema``, so no file is opened for
    them; in a table written otherwise, all files' columns are merged by name.
    """
    months = None if months is None else [str(m) for m in months]
    found = manifest.read(spark, path, version)
    if found is None:
        schema = schema or stored_schema(spark, path)
        reader = spark.read.option("mergeSchema", True) if schema is None else spark.read.schema(schema)
        df = reader.parquet(path)
    else:
        df = _published(spark, path, found, months, month, schema or found.schema)
    if months is None:
        return df
    return df.where(F.col(month).isin([F.lit(m).cast("date") for m in months]))


def _published(
    spark: SparkSession, path: str, found: Manifest, months: list[str] | None, month: str, schema: StructType | None
) -> DataFrame:
    """The rows a manifest names. A generation whose months are all live is read by its folder alone."""
    live, by = found.live(), {}
    for m, entry in live.items():
        by.setdefault(entry["generation"], []).append(m)
    places, beside = [], []
    for generation, held in by.items():
        wanted = [m for m in held if months is None or m in months]
        root = manifest.place(path, generation)
        if generation and wanted and len(held) == live[held[0]]["share"]:
            places.append(root)
        else:
            (places if generation else beside).extend(f"{root}/{month}={m}" for m in wanted)
    parts = []
    if places:
        reader = spark.read.schema(StructType([*schema, StructField(manifest.GENERATION, StringType())]))
        parts.append(reader.option("basePath", path).parquet(*places).drop(manifest.GENERATION))
    if beside:
        reader = spark.read.option("mergeSchema", True) if schema is None else spark.read.schema(schema)
        parts.append(reader.option("basePath", path).parquet(*beside))
    if not parts:
        ordered = [f for f in schema if f.name != month] + [f for f in schema if f.name == month]
        return spark.createDataFrame([], StructType(ordered))
    df = parts[0]
    return df.unionByName(parts[1], allowMissingColumns=True) if len(parts) > 1 else df


def read_snapshots_optional(
    spark: SparkSession, path: str, months: Iterable[str] | None = None
) -> DataFrame | None:
    """None when the table does not exist or has never held a row."""
    try:
        return read_snapshots(spark, path, months)
    except AnalysisException as fault:
        if fault.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_first_available(
    spark: SparkSession, paths: Iterable[str], months: Iterable[str] | None = None
) -> DataFrame | None:
    """The first of several places a dataset may be stored at; None when there is none."""
    found = (read_snapshots_optional(spark, path, months) for path in paths)
    return next((table for table in found if table is not None), None)


def latest_snapshot(df: DataFrame, wanted: str | None = None, month: str = SNAPSHOT) -> Column:
    """The wanted month when the table has it, else its newest month; a scalar subquery."""
    newest = F.max(month)
    if wanted is not None:
        wanted_date = F.lit(wanted).cast("date")
        newest = F.coalesce(F.max(F.when(F.col(month) == wanted_date, wanted_date)), newest)
    return df.agg(newest.alias("latest")).scalar()


def at_latest_snapshot(
    df: DataFrame, wanted: str | None = None, month: str = SNAPSHOT
) -> DataFrame:
    return df.where(F.col(month) == latest_snapshot(df, wanted, month))


def newest_listed_snapshot(
    tables: Iterable[DataFrame], wanted: Iterable[str], month: str = SNAPSHOT
) -> Column:
    """Newest of the wanted months that at least one of the tables holds."""
    held = None
    for table in tables:
        months = table.select(month)
        held = months if held is None else held.unionByName(months)
    listed = F.col(month).isin([F.lit(m).cast("date") for m in wanted])
    return held.where(listed).agg(F.max(month).alias("latest")).scalar()


def append_report(df: DataFrame, path: str) -> None:
    """Metric, drift and alert rows accumulate in a Parquet report table."""
    df.write.mode("append").parquet(path)
