"""Tables stored in hash buckets of the keys they will be joined on, so that these joins shuffle neither side.

The rows are shuffled once, when they are written: one sorted file a bucket. Two tables in equally many buckets of the same
keys are then joined bucket by bucket, straight from their scans. A table is published by manifest like a
snapshot table, so a write that fails leaves the old rows. The catalogue entry a bucketed scan needs is made when the table is
read and holds no data.

All rows of a key are in one bucket and a scan of buckets cannot be split afterwards. Use all columns of the join as keys:
a customer's many loans lie apart when loan or month are keys beside the customer. Where one full key is hot, store snapshot tables
and let adaptive execution split the join.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from loanmart.sources import manifest
from loanmart.sources.manifest import ConcurrentWrite, Manifest

WHOLE = "rows"  # the only entry in the manifest of a table without months


def _entry(spark: SparkSession, path: str) -> tuple[Manifest, dict]:
    found = manifest.read(spark, path)
    if found is None or "buckets" not in found.months.get(WHOLE, {}):
        raise FileNotFoundError(f"no bucketed table at {path}")
    return found, found.months[WHOLE]


def _layout(keys: Sequence[str], buckets: int) -> str:
    columns = ", ".join(f"`{k}`" for k in keys)
    return f"CLUSTERED BY ({columns}) SORTED BY ({columns}) INTO {buckets} BUCKETS"


def _register(spark: SparkSession, place: str, columns: str, keys: Sequence[str], buckets: int) -> str:
    """Name of a catalogue entry over a folder; made anew under the same name by every session that reads it."""
    name = f"bucketed_{hashlib.md5(place.encode()).hexdigest()}"
    quoted = place.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {_layout(keys, buckets)} LOCATION '{quoted}'")
    return name


def _columns(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """Replace a table by ``df`` in ``buckets`` sorted files; readers see the old rows until the new ones are complete."""
    spark = df.sparkSession
    seen = manifest.read(spark, path)
    generation = f"{(seen.version if seen else 0) + 1:06d}-{uuid.uuid4().hex[:12]}"
    place = manifest.place(path, generation)
    name = _register(spark, place, _columns(df), keys, buckets)
    try:
        df.repartition(buckets, *keys).sortWithinPartitions(*keys).write.insertInto(name)
        entry = {"generation": generation, "share": 1, "keys": list(keys), "buckets": buckets}

        def change(now: Manifest | None) -> Manifest:
            if (now.version if now else 0) != (seen.version if seen else 0):
                raise ConcurrentWrite(f"{path}: another writer has published")
            return Manifest((now.version if now else 0) + 1, df.schema, {WHOLE: entry})

        manifest.publish(spark, path, change)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        manifest.remove(spark, place)
        raise
    _drop_old(spark, path)


def _drop_old(spark: SparkSession, path: str) -> None:
    """Files and catalogue entries that only versions older than the newest two name."""
    there = manifest.versions(spark, path)
    for version in there[: -manifest.KEPT]:
        old = manifest.read(spark, path, version).months[WHOLE]["generation"]
        place = manifest.place(path, old)
        spark.sql(f"DROP TABLE IF EXISTS bucketed_{hashlib.md5(place.encode()).hexdigest()}")
        manifest.remove(spark, place)
        manifest.remove(spark, f"{path}/{manifest.FOLDER}/{version:010d}.json")


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The newest rows of a table; a join on its keys needs no exchange of them."""
    found, entry = _entry(spark, path)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema)
    name = _register(spark, manifest.place(path, entry["generation"]), columns, entry["keys"], entry["buckets"])
    return spark.table(name)


def join_stored(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Merge join of two tables in the same buckets, without moving either, however small one may be."""
    return left.hint("merge").join(right, list(keys), how)
