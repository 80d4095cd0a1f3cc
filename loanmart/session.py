"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

# Runtime settings every job of this package relies on. Skewed joins are split by adaptive
# execution even when that costs another shuffle: one customer may own a third of all rows.
SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


# Temporary folders of local sessions, and tables written by ``cut_lineage``, by application.
_LOCAL: dict[str, str | None] = {}
_WRITTEN: dict[str, list[str]] = {}


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str, cores: str | int = "*", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return apply_settings(spark)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may run without that setting; it gets a temporary folder. Tables go to
    a folder of the application below it; the session's own settings stay as they are.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if context.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = _LOCAL.setdefault(context.applicationId, None) or tempfile.mkdtemp(prefix="loanmart-")
        _LOCAL[context.applicationId] = named
    return f"{named}/{context.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def one_row(spark: SparkSession, **values) -> DataFrame:
    """A single row of literals."""
    return spark.range(1).select(*[F.lit(v).alias(name) for name, v in values.items()])


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Later branches see the same rows whatever executors are lost, read only the columns they
    need, and are planned with the true size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "written")
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def written_so_far(spark: SparkSession) -> int:
    """A mark for ``release``: what is written after it can be deleted without what was there before."""
    return len(_WRITTEN.get(spark.sparkContext.applicationId, []))


def release(spark: SparkSession, since: int = 0) -> int:
    """Delete the tables ``cut_lineage`` has written since a mark; returns their number.

    For jobs whose result no longer reads them, and for the end of a session.
    """
    paths = _WRITTEN.get(spark.sparkContext.applicationId, [])
    gone, paths[since:] = paths[since:], []
    for path in gone:
        _delete(spark, path)
    return len(gone)
