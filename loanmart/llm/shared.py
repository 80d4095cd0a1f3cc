"""Reading the given tables, and tables that a job writes for itself in the shared folder."""

from __future__ import annotations

import ctypes
import gc
import shutil
import tempfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loanmart.session import apply_settings, cut_lineage

_PACKAGE = Path(__file__).resolve().parent.parent


def ready(spark: SparkSession) -> SparkSession:
    """Settings, and this package on the executors: the driver serves them an archive of it."""
    context = spark.sparkContext
    if not getattr(context, "_loanmart_served", False):
        archive = Path(tempfile.mkdtemp(prefix="loanmart-")) / "loanmart-package"
        context.addPyFile(shutil.make_archive(str(archive), "zip", _PACKAGE.parent, _PACKAGE.name))
        context._loanmart_served = True
    return apply_settings(spark)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/documents.parquet")


def utf8(text: str | Column) -> Column:
    """The bytes of a text; none for null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary")


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder, read back."""
    return cut_lineage(df)


def partitions(spark: SparkSession, rows: int, per_task: int) -> int:
    """Partitions for ``rows`` rows with about ``per_task`` each, no fewer than the session's own."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_task))


def collect_garbage(spark: SparkSession) -> None:
    """Makes Spark drop the shuffle files of jobs whose tables nothing refers to any more, which otherwise stay on the
    executors' disks until memory on the driver happens to run short."""
    gc.collect()
    spark._jvm.System.gc()


def give_back() -> None:
    """Returns a Python worker's free memory to the system: workers stay, and would go on holding the most that a task took."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc has it
        trim(0)


def forget(*tables: DataFrame) -> None:
    """Deletes tables made by ``written`` that nothing will read again, and the shuffle files of the jobs that made them."""
    for table in tables:
        jvm = table.sparkSession.sparkContext._jvm
        for folder in {file.rpartition("/")[0] for file in table.inputFiles()[:1]}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
    if tables:
        collect_garbage(tables[0].sparkSession)
