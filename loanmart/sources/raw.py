"""Raw CSV files in, CSV files out."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# A doubled quote inside a quoted field stands for one quote.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"'}


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower() for name in df.columns])


def read_raw(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Headed CSV. Without a schema every column is text, so no inference pass is made."""
    reader = spark.read.options(**CSV_OPTIONS)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", False)
    return lower_names(reader.csv(path))


def read_raw_optional(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """None when the source does not exist; every other fault is raised."""
    try:
        return read_raw(spark, path, schema)
    except AnalysisException as fault:
        if fault.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def write_csv(df: DataFrame, path: str) -> None:
    """One file per task; nothing passes through the driver."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
