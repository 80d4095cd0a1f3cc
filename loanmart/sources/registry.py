"""Model registry: one row per saved artefact, and the saved pipelines themselves."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from loanmart.session import one_row

REGISTRY_SCHEMA = "name string, path string, created_at timestamp"


def latest_artifact(registry: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Newest path, per group when ``by`` is given; equal times are settled by the path."""
    newest = F.max_by("path", F.struct("created_at", "path")).alias("path")
    return registry.groupBy(*(by or [])).agg(newest, F.max("created_at").alias("created_at"))


def with_prefix(registry: DataFrame, prefix: str) -> DataFrame:
    return registry.where(F.col("name").startswith(prefix))


def save_model(model: PipelineModel, name: str, bank: str, stamp: str) -> DataFrame:
    """Save a fitted pipeline below ``bank`` and note it in the registry table."""
    spark = SparkSession.active()
    path = f"{bank}/{name}_{stamp}"
    model.write().overwrite().save(path)
    entry = one_row(spark, name=name, path=path).withColumn("created_at", F.current_timestamp())
    entry.write.mode("append").parquet(f"{bank}/registry")
    return entry


def load_latest_model(spark: SparkSession, bank: str, prefix: str = "") -> PipelineModel:
    registry = spark.read.schema(REGISTRY_SCHEMA).parquet(f"{bank}/registry")
    newest = latest_artifact(with_prefix(registry, prefix)).first()
    if newest is None or newest["path"] is None:
        raise FileNotFoundError(f"no model named {prefix}* in {bank}")
    return PipelineModel.load(newest["path"])
