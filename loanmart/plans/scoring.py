"""Scoring of a stored month with the newest stored model."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession

from loanmart.operators.score import score_batch
from loanmart.operators.snapshots import SNAPSHOT
from loanmart.session import apply_settings
from loanmart.sources.registry import load_latest_model
from loanmart.sources.tables import read_snapshots, stored_months, write_snapshots


def run(
    spark: SparkSession,
    features: str,
    bank: str,
    predictions: str,
    wanted: str | None = None,
    prefix: str = "",
    mapping: Mapping[str, str] | None = None,
) -> str:
    """Score the wanted month of a feature table, or its newest; returns the month.

    The predictions of that month replace those there were: ``customer_id, snapshot_date, probability,
    prediction``, a row for each feature row.
    """
    apply_settings(spark)
    months = stored_months(spark, features)
    if not months:
        raise FileNotFoundError(f"{features} holds no month")
    month = wanted if wanted in months else months[-1]
    model = load_latest_model(spark, bank, prefix)
    columns = ["customer_id", SNAPSHOT, "probability", "prediction"]
    scored = score_batch(model, read_snapshots(spark, features, [month]), mapping, columns)
    plain = scored.withColumn("probability", vector_to_array("probability")[1])
    write_snapshots(plain, predictions, months=[month])
    return month


def newest_predictions(spark: SparkSession, predictions: str) -> DataFrame:
    """The predictions of the newest month that has any."""
    months = stored_months(spark, predictions)
    if not months:
        raise FileNotFoundError(f"{predictions} holds no month")
    return read_snapshots(spark, predictions, months[-1:])
