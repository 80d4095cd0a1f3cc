"""Drift report of a current sample against a reference sample."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from loanmart.operators import drift
from loanmart.operators.cleaning import numeric_columns
from loanmart.plans.scoring import newest_predictions
from loanmart.session import apply_settings, cut_lineage, release, written_so_far
from loanmart.sources.tables import append_report, read_snapshots


def matched_sample(
    reference: DataFrame, predictions: DataFrame, key: str = "customer_id"
) -> tuple[DataFrame, list[str], str | None]:
    """The reference against itself as matched by the predictions.

    The current side holds each reference row as often as its key was predicted, kept as a
    weight. Columns both tables share carry a suffix after the pairing and are no features.
    """
    features = [
        c for c in numeric_columns(reference) if c not in predictions.columns and c != key
    ]
    if key not in reference.columns or key not in predictions.columns:
        return drift.two_sided(reference, reference), features, None
    current = drift.match_weights(reference, predictions, key)
    sided = reference.select(
        *features, F.lit(1).cast("bigint").alias("n_matches"), F.lit("ref").alias(drift.SIDE)
    ).unionByName(current.select(*features, "n_matches", F.lit("cur").alias(drift.SIDE)))
    return sided, features, "n_matches"


def report(
    sided: DataFrame,
    features: Sequence[str],
    root: str,
    violations: DataFrame | None = None,
    method: str = "reference",
    weight: str | None = None,
) -> DataFrame:
    """Append metrics, alerts and summary below ``root``; returns the summary."""
    spark = apply_settings(sided.sparkSession)
    mark = written_so_far(spark)
    metrics = drift.with_flags(drift.drift_metrics(sided, features, method, weight)).cache()
    clock = F.current_timestamp().alias("reported_at")
    summary = drift.drift_summary(metrics, violations)
    append_report(metrics.select("*", clock), f"{root}/metrics")
    append_report(drift.drift_alerts(metrics).select("*", clock), f"{root}/alerts")
    summary = cut_lineage(summary)
    append_report(summary.select("*", clock), f"{root}/summary")
    metrics.unpersist()
    reported = summary.collect()  # one row
    schema = summary.schema
    release(spark, mark)
    return spark.createDataFrame(reported, schema)


def run(
    spark: SparkSession, samples: str, features: str, predictions: str, root: str, key: str = "customer_id"
) -> DataFrame:
    """Report of the stored out-of-time sample, or of the feature table without one, against itself as
    matched by the newest stored predictions."""
    apply_settings(spark)
    try:
        reference = spark.read.parquet(f"{samples}/oot")
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        reference = read_snapshots(spark, features)
    sided, names, weight = matched_sample(reference, newest_predictions(spark, predictions), key)
    return report(sided, names, root, weight=weight)
