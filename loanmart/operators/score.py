"""Scoring: schema guard, column mapping, prediction output."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

from loanmart.functions.numbers import known, to_double

# Columns of the prediction tables.
PREDICTION_COLUMNS = ("customer_id", "prediction", "probability", "rawPrediction")
INFERENCE_COLUMNS = ("customer_id", "application_date", "probability", "prediction")


def map_equivalents(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Fill a missing target column from its near equivalent when that one is present."""
    return df.withColumns(
        {
            target: F.col(source)
            for target, source in mapping.items()
            if target not in df.columns and source in df.columns
        }
    )


def ensure_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Every required column present and double; a missing one is 0.0."""
    return df.withColumns(
        {c: to_double(F.col(c)) if c in df.columns else F.lit(0.0) for c in required}
    )


def expected_inputs(model: PipelineModel) -> list[str]:
    """Inputs of the pipeline's assemblers, each once, in order."""
    names = [
        name
        for stage in model.stages
        if isinstance(stage, VectorAssembler)
        for name in stage.getInputCols()
    ]
    if not names:
        raise ValueError("the pipeline has no assembler to take its inputs from")
    return list(dict.fromkeys(names))


def available(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.select(*[c for c in columns if c in df.columns])


def score_batch(
    model: PipelineModel,
    features: DataFrame,
    mapping: Mapping[str, str] | None = None,
    columns: Iterable[str] = PREDICTION_COLUMNS,
    nulls: str = "fill",
) -> DataFrame:
    """Predictions for a feature table; columns the model needs but lacks are 0.0.

    Every row leaves with a prediction: a null or NaN input counts as 0.0, the way the training rows
    are prepared. With ``nulls="keep"`` such rows leave with null predictions instead, and
    ``missing_inputs`` says how many inputs were missing; ``nulls="skip"`` leaves them out.
    """
    if nulls not in ("fill", "keep", "skip"):
        raise ValueError(f"nulls must be fill, keep or skip, not {nulls!r}")
    inputs = expected_inputs(model)
    guarded = ensure_columns(map_equivalents(features, mapping or {}), inputs)
    absent = {c: known(F.col(c)).isNull() for c in inputs}
    missing = sum((gap.cast("int") for gap in absent.values()), F.lit(0))
    guarded = guarded.withColumn("missing_inputs", missing)
    if nulls == "skip":
        guarded = guarded.where("missing_inputs = 0")
    filled = guarded.withColumns({c: F.when(gap, 0.0).otherwise(F.col(c)) for c, gap in absent.items()})
    scored = model.transform(filled)
    if nulls == "keep":
        outputs = [c for c in scored.columns if c not in filled.columns]
        scored = scored.withColumns({c: F.when(F.col("missing_inputs") == 0, F.col(c)) for c in outputs})
    return available(scored, [*columns, "missing_inputs"] if nulls == "keep" else columns)
