"""Batch scoring: contract, scaler, model or fixed weights, threshold, context, order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlake.functions.arrays import feature_names, to_array, zero_filled
from hazardlake.functions.scalars import linear_score, sigmoid
from hazardlake.sources import artifacts, delimited, tables

from .evaluation import apply_threshold
from .joins import attach_context
from .models import with_probability
from .scaling import apply_scaler

# Columns tried for the time of a scored row, before the configured one.
TIME_COLUMNS = ("batch_time", "date")


def pick_time(columns: Sequence[str], configured: str = "date") -> str | None:
    """First known time column that exists; None if there is none."""
    return next((c for c in (*TIME_COLUMNS, configured) if c in columns), None)


def missing_columns(columns: Sequence[str], contract: Sequence[str]) -> list[str]:
    present = set(columns)
    return [c for c in contract if c not in present]


def project_contract(
    df: DataFrame, contract: Sequence[str] | None = None, expected_width: int | None = None, out: str = "features"
) -> DataFrame:
    """Exactly the contract's feature columns, in its order, as one zero-filled array."""
    if contract is None:
        contract = feature_names(df.columns)
    missing = missing_columns(df.columns, contract)
    if missing:
        raise ValueError(f"missing {len(missing)} feature columns of {len(contract)}: {missing[:5]}")
    if expected_width is not None and expected_width != len(contract):
        raise ValueError(f"the model expects {expected_width} features, the input has {len(contract)}")
    extra = set(feature_names(df.columns)) - set(contract)
    folded = to_array(df.drop(*extra), contract, out)
    return folded.withColumn(out, zero_filled(out))


def effective_threshold(tuned: float | None, configured: float = 0.5, use_tuned: bool = True) -> float:
    return float(tuned) if tuned is not None and use_tuned else float(configured)


def score(
    df: DataFrame,
    threshold: float | Column,
    model: Model | None = None,
    weights: Sequence[float] | None = None,
    bias: float = 0.0,
    params: DataFrame | None = None,
    log: DataFrame | None = None,
    time: str | None = "batch_time",
    features: str = "features",
) -> DataFrame:
    """``probability, prediction, threshold, time [, context]`` for every row."""
    scaled = apply_scaler(df, params, features)
    if model is not None:
        scored = with_probability(model, scaled, features)
    elif weights is not None:
        scored = scaled.withColumn("probability", sigmoid(linear_score(features, weights, bias)))
    else:
        raise ValueError("a model or weights are needed")
    result = apply_threshold(scored, threshold).select(
        "probability", "prediction", "threshold", *([time] if time else [])
    )
    if log is None or time is None:
        return result
    return attach_context(result, log, time)


def score_folder(
    spark: SparkSession,
    model_path: str,
    telemetry_path: str,
    log_path: str | None = None,
    scaler_path: str | None = None,
    configured_threshold: float = 0.5,
    use_tuned: bool = True,
    sink: str | None = None,
) -> DataFrame:
    """Score delimited telemetry with a saved model: contract, scaler, model, threshold, context, sorted sink.

    The saved metadata names the features and the tuned threshold; the result
    is also written, most likely first, if a ``sink`` is given.
    """
    metadata = artifacts.load_metadata(spark, model_path)
    raw = delimited.read_telemetry(spark, telemetry_path)
    time = pick_time(raw.columns)
    ready = project_contract(raw, metadata["feature_columns"], metadata["n_features"])
    result = score(
        ready,
        effective_threshold(metadata["extra"].get("optimal_threshold"), configured_threshold, use_tuned),
        model=artifacts.load_model(spark, model_path),
        params=artifacts.load_scaler(spark, scaler_path) if scaler_path else None,
        log=delimited.read_event_log(spark, log_path) if log_path else None,
        time=time,
    )
    if sink:
        tables.write_predictions(result, sink, time)
    return result


def by_risk(predictions: DataFrame, time: str | None = "batch_time") -> DataFrame:
    """Most likely first; a global range sort, never one task."""
    return predictions.orderBy(F.desc("probability"), *([time] if time else []))


def risk_report(predictions: DataFrame, time: str = "batch_time", hits: int = 10, otherwise: int = 5) -> DataFrame:
    """The ``hits`` most likely predicted positives, or the ``otherwise`` most likely rows if there are none.

    Both candidates are found in one pass: positives and all rows are ranked by
    a bounded top-k each, and the second is used only when the first is empty.
    """
    positives = predictions.filter(F.col("prediction") == 1)
    order = [F.desc("probability"), F.col(time)]
    none_predicted = predictions.agg(F.count_if(F.col("prediction") == 1).alias("n")).scalar() == 0
    top = positives.orderBy(*order).limit(hits)
    fallback = predictions.orderBy(*order).limit(otherwise).filter(none_predicted)
    return top.unionByName(fallback)
