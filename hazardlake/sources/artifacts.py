"""Saved contracts and parameters, readable from any file system Spark can reach."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.ml import Model
from pyspark.ml.util import DefaultParamsReader, MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCALER_KINDS = ("standard", "minmax")


def write_json(spark: SparkSession, path: str, data: Mapping[str, Any]) -> str:
    """One line of JSON under ``path``."""
    text = spark.createDataFrame([(json.dumps(dict(data)),)], "value string")
    text.coalesce(1).write.mode("overwrite").text(path)
    return path


def read_json(spark: SparkSession, path: str) -> dict[str, Any]:
    """A JSON document from a file, or from a folder written by :func:`write_json`."""
    try:
        rows = spark.read.text(path, wholetext=True).filter("trim(value) != ''").limit(2).collect()
    except AnalysisException as e:
        raise FileNotFoundError(f"not found: {path}") from e
    if len(rows) != 1:
        raise ValueError(f"expected one JSON document in {path}")
    return json.loads(rows[0]["value"])


def save_contract(spark: SparkSession, path: str, columns: Sequence[str]) -> str:
    return write_json(spark, path, {"feature_columns": list(columns), "n_features": len(columns)})


def load_contract(spark: SparkSession, path: str) -> list[str]:
    return list(read_json(spark, path)["feature_columns"])


def contract_for(spark: SparkSession, path: str, width: int) -> list[str]:
    """The saved names, or generated ones where none were saved; their number must fit."""
    try:
        columns = load_contract(spark, path)
    except FileNotFoundError:
        columns = [f"v_{i}" for i in range(width)]
    if len(columns) != width:
        raise ValueError(f"the contract names {len(columns)} features, the table has {width}")
    return columns


def save_scaler(params: DataFrame, path: str) -> str:
    """Scaler parameters as Parquet, one row per feature position."""
    params.write.mode("overwrite").parquet(path)
    return path


def load_scaler(spark: SparkSession, path: str) -> DataFrame:
    """Saved parameters; without a kind they are taken as min-max, an unknown kind is an error."""
    try:
        params = spark.read.parquet(path)
    except AnalysisException as e:
        raise FileNotFoundError(f"scaler not found: {path}") from e
    if "kind" not in params.columns:
        return params.withColumn("kind", F.lit("minmax"))
    kinds = [r["kind"] for r in params.select("kind").distinct().limit(3).collect()]
    unknown = [k for k in kinds if k not in SCALER_KINDS]
    if unknown:
        raise ValueError(f"unknown scaler kind: {unknown[0]!r}")
    return params


def save_model(
    spark: SparkSession,
    model: MLWritable,
    path: str,
    columns: Sequence[str],
    threshold: float | None = None,
    extra: Mapping[str, Any] | None = None,
) -> str:
    """Model folder plus its metadata: features, their number and the tuned threshold."""
    model.write().overwrite().save(f"{path}/model")
    notes = dict(extra or {})
    if threshold is not None:
        notes["optimal_threshold"] = float(threshold)
    write_json(
        spark,
        f"{path}/metadata",
        {"feature_columns": list(columns), "n_features": len(columns), "input_dim": len(columns), "extra": notes},
    )
    return path


def load_model(spark: SparkSession, path: str) -> Model:
    """The model saved at ``path``; Spark ML's own metadata names its class."""
    try:
        return DefaultParamsReader.loadParamsInstance(f"{path}/model", spark)
    except Exception as e:
        if "does not exist" in str(e) or "Input path" in str(e):
            raise FileNotFoundError(f"model not found: {path}") from e
        raise


def save_parameters(spark: SparkSession, path: str, parameters: Mapping[str, Any]) -> str:
    """The settings of a training run beside its model."""
    return write_json(spark, f"{path}/parameters", parameters)


def load_parameters(spark: SparkSession, path: str) -> dict[str, Any]:
    return read_json(spark, f"{path}/parameters")


def load_metadata(spark: SparkSession, path: str) -> dict[str, Any]:
    return read_json(spark, f"{path}/metadata")
