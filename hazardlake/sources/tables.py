"""Parquet tables: given inputs, training tables, predictions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .artifacts import read_json, write_json
from .delimited import write_delimited


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def write_table(df: DataFrame, path: str, mode: str = "overwrite", by_day: str | None = None) -> str:
    """Write Parquet, optionally in one folder per day of a time column."""
    if by_day is None:
        df.write.mode(mode).parquet(path)
        return path
    # No repartition by day: one day may hold most rows, and every task may
    # write its share of it.
    df.withColumn("day", F.to_date(by_day)).write.mode(mode).partitionBy("day").parquet(path)
    return path


def append_table(df: DataFrame, path: str) -> str:
    return write_table(df, path, "append")


def _marker(path: str) -> str:
    return f"{path.rstrip('/')}-state"


def is_complete(spark: SparkSession, path: str) -> bool:
    """True if :func:`reuse_or_write` finished writing this table."""
    try:
        return read_json(spark, _marker(path))["state"] == "complete"
    except FileNotFoundError:
        return False


def reuse_or_write(spark: SparkSession, path: str, build: Callable[[], DataFrame], by_day: str | None = None) -> DataFrame:
    """The table at ``path`` if it is complete, else build and write it first.

    A marker beside the table says so; a build that was cut short leaves it
    at "building", and the next call starts over.
    """
    if not is_complete(spark, path):
        write_json(spark, _marker(path), {"state": "building"})
        write_table(build(), path, "overwrite", by_day)
        write_json(spark, _marker(path), {"state": "complete"})
    return spark.read.parquet(path)


def write_predictions(predictions: DataFrame, path: str, time: str | None = "batch_time", mode: str = "overwrite") -> str:
    """Most likely first, as delimited text with a header; files are in global order."""
    ordered = predictions.orderBy(F.desc("probability"), *([time] if time else []))
    return write_delimited(ordered, path, mode=mode)
