"""Delimited text in and out."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from hazardlake.functions.scalars import flag_to_float, parse_time

# Fixed patterns: names that stand for a column without a name.
UNNAMED = re.compile(r"(_c\d+|column_.*|Unnamed.*|)")


def scan(spark: SparkSession, path: str | Sequence[str], separator: str = ",", skip_unnamed: bool = False) -> DataFrame:
    """Every column as text, named by the header; bytes that are not UTF-8 become U+FFFD.

    Nothing is inferred, so only the header line is read before the job runs.
    """
    paths = [path] if isinstance(path, str) else list(path)
    try:
        df = spark.read.option("header", True).option("sep", separator).csv(paths)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(f"input not found: {paths}") from e
        raise
    return drop_unnamed(df) if skip_unnamed else df


def drop_unnamed(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if UNNAMED.fullmatch(c)])


def require_column(df: DataFrame, name: str) -> DataFrame:
    if name not in df.columns:
        raise ValueError(f"column {name!r} not found; the input has {df.columns}")
    return df


def read_event_log(
    spark: SparkSession, path: str, separator: str = ",", time: str = "date", flag: str = "is_emergency"
) -> DataFrame:
    """Event log with a parsed ``batch_time`` and a numeric flag.

    The configured time column is used when it exists, else ``batch_time``.
    """
    raw = scan(spark, path, separator)
    source = time if time in raw.columns else "batch_time"
    require_column(require_column(raw, source), flag)
    return raw.withColumn("batch_time", parse_time(source)).withColumn(flag, flag_to_float(flag))


def read_telemetry(
    spark: SparkSession, path: str, separator: str = ";", time: str = "batch_time", skip_unnamed: bool = True
) -> DataFrame:
    """Telemetry text with a parsed time; feature columns stay text until they are folded."""
    raw = require_column(scan(spark, path, separator, skip_unnamed), time)
    return raw.withColumn(time, parse_time(time))


def scan_in_blocks(spark: SparkSession, path: str, size: str = "16MB", separator: str = ",") -> DataFrame:
    """Scan with a given amount of text per task.

    The size is a session setting, so it goes into a session of its own (same
    cluster, same application, the caller's other settings) and leaves the
    caller's reads alone.
    """
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            own.conf.set(name, value)
    own.conf.set("spark.sql.files.maxPartitionBytes", size)
    return scan(own, path, separator)


def write_delimited(df: DataFrame, path: str, separator: str = ",", mode: str = "errorifexists") -> str:
    df.write.mode(mode).option("header", True).option("sep", separator).csv(path)
    return path
