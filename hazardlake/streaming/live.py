"""Live scoring and the streaming forms of roll-up and deduplication.

Each function takes a streaming DataFrame and runs it until stopped, or with
``once=True`` until what is there now has been processed. Progress and state
live in a checkpoint folder, so a restarted job continues where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hazardlake.functions.arrays import all_zero, rescaled_record
from hazardlake.functions.scalars import linear_score, sigmoid

# Outcomes of a live record.
ALERT, NO_ALERT, NO_INFORMATION = "alert", "no_alert", "no_information"


def follow(spark: SparkSession, folder: str, schema, file_glob: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files that arrive in a folder."""
    reader = spark.readStream.schema(schema)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def judge(
    records: DataFrame,
    weights: Sequence[float],
    bias: float = 0.0,
    threshold: float = 0.5,
    values: str = "values",
    rescale: bool = True,
) -> DataFrame:
    """Score records and name the outcome; works on batch and streaming input.

    A record of zeros carries no information. The test looks at the raw record,
    before it is rescaled.
    """
    width = len(weights)
    cells = rescaled_record(values, width) if rescale else F.col(values)
    scored = records.withColumn("probability", sigmoid(linear_score(cells, weights, bias)))
    outcome = (
        F.when(all_zero(values), F.lit(NO_INFORMATION))
        .when(F.col("probability") >= threshold, F.lit(ALERT))
        .otherwise(F.lit(NO_ALERT))
    )
    return scored.withColumn("outcome", outcome)


def _start(writer, once: bool, interval: str) -> StreamingQuery:
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def run_to_table(
    stream: DataFrame, path: str, checkpoint: str, once: bool = False, interval: str = "1 hour"
) -> StreamingQuery:
    """Append every processed row to a Parquet table, exactly once."""
    writer = stream.writeStream.outputMode("append").format("parquet")
    return _start(writer.option("path", path).option("checkpointLocation", checkpoint), once, interval)


def hourly_rollup(log: DataFrame, time: str = "ts", flag: str = "is_emergency", delay: str = "2 hours") -> DataFrame:
    """Label and operation counts per hour, kept as state until the watermark passes the hour."""
    value = F.col(flag).cast("int")
    return (
        log.withWatermark(time, delay)
        .groupBy(F.window(time, "1 hour").alias("w"))
        .agg(
            F.max(value).alias(flag),
            F.count(F.lit(1)).alias("n_ops"),
            F.sum(value.cast("bigint")).alias("n_emergency_ops"),
        )
        .select(F.col("w.start").alias("batch_time"), flag, "n_ops", "n_emergency_ops")
    )


def run_upserts(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    once: bool = False,
    interval: str = "1 hour",
    keys: Sequence[str] = (),
    merge_every: int = 0,
) -> StreamingQuery:
    """Write each batch's changed rows under its batch number.

    A repeated batch overwrites its own folder, so retries leave no duplicates.
    With ``merge_every`` the state by ``keys`` is merged after so many batches,
    so that reading it does not slow down as batches add up.
    """
    if merge_every and not keys:
        raise ValueError("merging versions needs their keys")

    def write(batch: DataFrame, number: int) -> None:
        write_version(batch, path, number)
        if merge_every and number % merge_every == merge_every - 1:
            merge_versions(batch.sparkSession, path, keys)

    writer = stream.writeStream.outputMode("update").foreachBatch(write)
    return _start(writer.option("checkpointLocation", checkpoint), once, interval)


def write_version(batch: DataFrame, path: str, number: int) -> None:
    batch.write.mode("overwrite").parquet(f"{path}/batch={number}")


def _file_system(spark: SparkSession, path: str) -> tuple[Any, Callable[[str], Any]]:
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path
    return place(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _versions(spark: SparkSession, path: str) -> tuple[list[int], list[int]]:
    """Numbers of the merged states and of the batches that were written to their end."""
    files, place = _file_system(spark, path)
    found: dict[str, list[int]] = {"merged": [], "batch": []}
    for status in files.listStatus(place(path)):
        kind, _, number = status.getPath().getName().partition("=")
        if kind in found and files.exists(place(f"{path}/{kind}={number}/_SUCCESS")):
            found[kind].append(int(number))
    return sorted(found["merged"]), sorted(found["batch"])


def _state(spark: SparkSession, path: str, keys: Sequence[str], merged: int | None, batches: Sequence[int]) -> DataFrame:
    """The newest row of each key, with the number of its batch."""
    parts = []
    if batches:
        parts.append(spark.read.option("basePath", path).parquet(*[f"{path}/batch={n}" for n in batches]).withColumn("batch", F.col("batch").cast("bigint")))
    if merged is not None:
        parts.append(spark.read.parquet(f"{path}/merged={merged}").withColumnRenamed("_version", "batch"))
    if not parts:
        raise ValueError(f"no versions in {path}")
    versions = reduce(DataFrame.unionByName, parts)
    rest = [c for c in versions.columns if c not in set(keys)]
    newest = versions.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_v"))
    return newest.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in rest])


def merge_versions(spark: SparkSession, path: str, keys: Sequence[str]) -> None:
    """Merge the last merged state with the batches after it.

    A merged state counts once its writer has marked it as whole, so one that
    was killed on the way is not read and is written again. What it replaces
    stays until the next merge: whoever began reading it can end, and a merge
    that dies before it deletes loses nothing. Only one merge may run at a time.
    """
    merged, batches = _versions(spark, path)
    last = merged[-1] if merged else None
    new = [n for n in batches if last is None or n > last]
    if not new:
        return
    _state(spark, path, keys, last, new).withColumnRenamed("batch", "_version").write.mode("overwrite").parquet(f"{path}/merged={new[-1]}")
    files, place = _file_system(spark, path)
    if last is None:
        return
    for number in merged[:-1]:
        files.delete(place(f"{path}/merged={number}"), True)
    for number in batches:
        if number <= last:
            files.delete(place(f"{path}/batch={number}"), True)


def latest_versions(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Current state of a table written by :func:`run_upserts`: the last merged state and the batches after it."""
    merged, batches = _versions(spark, path)
    last = merged[-1] if merged else None
    return _state(spark, path, keys, last, [n for n in batches if last is None or n > last]).drop("batch")


def first_in_order(stream: DataFrame, keys: Sequence[str], time: str, order_by: Sequence[str], delay: str = "2 hours") -> DataFrame:
    """Per key and ``time`` the whole first row by an order, whatever order rows arrive in; for :func:`run_upserts`.

    ``time`` is part of the key, so a key's state goes once the watermark has passed it. Rows that come
    later are dropped. The order must be total within a key.
    """
    by = list(dict.fromkeys([*keys, time]))
    rest = [c for c in stream.columns if c not in by]
    order = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order_by)])
    first = stream.withWatermark(time, delay).groupBy(*by).agg(F.min_by(F.struct(*rest), order).alias("_first"))
    return first.select(*[c if c in by else F.col(f"_first.{c}").alias(c) for c in stream.columns])


def first_arrivals(stream: DataFrame, keys: Sequence[str], time: str, delay: str = "2 hours") -> DataFrame:
    """First row to arrive per key; arrival, unlike the batch operator's order, is not sorted."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))
