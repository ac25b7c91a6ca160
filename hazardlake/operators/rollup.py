"""Aggregations and deduplication.

Every group-by here has a map-side partial aggregate, so a key that holds a
third of all rows reaches its final task as one partial row per input task.
Only sums whose order counts are added row by row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hazardlake.functions.scalars import col, flag_to_float, floor_time
from hazardlake.session import stored

from .ordering import Order


def label_rollup(log: DataFrame, time: str = "batch_time", flag: str = "is_emergency") -> DataFrame:
    """One row per time; the label is the largest flag seen."""
    return log.groupBy(time).agg(F.max(flag).alias(flag))


def context_rollup(log: DataFrame, time: str = "batch_time", flag: str = "is_emergency") -> DataFrame:
    """Operations and emergencies per second, and whether there was any emergency.

    Rows without a readable time are left out; an unreadable flag counts as 0.
    """
    value = F.coalesce(flag_to_float(flag), F.lit(0.0)).cast("bigint")
    return (
        log.select(floor_time("second", time).alias("batch_time"), value.alias("_flag"))
        .filter(F.col("batch_time").isNotNull())
        .groupBy("batch_time")
        .agg(F.count(F.lit(1)).alias("n_ops"), F.sum("_flag").alias("n_emergency_ops"))
        .withColumn("ground_truth", (F.col("n_emergency_ops") > 0).cast("int"))
    )


def with_address(df: DataFrame) -> DataFrame | None:
    """The rows with ``_file`` and ``_row``, where each one stands; None if they do not come straight from Parquet files."""
    try:
        return df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    except AnalysisException:
        return None


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Order = ()) -> DataFrame:
    """First row per key in the given order; rows equal in it follow the files' order, and so do all if none is given.

    Of rows that come from files only keys, order and addresses are aggregated.
    The wide rows are joined by address: they are shuffled once and sorted
    nowhere, and a key that a third of them share is not dealt to one task.
    Rows that are computed (a join, another aggregate) have no address; there
    the order should be total within a key, and whole rows are aggregated
    rather than computed twice or written out. Without an order they are
    written to the shared folder, and that is their order.
    """
    rows = with_address(df)
    if rows is None:
        if order_by:
            rest = [c for c in df.columns if c not in set(keys)]
            order = F.struct(*[col(c).alias(f"o{i}") for i, c in enumerate(order_by)])
            picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_row"))
            return picked.select(*[c if c in set(keys) else F.col(f"_row.{c}").alias(c) for c in df.columns])
        rows = with_address(stored(df, "rows"))
    order = F.struct(*[col(c).alias(f"o{i}") for i, c in enumerate(order_by)], F.col("_file"), F.col("_row"))
    narrow = rows.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], order.alias("_order"))
    first = narrow.groupBy(*[f"k{i}" for i in range(len(keys))]).agg(F.min("_order").alias("_first"))
    first = first.select(F.col("_first._file").alias("_its"), F.col("_first._row").alias("_at"))
    here = (F.col("_row") == F.col("_at")) & (F.col("_file") == F.col("_its"))
    return rows.join(first.hint("shuffle_hash"), here, "left_semi").select(*df.columns)


def sums_in_file_order(df: DataFrame, keys: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """One row per key with its sums, added one row after the other as they stand in the files.

    Floating sums depend on the order of their terms. Partial sums are merged in
    the order they arrive; where a sum is then cut to a whole number, one lost
    bit changes the result. A key's rows are sorted and streamed, never held together.
    """
    rows = with_address(df)
    if rows is None:
        rows = with_address(stored(df, "rows"))
    order = W.partitionBy(*keys).orderBy("_file", "_row")
    upto = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    narrow = rows.select(*keys, "_file", "_row", *[e.alias(f"_of_{n}") for n, e in sums.items()])
    running = narrow.select(
        *keys, *[F.sum(f"_of_{n}").over(upto).alias(n) for n in sums], F.lead(F.lit(True)).over(order).alias("_more")
    )
    return running.filter(F.col("_more").isNull()).drop("_more")


def key_counts(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows belong to a key that occurs more than once."""
    n = F.col("n")
    return key_counts(df, keys).agg(F.coalesce(F.sum(F.when(n > 1, n)), F.lit(0)).alias("duplicate_rows"))


def column_profile(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Per column: rows, missing cells, distinct present values.

    Distinct values are counted by (column, value) first, so the exact count
    needs no set in memory and a frequent value collapses before the shuffle.
    """
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in columns])
    )
    cells = df.select(pairs.alias("cell")).select("cell.*")
    if approximate:
        return cells.groupBy("column_name").agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col("v").isNull()).alias("n_null"),
            F.approx_count_distinct("v").alias("n_distinct"),
        )
    return (
        cells.groupBy("column_name", "v")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("column_name")
        .agg(
            F.sum("n").alias("n_rows"),
            F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("n_null"),
            F.count("v").alias("n_distinct"),
        )
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return key_counts(df, [column])


def calendar_parts(df: DataFrame, time: str) -> DataFrame:
    """The distinct years, months and days of the month that occur, as sorted arrays.

    The sets are bounded by the calendar, not by the data.
    """
    parts = {"years": F.year(time), "months": F.month(time), "days": F.dayofmonth(time)}
    return df.agg(*[F.sort_array(F.collect_set(e)).alias(n) for n, e in parts.items()])


def daily_counts(log: DataFrame, time: str, flag: str = "is_emergency") -> DataFrame:
    """Rows per class and day."""
    return log.groupBy(F.col(flag).alias("flag"), F.to_date(time).alias("day")).agg(
        F.count(F.lit(1)).alias("n")
    )


def extreme_days(daily: DataFrame) -> DataFrame:
    """Busiest and quietest day of each class; the earliest day wins a tie."""
    peak = F.min_by(F.struct("day", "n"), F.struct(-F.col("n"), "day"))
    low = F.min_by(F.struct("day", "n"), F.struct("n", "day"))
    return (
        daily.groupBy("flag")
        .agg(peak.alias("p"), low.alias("l"))
        .select(
            "flag",
            F.col("p.day").alias("peak_day"),
            F.col("p.n").alias("peak_n"),
            F.col("l.day").alias("low_day"),
            F.col("l.n").alias("low_n"),
        )
    )


def entities_on_days(log: DataFrame, days: DataFrame, time: str, entity: str, flag: str = "is_emergency") -> DataFrame:
    """Entities of the chosen (flag, day) pairs with their row counts.

    The pairs filter the log before it is grouped; entities stay rows instead
    of being collected into one list per day.
    """
    tagged = log.select(F.col(flag).alias("flag"), F.to_date(time).alias("day"), F.col(entity).alias(entity))
    return (
        tagged.join(days.select("flag", "day").distinct(), ["flag", "day"], "left_semi")
        .groupBy("flag", "day", entity)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def daily_mode(log: DataFrame, time: str, entity: str, flag: str = "is_emergency") -> DataFrame:
    """Most frequent entity per class and day; the lowest wins a tie."""
    counts = log.groupBy(
        F.col(flag).alias("flag"), F.to_date(time).alias("day"), F.col(entity).alias(entity)
    ).agg(F.count(F.lit(1)).alias("n"))
    best = F.min_by(F.struct(entity, "n"), F.struct(-F.col("n"), entity))
    return counts.groupBy("flag", "day").agg(best.alias("b")).select("flag", "day", f"b.{entity}", "b.n")


def class_counts(df: DataFrame, label: str) -> DataFrame:
    y = F.col(label)
    return df.agg(F.count_if(y == 1).alias("positives"), F.count_if(y == 0).alias("negatives"))


def positive_weight(
    df: DataFrame,
    label: str,
    mode: str = "statistical",
    explicit: float | None = None,
    cost_fn: float = 1000.0,
    cost_fp: float = 10.0,
) -> DataFrame:
    """One row with the weight of a positive row.

    ``explicit`` wins whenever it is given (0 counts as not given: 1.0);
    ``cost_matrix`` is the cost ratio; ``statistical`` is negatives per
    positive, 1.0 without positives.
    """
    if cost_fp <= 0:
        raise ValueError("a false alarm must cost something")
    per_positive = F.try_divide(F.col("negatives"), F.col("positives"))
    weights = {
        "explicit": F.lit(float(explicit or 1.0)),
        "cost_matrix": F.lit(cost_fn / cost_fp),
        "statistical": F.coalesce(per_positive, F.lit(1.0)),
    }
    chosen = mode if explicit is None else "explicit"
    if chosen not in weights:
        raise ValueError(f"unknown weight mode {mode!r}; one of {', '.join(weights)}")
    return class_counts(df, label).withColumn("pos_weight", weights[chosen].cast("double"))


def class_shares(df: DataFrame, label: str) -> DataFrame:
    """Rows and share of all rows per label value."""
    counts = value_counts(df, label)
    total = df.agg(F.count(F.lit(1)).alias("t")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def with_class_weight(df: DataFrame, label: str, weight: float | Column, out: str = "weight") -> DataFrame:
    w = weight if isinstance(weight, Column) else F.lit(float(weight))
    return df.withColumn(out, F.when(F.col(label) == 1, w).otherwise(F.lit(1.0)))
