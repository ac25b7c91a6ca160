"""Joins of telemetry, the event log and its roll-ups.

No side is hinted as broadcast: the log side of each join is reduced to one row
per key first, and the optimizer broadcasts it when its real size allows, or
sort-merges with adaptive skew handling when it does not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlake.functions.scalars import floor_time, micros, shift_hours

from .ordering import Order, add_row_index
from .rollup import context_rollup, keep_first, key_counts, label_rollup

CONTEXT_COLUMNS = ("n_ops", "n_emergency_ops", "ground_truth")


def training_table(
    telemetry: DataFrame,
    log: DataFrame,
    order_by: Order,
    time: str = "batch_time",
    flag: str = "is_emergency",
) -> DataFrame:
    """Telemetry (first row per time) with the rolled-up label of the same time."""
    return keep_first(telemetry, [time], order_by).join(label_rollup(log, time, flag), time, "inner")


def attach_context(rows: DataFrame, log: DataFrame, time: str = "batch_time", flag: str = "is_emergency") -> DataFrame:
    """Add operation counts of the same second; times without operations get 0."""
    context = context_rollup(log, time, flag).withColumnRenamed("batch_time", "_second")
    joined = rows.withColumn("_second", floor_time("second", time)).join(context, "_second", "left")
    return joined.select(
        *rows.columns, *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in CONTEXT_COLUMNS]
    )


def label_copies(
    telemetry: DataFrame,
    log: DataFrame,
    unit: str = "minute",
    time: str = "batch_time",
    log_time: str = "date",
    flag: str = "is_emergency",
    expand: bool = False,
) -> DataFrame:
    """Inner join with a log that is *not* unique per time.

    The log is counted per (time, flag) before the join, so a busy time adds
    one row per flag value and telemetry row; ``n_copies`` says how often the
    plain join would repeat it and serves as a weight. ``expand=True`` writes
    the repeats out.
    """
    counts = log.groupBy(floor_time(unit, log_time).alias("_slot"), F.col(flag)).agg(
        F.count(F.lit(1)).alias("n_copies")
    )
    joined = telemetry.withColumn("_slot", floor_time(unit, time)).join(counts, "_slot", "inner").drop("_slot")
    if not expand:
        return joined
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("n_copies")))).drop("_copy", "n_copies")


def horizon_label(
    telemetry: DataFrame,
    log: DataFrame,
    hours: int = 3,
    within: bool = False,
    time: str = "batch_time",
    log_time: str = "date",
    flag: str = "is_emergency",
    out: str = "label",
) -> DataFrame:
    """1 where an emergency lies exactly ``hours`` ahead, or in ``(t, t + hours]`` with ``within``.

    For ``within``, time is cut into buckets as wide as the horizon. What
    follows ``t`` inside the horizon lies in t's bucket or in the next one, so
    the latest emergency of the one and the earliest of the other decide: an
    equi-join with one row per bucket instead of a range join over pairs.
    """
    hits = log.filter(F.col(flag).cast("int") == 1)
    if not within:
        times = hits.select(F.col(log_time).alias("_ahead"), F.lit(1).alias(out)).distinct()
        joined = telemetry.withColumn("_ahead", shift_hours(time, hours)).join(times, "_ahead", "left")
        return joined.drop("_ahead").withColumn(out, F.coalesce(F.col(out), F.lit(0)))
    width = hours * 3_600_000_000
    at = micros(log_time)
    edges = (
        hits.select(_bucket(at, width).alias("_bucket"), at.alias("_at"))
        .groupBy("_bucket")
        .agg(F.max("_at").alias("_latest"), F.min("_at").alias("_earliest"))
    )
    # Each bucket's latest emergency, and the earliest one of the bucket after it.
    nothing = F.lit(None).cast("bigint")
    limits = (
        edges.select("_bucket", "_latest", nothing.alias("_next"))
        .unionByName(
            edges.select(
                (F.col("_bucket") - 1).alias("_bucket"),
                nothing.alias("_latest"),
                F.col("_earliest").alias("_next"),
            )
        )
        .groupBy("_bucket")
        .agg(F.max("_latest").alias("_latest"), F.max("_next").alias("_next"))
    )
    tagged = telemetry.withColumn("_t", micros(time)).withColumn("_bucket", _bucket(F.col("_t"), width))
    hit = (F.col("_latest") > F.col("_t")) | (F.col("_next") <= F.col("_t") + F.lit(width))
    return tagged.join(limits, "_bucket", "left").select(
        *telemetry.columns, F.coalesce(hit, F.lit(False)).cast("int").alias(out)
    )


def _bucket(at: Column, width: int) -> Column:
    """Whole-number division; the remainder goes first, so no rounding is involved."""
    return ((at - F.pmod(at, F.lit(width))) / F.lit(width)).cast("bigint")


def at_emergency_times(
    telemetry: DataFrame, log: DataFrame, time: str = "batch_time", log_time: str = "date", flag: str = "is_emergency"
) -> DataFrame:
    """Telemetry rows whose time is that of an emergency."""
    hits = log.filter(F.col(flag).cast("int") == 1).select(F.col(log_time).alias(time))
    return telemetry.join(hits, time, "left_semi")


def log_with_telemetry(log: DataFrame, telemetry: DataFrame, log_time: str = "date", time: str = "batch_time") -> DataFrame:
    """Every log row once, with the telemetry of its time where there is any."""
    right = telemetry.withColumnRenamed(time, "_t")
    return log.join(right, F.col(log_time) == F.col("_t"), "left").drop("_t")


def positional_join(
    left: DataFrame,
    right: DataFrame,
    left_order: Order,
    right_order: Order,
    agree: tuple[str, str] | None = None,
    left_key: Sequence[str] | None = None,
    right_key: Sequence[str] | None = None,
) -> DataFrame:
    """Row i of one table beside row i of the other; ``agree`` keeps rows whose two columns match.

    With unique keys for both sides only order and keys are ranked and paired,
    and the wide rows are joined to the pairs.
    """
    if left_key and right_key:
        one, two = list(left_key), list(right_key)
        a = add_row_index(_ranked(left, left_order, one), left_order, "row_idx").select("row_idx", *[F.col(c).alias(f"_l_{c}") for c in one])
        b = add_row_index(_ranked(right, right_order, two), right_order, "row_idx").select("row_idx", *[F.col(c).alias(f"_r_{c}") for c in two])
        pairs = a.join(b, "row_idx", "inner")
        joined = pairs.join(left, _same(one, "_l_", left), "inner").join(right, _same(two, "_r_", right), "inner")
        joined = joined.select("row_idx", *left.columns, *right.columns)
    else:
        a = add_row_index(left, left_order, "row_idx")
        b = add_row_index(right, right_order, "row_idx")
        joined = a.join(b, "row_idx", "inner")
    return joined.filter(F.col(agree[0]) == F.col(agree[1])) if agree else joined


def _ranked(df: DataFrame, order: Order, key: Sequence[str]) -> DataFrame:
    names = [c for c in order if isinstance(c, str)]
    return df.select(*dict.fromkeys([*names, *key]))


def _same(key: Sequence[str], prefix: str, df: DataFrame) -> list[Column]:
    return [F.col(f"{prefix}{c}").eqNullSafe(df[c]) for c in key]


def lookup_first(df: DataFrame, dimension: DataFrame, key: str, order_by: Order) -> DataFrame:
    """Left join with the first dimension row per key."""
    return df.join(keep_first(dimension, [key], order_by), key, "left")


def join_multiplicity(log: DataFrame, telemetry: DataFrame, key: str = "batch_time") -> DataFrame:
    """One row that tells how far an inner join on ``key`` would repeat rows.

    ``estimated_rows`` sums the smaller of both counts per key and
    ``multiplicity`` relates it to the shared keys; it understates the fan-out,
    so ``true_join_rows`` sums the product as well.
    """
    a = key_counts(log, [key], "n1")
    b = key_counts(telemetry, [key], "n2")
    pairs = a.join(b, key, "full").select("n1", "n2", (F.col("n1").isNotNull() & F.col("n2").isNotNull()).alias("both"))
    both = F.col("both")
    n1, n2 = F.col("n1"), F.col("n2")
    counts = pairs.filter(both | (n1 > 0) | (n2 > 0)).agg(
        F.count_if(both).alias("shared_keys"),
        F.coalesce(F.sum(F.when(both, F.least(n1, n2))), F.lit(0)).alias("estimated_rows"),
        F.coalesce(F.sum(F.when(both, n1.cast("double") * n2)), F.lit(0.0)).alias("true_join_rows"),
        F.coalesce(F.max("n1"), F.lit(1)).alias("max_log_rows"),
        F.coalesce(F.max("n2"), F.lit(1)).alias("max_telemetry_rows"),
    )
    return counts.withColumn(
        "multiplicity", F.col("estimated_rows") / F.greatest(F.col("shared_keys"), F.lit(1))
    )
