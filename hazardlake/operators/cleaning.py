"""Row filters and policies for missing and infinite cells (array layout)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlake.functions import arrays
from hazardlake.functions.arrays import by_feature, missing_cells, to_long
from hazardlake.functions.scalars import nan_to_null

from .moments import exact_medians, partial_moments

MISSING_POLICIES = ("fail", "drop", "fill_zero", "fill_mean", "fill_median")
INFINITE_POLICIES = ("fail", "replace_with_nan")

# Fixed value: rank error of the approximate percentile is at most rows / this.
PERCENTILE_ACCURACY = 10_000


def with_known_flag(df: DataFrame, flag: str = "is_emergency") -> DataFrame:
    return df.filter(F.col(flag).isin(True, False))


def with_flag(df: DataFrame, value: bool, flag: str = "is_emergency") -> DataFrame:
    return df.filter(F.col(flag) == F.lit(value))


def drop_zero_rows(df: DataFrame, features: str = "features", every: bool = False) -> DataFrame:
    """Keep rows with any (or every) cell different from 0."""
    test = arrays.all_nonzero if every else arrays.any_nonzero
    return df.filter(test(features))


def drop_missing(df: DataFrame, subset: Sequence[str] | None = None, how: str = "any") -> DataFrame:
    return df.na.drop(how, subset=list(subset) if subset else None)


def infinite_counts(df: DataFrame, features: str = "features") -> DataFrame:
    """Infinite cells per feature position."""
    counts = partial_moments(df, features).groupBy("feature_idx").agg(F.sum("infinite").alias("n_inf"))
    return counts.select("feature_idx", "n_inf")


def replace_infinite(df: DataFrame, features: str = "features") -> DataFrame:
    return df.withColumn(features, arrays.nulls_for_infinities(features))


def drop_sparse_rows(df: DataFrame, max_fraction: float = 0.9, features: str = "features") -> DataFrame:
    """Drop rows whose share of missing cells is above the limit; a row without cells misses none."""
    return df.filter(~is_sparse(missing_cells(features), F.size(features), max_fraction))


def is_sparse(missing: Column, width: Column, max_fraction: float) -> Column:
    return F.coalesce(F.try_divide(missing, width), F.lit(0.0)) > F.lit(max_fraction)


def feature_means(df: DataFrame, features: str = "features") -> DataFrame:
    """Mean of the present cells per position; 0 where none is present."""
    parts = partial_moments(df, features)
    mean = F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum("n"))
    return parts.groupBy("feature_idx").agg(F.coalesce(mean, F.lit(0.0)).alias("fill"))


def feature_medians(df: DataFrame, features: str = "features", approximate: bool = False) -> DataFrame:
    """Median of the present cells per position; 0 where none is present. Exact unless told otherwise."""
    if not approximate:
        return exact_medians(df, features)
    cells = to_long(df, features).select("feature_idx", nan_to_null(F.col("value").cast("double")).alias("value"))
    middle = F.percentile_approx("value", 0.5, PERCENTILE_ACCURACY)
    return cells.groupBy("feature_idx").agg(F.coalesce(middle, F.lit(0.0)).alias("fill"))


def fill_with(df: DataFrame, fills: Column, features: str = "features") -> DataFrame:
    """Replace missing cells by the position's value of an array."""
    # The array is a column of its own first: a subquery may not stand inside zip_with.
    cells = F.zip_with(F.col(features), F.col("_fills"), lambda x, f: F.coalesce(nan_to_null(x), f.cast("float")))
    return df.withColumn("_fills", fills).withColumn(features, cells).drop("_fills")


def fill_missing(
    df: DataFrame, policy: str = "fill_zero", features: str = "features", approximate: bool = False
) -> DataFrame:
    """Apply a policy to missing cells; statistics come from the rows given."""
    if policy == "fill_zero":
        return df.withColumn(features, arrays.zero_filled(features))
    if policy == "fill_mean":
        return fill_with(df, by_feature(feature_means(df, features), "fill"), features)
    if policy == "fill_median":
        return fill_with(df, by_feature(feature_medians(df, features, approximate), "fill"), features)
    if policy == "drop":
        return df.filter(missing_cells(features) == 0)
    raise ValueError(f"unknown missing-value policy: {policy!r}")
