"""Expressions over the feature array, and the two feature layouts.

Array layout: ``key..., features ARRAY<FLOAT>``, one row per key.
Long layout: ``key..., feature_idx INT, value``, one row per cell. Statistics
per feature run on the long layout because its partial aggregate collapses each
task's rows to one per feature before anything is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scalars import col, is_infinite, nan_to_null, number_or_null

FEATURE_PREFIX = "v_"


def feature_names(columns: Sequence[str], prefix: str = FEATURE_PREFIX) -> list[str]:
    """Columns with the prefix, ordered by the whole number that follows it."""
    found = [c for c in columns if c.startswith(prefix)]
    wrong = [c for c in found if not re.fullmatch(r"[+-]?\d+", c.split("_")[1])]
    if wrong:
        raise ValueError(f"feature columns need a whole number after the prefix: {wrong[:5]}")
    return sorted(found, key=lambda c: int(c.split("_")[1]))


def to_array(
    df: DataFrame,
    features: Sequence[str],
    out: str = "features",
    nan_is_null: bool = True,
    dtype: str = "float",
) -> DataFrame:
    """Fold scalar feature columns into one array column.

    The columns become an array first and are cast inside it: one expression,
    whether there are four or thousands of them.
    """
    folded = set(features)
    keep = [_quoted(c) for c in df.columns if c not in folded]
    cells = df.selectExpr(*keep, f"array({', '.join(map(_quoted, features))}) AS {_quoted(out)}")
    return cells.withColumn(out, F.transform(out, lambda x: number_or_null(x, nan_is_null, dtype)))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def spread(df: DataFrame, array: str, names: Sequence[str], dtype: str = "double") -> DataFrame:
    """Unfold an array column into named scalar columns."""
    keep = [c for c in df.columns if c != array]
    cells = [F.col(array)[i].cast(dtype).alias(n) for i, n in enumerate(names)]
    return df.select(*keep, *cells)


def to_long(df: DataFrame, features: str = "features", keys: Sequence[str] = ()) -> DataFrame:
    return df.select(*keys, F.posexplode(F.col(features)).alias("feature_idx", "value"))


def from_long(df: DataFrame, keys: Sequence[str], out: str = "features") -> DataFrame:
    """Collect cells back; a group holds one row's cells, so the array width bounds it."""
    cells = F.array_sort(F.collect_list(F.struct("feature_idx", "value")))
    return df.groupBy(*keys).agg(F.transform(cells, lambda x: x["value"]).alias(out))


def by_feature(stats: DataFrame, value: str) -> Column:
    """One array in feature order from a table with one row per feature.

    A scalar subquery: Catalyst runs it once and hands tasks a literal whose
    size is the number of features.
    """
    cells = F.array_sort(F.collect_list(F.struct("feature_idx", F.col(value).alias("v"))))
    return stats.agg(F.transform(cells, lambda x: x["v"]).alias("cells")).scalar()


def nulls_for_nans(features: Column | str) -> Column:
    return F.transform(col(features), nan_to_null)


def nulls_for_infinities(features: Column | str) -> Column:
    return F.transform(col(features), lambda x: F.when(F.abs(x) != F.lit(float("inf")), x))


def zero_filled(features: Column | str) -> Column:
    return F.transform(col(features), lambda x: F.coalesce(nan_to_null(x), F.lit(0.0).cast("float")))


def missing_cells(features: Column | str) -> Column:
    return F.size(F.filter(col(features), lambda x: nan_to_null(x).isNull()))


def all_missing(features: Column | str) -> Column:
    """True when every cell is missing; an empty array has no missing cell."""
    c = col(features)
    return (F.size(c) > 0) & F.forall(c, lambda x: x.isNull() | F.isnan(x))


def any_nonzero(features: Column | str) -> Column:
    """A missing cell counts as different from zero."""
    return F.exists(col(features), lambda x: x.isNull() | (x != 0))


def all_nonzero(features: Column | str) -> Column:
    return F.forall(col(features), lambda x: x.isNull() | (x != 0))


def all_zero(features: Column | str) -> Column:
    return F.forall(col(features), lambda x: x.isNotNull() & (x == 0))


def rescaled_record(values: Column | str, width: int, low: float = 0.1, span: float = 0.9) -> Column:
    """Pad with zeros up to ``width`` and map every cell to ``(x - low) / span``."""
    c = col(values).cast("array<double>")
    padded = F.concat(c, F.array_repeat(F.lit(0.0), F.greatest(F.lit(width) - F.size(c), F.lit(0))))
    return F.transform(padded, lambda x: (x - F.lit(low)) / F.lit(span))


def scaled(features: Column | str, center: Column, scale: Column) -> Column:
    """``(x - center_i) / scale_i`` cell by cell."""
    shifted = F.zip_with(col(features).cast("array<double>"), center, lambda x, m: x - m)
    return F.zip_with(shifted, scale, lambda x, s: x / s)
