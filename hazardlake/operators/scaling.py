"""Scalers and principal components.

Scaler parameters are a table with one row per feature position
``(feature_idx, kind, center, scale, var, low, high, n)``; they are fitted in
one pass that leaves one row per task and feature.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import PCA, PCAModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlake.functions.arrays import scaled
from hazardlake.functions.scalars import nan_to_null
from hazardlake.session import stored

from .moments import feature_moments

PARAMETER_COLUMNS = ("feature_idx", "kind", "center", "scale", "var", "low", "high", "n")


def fit_standard(
    df: DataFrame, features: str = "features", missing_as_zero: bool = True, ddof: int = 0
) -> DataFrame:
    """Mean and standard deviation per position.

    By default missing cells count as 0 in the sums and as rows in ``n``.
    A deviation of 0 becomes a scale of 1.
    """
    stats = feature_moments(df, features, missing_as_zero)
    freedom = F.col("n") - F.lit(ddof)
    var = F.when(freedom > 0, F.col("squares") / freedom).otherwise(F.lit(0.0))
    stats = stats.select(
        "feature_idx", F.lit("standard").alias("kind"), F.col("mean").alias("center"), var.alias("var"), "low", "high", "n"
    )
    scale = F.when(F.col("var") > 0, F.sqrt("var")).otherwise(F.lit(1.0))
    return stats.withColumn("scale", scale).select(*PARAMETER_COLUMNS)


def fit_minmax(df: DataFrame, features: str = "features") -> DataFrame:
    """Smallest and largest present cell per position; a range of 0 becomes 1."""
    stats = feature_moments(df, features)
    width = F.col("high") - F.col("low")
    return stats.select(
        "feature_idx",
        F.lit("minmax").alias("kind"),
        F.col("low").alias("center"),
        F.when(width > 0, width).otherwise(F.lit(1.0)).alias("scale"),
        F.lit(None).cast("double").alias("var"),
        "low",
        "high",
        "n",
    )


def fit_scaler(df: DataFrame, kind: str = "standard", features: str = "features") -> DataFrame | None:
    if kind == "standard":
        return fit_standard(df, features)
    if kind == "minmax":
        return fit_minmax(df, features)
    if kind == "none":
        return None
    raise ValueError(f"unknown scaler kind: {kind!r}")


def require_rows(df: DataFrame) -> DataFrame:
    """Fitting on nothing is an error."""
    if df.isEmpty():
        raise ValueError("cannot fit a scaler on an empty table")
    return df


def parameters(params: DataFrame) -> Column:
    """Center and scale arrays in position order, as one scalar subquery."""
    cells = F.array_sort(F.collect_list(F.struct("feature_idx", "center", "scale")))
    return params.agg(
        F.struct(
            F.transform(cells, lambda c: c["center"]).alias("center"),
            F.transform(cells, lambda c: c["scale"]).alias("scale"),
        ).alias("p")
    ).scalar()


def apply_scaler(df: DataFrame, params: DataFrame | None, features: str = "features", out: str | None = None) -> DataFrame:
    """``(x - center) / scale`` per cell; new data is not clipped."""
    if params is None:
        return df if out in (None, features) else df.withColumn(out, F.col(features))
    cells = scaled(features, F.col("_params.center"), F.col("_params.scale"))
    return df.withColumn("_params", parameters(params)).withColumn(out or features, cells).drop("_params")


def as_vector(df: DataFrame, features: str = "features", out: str = "vector") -> DataFrame:
    """The array as a Spark ML vector; missing cells count as 0."""
    cells = F.transform(F.col(features).cast("array<double>"), lambda x: F.coalesce(nan_to_null(x), F.lit(0.0)))
    return df.withColumn(out, array_to_vector(cells))


@dataclass
class Components:
    """A fitted projection: scaler parameters, the PCA model and how many components to keep."""

    params: DataFrame
    model: PCAModel
    keep: int

    @property
    def names(self) -> list[str]:
        return [f"pca_{i}" for i in range(self.keep)]

    @property
    def variance_ratio(self) -> list[float]:
        return [float(v) for v in self.model.explainedVariance][: self.keep]

    def transform(self, df: DataFrame, features: str = "features", out: str = "components") -> DataFrame:
        ready = as_vector(apply_scaler(df, self.params, features, "_scaled"), "_scaled", "_vector")
        projected = self.model.transform(ready)
        return projected.withColumn(out, F.slice(vector_to_array("_pca"), 1, self.keep)).drop(
            "_scaled", "_vector", "_pca"
        )


def fit_components(train: DataFrame, components: int | float, features: str = "features") -> Components:
    """Standardise (population deviation), then fit principal components on the training rows.

    A whole number is the number of components; a fraction keeps the fewest
    whose variance share exceeds it. The covariance matrix (features squared)
    is the only thing that reaches the driver.
    """
    params = stored(fit_standard(require_rows(train), features))
    ready = as_vector(apply_scaler(train, params, features, "_scaled"), "_scaled", "_vector").select("_vector")
    width = params.count()
    wanted = width if isinstance(components, float) else min(int(components), width)
    model = PCA(k=wanted, inputCol="_vector", outputCol="_pca").fit(ready)
    keep = wanted
    if isinstance(components, float):
        total, keep = 0.0, 0
        for share in model.explainedVariance:
            total, keep = total + float(share), keep + 1
            if total > components:
                break
    return Components(params, model, keep)
