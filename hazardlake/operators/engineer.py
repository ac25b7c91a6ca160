"""Feature engineering and preprocessing, composed from the operators."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlake.functions.scalars import CALENDAR_NAMES, calendar_columns
from hazardlake.session import stored

from . import sampling, scaling, sequence
from .ordering import ROWS_PER_BUCKET, Order, add_row_index, attach, with_neighbours


@dataclass(frozen=True)
class Features:
    """Which derived features to add."""

    calendar: bool = True
    lags: Sequence[int] = (1, 3, 6)
    windows: Sequence[int] = (3, 6, 12)
    n_features: int = 50
    stats: Sequence[str] = ("mean", "std")
    keep_original: bool = True
    gap: int = 1

    def names(self, width: int) -> list[str]:
        """Names in array order: originals, calendar, lags, rolling."""
        n = min(self.n_features or width, width)
        names = [f"v_{i}" for i in range(width)] if self.keep_original else []
        names += list(CALENDAR_NAMES) if self.calendar else []
        return names + sequence.lag_names(self.lags, n) + sequence.rolling_names(self.windows, n, self.stats)


def engineer(
    df: DataFrame,
    spec: Features,
    order_by: Order,
    time: str | None = "batch_time",
    features: str = "features",
    out: str = "engineered",
    key: Sequence[str] | None = None,
    bucket_rows: int = ROWS_PER_BUCKET,
) -> tuple[DataFrame, list[str]]:
    """Add the engineered feature array; returns the table and the names of its cells.

    Lags and rolling statistics look back only and are computed over the whole
    ordered table, in one pass over one row index, so validation rows see the
    history that precedes them. With a unique ``key`` only the features that
    have lags or statistics are ranked and windowed; the wide rows are joined
    by key once and neither sorted nor stored.
    """
    if time is None or not spec.calendar:
        spec = Features(**{**spec.__dict__, "calendar": False})
    row = sequence.ROW
    needed = df.withColumn("_width", F.size(features))
    if key:
        cells = F.slice(features, 1, spec.n_features) if spec.n_features else F.col(features)
        needed = needed.select(*dict.fromkeys([*order_by, *key]), "_width", cells.alias(features))
    indexed = add_row_index(needed, order_by, row)
    first = indexed.select("_width").head()
    width = int(first["_width"]) if first else 0
    n = min(spec.n_features or width, width)
    lags = sequence.Lags(features, n, spec.lags)
    rolls = sequence.Rolling(features, row, n, spec.windows, spec.stats, spec.gap)
    table = with_neighbours(
        indexed,
        row,
        max(lags.reach, rolls.reach),
        0,
        lambda w: {**lags.frames(w), **rolls.frames(w)},
        lambda: {"_lags": lags.cells(), "_rolls": rolls.cells()},
        bucket_rows,
        grow=rolls.grow,
    )
    table = attach(df, table.select(*key, "_lags", "_rolls"), key) if key else table.drop("_width")
    parts = [F.col(features).cast("array<double>")] if spec.keep_original else []
    if spec.calendar:
        parts.append(F.array(*calendar_columns(time)))
    parts += [F.col("_lags").cast("array<double>"), F.col("_rolls")]
    return table.withColumn(out, F.concat(*parts)).drop("_lags", "_rolls", row), spec.names(width)


@dataclass
class Prepared:
    train: DataFrame
    validation: DataFrame
    params: DataFrame | None
    names: list[str]
    components: scaling.Components | None = None


def prepare(
    df: DataFrame,
    spec: Features,
    key: str,
    label: str,
    order_by: Order,
    time: str = "batch_time",
    test_size: float = 0.2,
    split: str = "chronological",
    scaler: str = "standard",
    components: int | float | None = None,
    smote_ratio: float | None = None,
    seed: int = 42,
) -> Prepared:
    """Features, split, scaler and (training rows only) rebalancing, which adds rows and removes none.

    The engineered table is written once to the shared folder; the scaler and
    the components are fitted on its training rows.
    """
    # The split needs the order alone, so it is made before the features are.
    if split == "chronological":
        marked = sequence.chronological_split(df, order_by, test_size)
    elif split == "random":
        marked = sampling.random_split(df, [key], test_size, seed)
    else:
        raise ValueError(f"unknown split: {split!r}")
    table, names = engineer(stored(marked), spec, order_by, time, key=[key])
    table = table.drop("features").withColumnRenamed("engineered", "features")
    table = stored(table)
    train, validation = table.filter("is_train").drop("is_train"), table.filter("NOT is_train").drop("is_train")
    fitted = None
    if components is not None:
        fitted = scaling.fit_components(train, components)
        train, validation = (
            fitted.transform(t).drop("features").withColumnRenamed("components", "features") for t in (train, validation)
        )
        names = fitted.names
    params = scaling.fit_scaler(scaling.require_rows(train), scaler)
    if params is not None:
        params = stored(params)
    train, validation = (scaling.apply_scaler(t, params) for t in (train, validation))
    train = train.withColumn("features", F.col("features").cast("array<double>"))
    if smote_ratio is not None:
        extra = sampling.smote(train, key, label, ratio=smote_ratio, seed=seed, strict=False)
        train = sampling.concat_rows(train.select(label, "features"), extra.select(label, "features"))
    return Prepared(train, validation, params, names, fitted)
