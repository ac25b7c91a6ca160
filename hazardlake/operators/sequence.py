"""Operators over rows in time order: lags, rolling statistics, gap filling, runs, splits."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from hazardlake.functions.arrays import all_missing, nulls_for_nans
from hazardlake.functions.scalars import finite_or_limit
from hazardlake.session import stored

from .ordering import (
    BUCKET,
    HOME,
    ROWS_PER_BUCKET,
    Order,
    add_row_index,
    attach,
    flag_first,
    over_preceding,
    with_neighbours,
)
from .trailing import with_trailing

ROW = "_row"
ROLLING_STATS = ("mean", "std", "min", "max")


# Fixed formats: names of derived features.
def lag_names(lags: Sequence[int], n: int) -> list[str]:
    return [f"feat{i}_lag{lag}" for lag in lags for i in range(n)]


def rolling_names(windows: Sequence[int], n: int, stats: Sequence[str] = ("mean", "std")) -> list[str]:
    return [f"feat{i}_roll{w}_{s}" for w in windows for s in stats for i in range(n)]


def array_width(df: DataFrame, features: str = "features") -> int:
    """Number of cells in the feature array (0 for an empty table).

    Reads one row, so give it a stored table rather than a long plan.
    """
    first = df.select(F.size(features).alias("w")).head()
    return int(first["w"]) if first else 0


def feature_count(df: DataFrame, features: str, wanted: int) -> int:
    """The first ``wanted`` features, 0 for all, and never more than there are."""
    width = array_width(df, features)
    return min(wanted or width, width)


def _first_features(features: str, n: int) -> Column:
    return nulls_for_nans(F.slice(F.col(features), 1, n))


@dataclass(frozen=True)
class Lags:
    """Lagged cells of the first ``n`` features, lag by lag."""

    features: str
    n: int
    sizes: Sequence[int]
    fill: float | None = 0.0

    def __post_init__(self):
        if any(lag <= 0 for lag in self.sizes):
            raise ValueError(f"lags must be positive, got {list(self.sizes)}")

    @property
    def reach(self) -> int:
        return max(self.sizes, default=0)

    def frames(self, w: WindowSpec) -> dict[str, Column]:
        cells = _first_features(self.features, self.n)
        return {f"_lag{lag}": F.lag(cells, lag).over(w) for lag in self.sizes} if self.n else {}

    def cells(self) -> Column:
        if not self.n or not self.sizes:
            return F.array().cast("array<float>")
        empty = F.array_repeat(F.lit(None).cast("float"), self.n)
        cells = F.concat(*[F.coalesce(F.col(f"_lag{lag}"), empty) for lag in self.sizes])
        if self.fill is None:
            return cells
        return F.transform(cells, lambda x: finite_or_limit(x, self.fill).cast("float"))


@dataclass(frozen=True)
class Rolling:
    """Trailing statistics of the first ``n`` features: window by window, statistic by statistic.

    With the default ``gap=1`` the window of ``w`` rows ends two rows back: the
    current row *and the one before it* are left out. ``gap=0`` leaves out the
    current row only. A row with index below ``w`` gets 0. ``mean`` and ``std``
    (population) need ``w`` present cells; ``min`` and ``max`` skip missing ones.

    ``layout="blocks"`` computes them in :mod:`.trailing`, at a cost and in a memory
    that do not depend on the windows' lengths beyond the rows copied between
    buckets. ``"nested"`` holds the frame's rows beside every row and uses array
    expressions; ``"scalar"`` uses native window functions on scalar columns,
    whose plan grows with every feature.
    """

    features: str
    index: str
    n: int
    windows: Sequence[int]
    stats: Sequence[str] = ("mean", "std")
    gap: int = 1
    layout: str = "blocks"

    def __post_init__(self):
        if any(w <= 0 for w in self.windows):
            raise ValueError(f"windows must be positive, got {list(self.windows)}")
        if self.layout not in ("blocks", "scalar", "nested"):
            raise ValueError(f"unknown layout: {self.layout!r}")

    @property
    def reach(self) -> int:
        return max(self.windows, default=0) + self.gap

    @property
    def nested(self) -> bool:
        return self.layout == "nested"

    @property
    def in_blocks(self) -> bool:
        return bool(self.layout == "blocks" and self.n and self.windows and self.stats)

    def grow(self, framed: DataFrame) -> DataFrame:
        """Rows of buckets with their statistics, where blocks compute them; others get theirs from frames."""
        if not self.in_blocks:
            return framed
        return with_trailing(framed, BUCKET, HOME, self.index, self.features, self.n, self.windows, self.stats, self.gap, "_trailing")

    def frames(self, w: WindowSpec) -> dict[str, Column]:
        found: dict[str, Column] = {}
        if not self.n or self.layout == "blocks":
            return found
        for rows in self.windows:
            first, last = rows + self.gap, 1 + self.gap
            if self.nested:
                cells = F.collect_list(_first_features(self.features, self.n))
                found[f"_frame{rows}"] = cells.over(w.rowsBetween(-first, -last))
                continue
            for i in range(self.n):
                v = f"nanvl(CAST(`{self.features}`[{i}] AS DOUBLE), NULL)"
                if {"mean", "std"} & set(self.stats):
                    found[f"_count{rows}_{i}"] = over_preceding(f"count({v})", self.index, first, last)
                for stat in self.stats:
                    call = f"{_WINDOW_STATS[stat]}({v})"
                    found[f"_{stat}{rows}_{i}"] = over_preceding(call, self.index, first, last)
        return found

    def cells(self) -> Column:
        if not self.n or not self.windows or not self.stats:
            return F.array().cast("array<double>")
        if self.in_blocks:
            return F.col("_trailing")
        build = self._from_frame if self.nested else self._from_columns
        return F.concat(*[build(rows, stat) for rows in self.windows for stat in self.stats])

    def _from_columns(self, rows: int, stat: str) -> Column:
        cells = []
        for i in range(self.n):
            whole = f"_count{rows}_{i} = {rows}" if stat in ("mean", "std") else f"`{self.index}` >= {rows}"
            cells.append(f"CASE WHEN {whole} THEN _{stat}{rows}_{i} END")
        return F.transform(F.expr(f"array({', '.join(cells)})"), lambda x: finite_or_limit(x))

    def _from_frame(self, rows: int, stat: str) -> Column:
        frame = F.col(f"_frame{rows}")

        def one(i: Column) -> Column:
            present = F.array_compact(F.transform(frame, lambda r: F.get(r, i).cast("double")))
            if stat == "min":
                return F.when(F.col(self.index) >= rows, F.array_min(present))
            if stat == "max":
                return F.when(F.col(self.index) >= rows, F.array_max(present))
            mean = F.aggregate(present, F.lit(0.0), lambda a, x: a + x) / F.lit(float(rows))
            if stat == "mean":
                return F.when(F.size(present) == rows, mean)
            # Two passes over the frame: no cancellation when the mean is large.
            spread = F.aggregate(present, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean)) / F.lit(float(rows))
            return F.when(F.size(present) == rows, F.sqrt(spread))

        raw = F.transform(F.sequence(F.lit(0), F.lit(self.n - 1)), one)
        return F.transform(raw, lambda x: finite_or_limit(x))


# The SQL aggregate of each statistic.
_WINDOW_STATS = {"mean": "avg", "std": "stddev_pop", "min": "min", "max": "max"}


def lag_features(
    df: DataFrame,
    order_by: Order,
    lags: Sequence[int] = (1, 3, 6),
    n_features: int = 50,
    features: str = "features",
    out: str = "lags",
    fill: float | None = 0.0,
    key: Sequence[str] | None = None,
    bucket_rows: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Add an array of lagged cells for the first ``n_features`` (0 = all).

    Rows without that much history hold ``fill`` (None leaves them missing).
    With a unique ``key`` only the order, the key and those features are
    ranked and windowed, and the result is joined back to the wide rows.
    """
    indexed = add_row_index(_needed(df, order_by, features, n_features, key), order_by, ROW)
    spec = Lags(features, feature_count(indexed, features, n_features), lags, fill)
    table = with_neighbours(indexed, ROW, spec.reach, 0, spec.frames, lambda: {out: spec.cells()}, bucket_rows)
    return attach(df, table.select(*key, out), key) if key else table.drop(ROW)


def rolling_features(
    df: DataFrame,
    order_by: Order,
    windows: Sequence[int] = (3, 6, 12),
    n_features: int = 50,
    stats: Sequence[str] = ("mean", "std"),
    features: str = "features",
    out: str = "rolls",
    gap: int = 1,
    layout: str = "blocks",
    key: Sequence[str] | None = None,
    bucket_rows: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Add an array of trailing statistics; :class:`Rolling` says what they are.

    ``key`` works as in :func:`lag_features`.
    """
    known = [s for s in stats if s in ROLLING_STATS]
    indexed = add_row_index(_needed(df, order_by, features, n_features, key), order_by, ROW)
    spec = Rolling(features, ROW, feature_count(indexed, features, n_features), windows, known, gap, layout)
    table = with_neighbours(indexed, ROW, spec.reach, 0, spec.frames, lambda: {out: spec.cells()}, bucket_rows, grow=spec.grow)
    return attach(df, table.select(*key, out), key) if key else table.drop(ROW)


def _needed(df: DataFrame, order_by: Order, features: str, n: int, key: Sequence[str] | None) -> DataFrame:
    """What the window needs of a row, if the row can be found again by its key."""
    if not key:
        return df
    cells = F.slice(features, 1, n) if n else F.col(features)
    return df.select(*[c for c in _names(order_by, *key) if c != features], cells.alias(features))


def interpolate_missing_rows(
    df: DataFrame,
    order_by: Sequence[str],
    features: str = "features",
    check: Sequence[int] | None = None,
    flag: str | None = None,
    bucket_rows: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Fill rows whose (checked) cells are all missing from the rows around them.

    First row: the next one; last row: the one before; otherwise the mean of
    both, which stays missing where either is missing. A lone row becomes 0.
    ``check`` limits the test to some positions; ``flag`` adds a column that
    tells which rows were filled. The order must be total.

    Only sort keys are ranked. They tell each missing row its neighbours' keys,
    so the wide rows that move are those next to a missing one.
    """
    keys = list(order_by)
    cells = nulls_for_nans(features)
    tested = cells if check is None else F.array(*[F.get(cells, F.lit(i)) for i in check])
    indexed = add_row_index(df.select(*keys, all_missing(tested).alias("_down")), keys, ROW)
    me = F.struct(*keys)
    gaps = with_neighbours(
        indexed,
        ROW,
        1,
        1,
        lambda w: {"_before": F.lag(me).over(w), "_after": F.lead(me).over(w)},
        lambda: {},
        bucket_rows,
        keep=("_before", "_after"),
    ).filter("_down")
    gaps = stored(gaps.select(*keys, "_before", "_after"))
    wanted = gaps.select(F.explode(F.array_compact(F.array("_before", "_after"))).alias("_key")).distinct()
    near = df.select(me.alias("_key"), cells.alias("_cells")).join(wanted, "_key", "left_semi")
    near = stored(near)
    before = near.select(F.col("_key").alias("_before"), F.col("_cells").alias("_b"))
    after = near.select(F.col("_key").alias("_after"), F.col("_cells").alias("_a"))
    found = gaps.join(before, "_before", "left").join(after, "_after", "left")
    mean = F.zip_with("_b", "_a", lambda a, b: ((a + b) / F.lit(2.0)).cast("float"))
    # At the table's edges there is no neighbour on one side.
    fills = found.select(*keys, F.lit(True).alias("_gap"), F.coalesce(mean, "_a", "_b").alias("_fill"))

    right = fills.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_gap", "_fill")
    on = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    lone = F.transform(cells, lambda _: F.lit(0.0).cast("float"))
    joined = df.join(right, on, "left")
    value = F.when(F.col("_gap"), F.coalesce("_fill", lone)).otherwise(cells)
    columns = [value.alias(c) if c == features else F.col(c) for c in df.columns]
    return joined.select(*columns, *([F.coalesce("_gap", F.lit(False)).alias(flag)] if flag else []))


def downtime_periods(df: DataFrame, order_by: Order, time: str, features: str = "features") -> DataFrame:
    """Maximal runs of rows whose cells are all missing: start, end and length.

    In a run the difference between a row's place in the table and its place
    among the missing rows is constant, which makes it the run's key.
    """
    indexed = add_row_index(df.select(*_names(order_by, time), all_missing(features).alias("_down")), order_by, "_idx")
    down = add_row_index(indexed.filter("_down"), ["_idx"], "_nth")
    return (
        down.groupBy((F.col("_idx") - F.col("_nth")).alias("_run"))
        .agg(
            F.min(time).alias("period_start"),
            F.max(time).alias("period_end"),
            F.count(F.lit(1)).alias("n_rows"),
        )
        .drop("_run")
    )


def train_rows(n: int, test_size: float) -> int:
    """Rows that go to the training side; the float product is cut, not rounded."""
    return int(n * (1.0 - test_size))


def chronological_split(
    df: DataFrame, order_by: Order, test_size: float = 0.2, name: str = "is_train"
) -> DataFrame:
    """Mark the earliest rows as training rows, the rest as validation rows."""
    return flag_first(df, order_by, train_rows(df.count(), test_size), name)


def every_nth_row(df: DataFrame, order_by: Order, n: int) -> DataFrame:
    """Rows 0, n, 2n, ... of the order, which must be total: rows are found again by it."""
    keys = _names(order_by)
    picked = add_row_index(df.select(*keys), order_by, "_idx").filter(F.col("_idx") % n == 0)
    return attach(df, picked.select(*keys), keys)


def first_rows(df: DataFrame, order_by: Order, n: int) -> DataFrame:
    """The first ``n`` rows of the order, however many that is."""
    return flag_first(df, order_by, n, "_keep").filter("_keep").drop("_keep")


def _names(order_by: Order, *more: str) -> list[str]:
    names = [c for c in order_by if isinstance(c, str)]
    return list(dict.fromkeys([*names, *more]))

