"""Statistics per feature position without a row per cell.

Every task folds its rows into vectors (count, mean, squared deviations, least,
largest, missing and infinite cells), so what is shuffled is one row per task
and position, at any number of rows. Means and deviations are merged around the
common mean, never as differences of large sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from hazardlake.session import stored

SCHEMA = (
    "feature_idx int, n long, mean double, squares double, low double, high double, rows long, missing long, infinite long"
)


def partial_moments(df: DataFrame, features: str = "features", missing_as_zero: bool = False) -> DataFrame:
    """One row per task and position; merge with :func:`merged_moments`.

    Missing cells (null or NaN) are left out, or count as 0 where asked. A row
    with fewer cells than others has nothing at the further positions.
    """

    # Uses nothing of this module, so that executors need not have the package installed.
    def merge(total: dict[str, np.ndarray], new: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        size = max(len(new["n"]), len(total["n"]))
        for name, fill in (("n", 0), ("mean", 0.0), ("squares", 0.0), ("low", np.inf), ("high", -np.inf), ("rows", 0), ("missing", 0), ("infinite", 0)):
            for side in (total, new):
                side[name] = np.concatenate([side[name], np.full(size - len(side[name]), fill, dtype=side[name].dtype)])
        both = total["n"] + new["n"]
        with np.errstate(invalid="ignore"):
            gap = new["mean"] - total["mean"]
            share = new["n"] / np.maximum(both, 1)
            squares = total["squares"] + new["squares"] + gap * gap * total["n"] * share
            mean = total["mean"] + gap * share
        out = {"n": both, "mean": mean, "squares": squares, "low": np.minimum(total["low"], new["low"]), "high": np.maximum(total["high"], new["high"])}
        return out | {name: total[name] + new[name] for name in ("rows", "missing", "infinite")}

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            column = batch.column(0)
            column = column.filter(column.is_valid())
            if not len(column):
                continue
            lengths = column.value_lengths().to_numpy(zero_copy_only=False)
            flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
            width = int(lengths.max())
            if not width:
                continue
            if int(lengths.min()) == width and np.isfinite(flat).all():  # the plain case: nothing missing, nothing infinite
                x = flat.reshape(len(lengths), width)
                mean = x.mean(axis=0)
                every, none = np.full(width, len(x)), np.zeros(width, dtype=np.int64)
                squares = np.square(x - mean).sum(axis=0)
                new = dict(n=every, mean=mean, squares=squares, low=x.min(axis=0), high=x.max(axis=0), rows=every, missing=none, infinite=none)
                total = merge(total, new) if total else new
                continue
            there = np.arange(width) < lengths[:, None]
            x = np.full(there.shape, np.nan)
            x[there] = flat
            absent = there & np.isnan(x)
            infinite = there & np.isinf(x)
            if missing_as_zero:
                x[absent] = 0.0
            known = ~np.isnan(x)
            n = known.sum(axis=0)
            with np.errstate(invalid="ignore", divide="ignore"):
                mean = np.where(known, x, 0.0).sum(axis=0) / np.maximum(n, 1)
                squares = (np.where(known, x - mean, 0.0) ** 2).sum(axis=0)
            new = {
                "n": n,
                "mean": mean,
                "squares": squares,
                "low": np.where(known, x, np.inf).min(axis=0),
                "high": np.where(known, x, -np.inf).max(axis=0),
                "rows": there.sum(axis=0),
                "missing": absent.sum(axis=0),
                "infinite": infinite.sum(axis=0),
            }
            total = merge(total, new) if total else new
        if total:
            some = total["n"] > 0
            yield pa.record_batch(
                {
                    "feature_idx": pa.array(np.arange(len(some)).astype(np.int32)),
                    "n": pa.array(total["n"].astype(np.int64)),
                    "mean": pa.array(total["mean"]),
                    "squares": pa.array(total["squares"]),
                    "low": pa.array(total["low"], mask=~some),
                    "high": pa.array(total["high"], mask=~some),
                    **{c: pa.array(total[c].astype(np.int64)) for c in ("rows", "missing", "infinite")},
                }
            )

    return df.select(F.col(features).cast("array<double>")).mapInArrow(fold, SCHEMA)


def merged_moments(partial: DataFrame) -> DataFrame:
    """``feature_idx, n, mean, squares, low, high, rows, missing, infinite``, one row per position.

    The partial rows are stored: they are read once for the means and once for
    the deviations around them.
    """
    partial = stored(partial, "moments")
    mean = F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum("n"))
    whole = partial.groupBy("feature_idx").agg(
        F.sum("n").alias("n"),
        mean.alias("mean"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        *[F.sum(c).alias(c) for c in ("rows", "missing", "infinite")],
    )
    around = F.col("squares") + F.col("n") * (F.col("mean") - F.col("_mean")) * (F.col("mean") - F.col("_mean"))
    spread = (
        partial.join(whole.select("feature_idx", F.col("mean").alias("_mean")), "feature_idx")
        .groupBy("feature_idx")
        .agg(F.sum(F.when(F.col("n") > 0, around)).alias("squares"))
    )
    return whole.join(spread, "feature_idx")


def feature_moments(df: DataFrame, features: str = "features", missing_as_zero: bool = False) -> DataFrame:
    return merged_moments(partial_moments(df, features, missing_as_zero))


#: Points of a quantile summary, and cells between the bounds that a task sends as they are.
POINTS = 128
EXACT = 2048
_SUMMARY = "feature_idx int, task int, below long, n long, points array<double>, most array<long>, least array<long>"


def exact_medians(df: DataFrame, features: str = "features", points: int = POINTS, exact: int = EXACT) -> DataFrame:
    """``feature_idx, fill``: the median of the present cells per position, 0 where there is none.

    The first pass summarises the cells of every task and position: some of
    their values, each with the number of cells that lie below it at most and
    up to it at least. Summaries merge without losing these bounds, so that the
    merged one names two values between which the middle lies for certain. The
    next pass counts the cells below them exactly and summarises only those
    between; as few as ``exact`` cells of a task are sent as they are, and then
    the middle is known. Two passes settle tasks of up to about ``exact *
    points / 4`` rows, a third one far more; many equal cells settle sooner.
    One row per task and position is shuffled, 256 of them are merged at a time,
    and the driver gets two numbers per position and side of the middle.
    """
    cells = stored(df.select(F.col(features).alias("x")), "cells")
    kind = cells.schema["x"].dataType.elementType.simpleString()
    column = F.col("x") if kind == "float" else F.col("x").cast("array<double>")
    bounds: dict[int, tuple[float, float]] = {}  # position -> least and largest possible middle cell
    ranks: dict[int, tuple[int, int]] = {}  # position -> ranks of the lower and upper middle
    fills: dict[int, float] = {}
    while True:
        told = cells.select(column).mapInArrow(_summarise(bounds, points, exact), _SUMMARY)
        block = F.floor(F.col("feature_idx") / 16)
        tasks = cells.rdd.getNumPartitions()
        while tasks > 1:  # 256 tasks at a time, then 256 of their sums
            told = told.groupBy(block.alias("block"), F.floor(F.col("task") / 256).alias("some")).applyInArrow(_merge(4 * (exact if bounds else points)), _SUMMARY)
            tasks = -(-tasks // 256)
        found = told.groupBy(block.alias("block")).applyInArrow(_bound(ranks), "feature_idx int, side int, low double, high double, n long")
        open_: dict[int, list[float]] = {}
        totals: dict[int, int] = {}
        middle: dict[int, dict[int, float]] = {}
        for r in found.collect():
            i = r["feature_idx"]
            totals[i] = r["n"]
            if not r["n"]:
                fills[i] = 0.0
                continue
            open_.setdefault(i, []).extend([r["low"], r["high"]])
            if r["low"] == r["high"]:
                middle.setdefault(i, {})[r["side"]] = r["low"]
        for i, sides in middle.items():
            if len(sides) == 2:
                fills[i] = (sides[0] + sides[1]) / 2
                del open_[i]
        if not open_:
            return df.sparkSession.createDataFrame(sorted(fills.items()), "feature_idx int, fill double")
        if not bounds:
            ranks = {i: ((n - 1) // 2, n // 2) for i, n in totals.items()}
        bounds = {i: (min(v), max(v)) for i, v in open_.items()}


# The three functions below use nothing of this module inside tasks, so that executors need not have the package installed.


def _summarise(bounds: dict[int, tuple[float, float]], points: int, exact: int):
    """A function that summarises a task's cells per position; with bounds, only those between them, and counts those below."""
    wanted = np.array(sorted(bounds), dtype=np.int64)
    low, high = (np.array([bounds[i][s] for i in wanted.tolist()]) for s in (0, 1))
    combine, thin = _combiner(), _thinner()

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        keep = exact if bounds else points
        below: dict[int, int] = {}
        held: dict[int, list] = {}
        for batch in batches:
            column = batch.column(0)
            column = column.filter(column.is_valid())
            if not len(column):
                continue
            lengths = column.value_lengths().to_numpy(zero_copy_only=False)
            width = int(lengths.max())
            if not width:
                continue
            flat = column.flatten().to_numpy(zero_copy_only=False)
            if int(lengths.min()) == width:
                x = flat.reshape(len(lengths), width)
            else:
                x = np.full((len(lengths), width), np.nan, dtype=flat.dtype)
                x[np.arange(width) < lengths[:, None]] = flat
            at = wanted[wanted < width] if bounds else np.arange(width)
            if not len(at):
                continue
            x = x[:, at].T + 0  # minus zero is zero
            if bounds:
                under = x < low[: len(at), None]
                for i, n in zip(at.tolist(), under.sum(axis=1).tolist()):
                    below[i] = below.get(i, 0) + n
                x = np.where(under | (x > high[: len(at), None]), np.nan, x)
            x = np.sort(x, axis=1)  # missing cells come last
            known = (~np.isnan(x)).sum(axis=1)
            for i, n, values in zip(at.tolist(), known.tolist(), x):
                own = held.setdefault(i, [])
                if n:
                    start = np.flatnonzero(np.concatenate([[True], values[1:n] != values[: n - 1]]))
                    own.append(thin(n, values[start].astype(np.float64), start, np.append(start[1:], n), keep))
                if len(own) > 16:
                    held[i] = [combine(own, keep)]
        rows = [(i, below.get(i, 0), *combine(own, keep)) for i, own in sorted(held.items())]
        if rows:
            yield pa.record_batch(
                {
                    "feature_idx": pa.array([r[0] for r in rows], pa.int32()),
                    "task": pa.array([TaskContext.get().partitionId()] * len(rows), pa.int32()),
                    "below": pa.array([r[1] for r in rows], pa.int64()),
                    "n": pa.array([r[2] for r in rows], pa.int64()),
                    "points": pa.array([r[3] for r in rows], pa.list_(pa.float64())),
                    "most": pa.array([r[4] for r in rows], pa.list_(pa.int64())),
                    "least": pa.array([r[5] for r in rows], pa.list_(pa.int64())),
                }
            )

    return fold


def _thinner():
    """A function that leaves at most ``keep`` points of a summary: half of them even in rank, half even among the distinct values, so that
    neither many cells nor many equal cells can hide the rest."""

    def thin(n: int, points: np.ndarray, most: np.ndarray, least: np.ndarray, keep: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
        if len(points) > keep:
            by_rank = np.searchsorted(least, np.linspace(0, n, keep // 2))
            by_value = np.linspace(0, len(points) - 1, keep // 2).astype(np.int64)
            some = np.unique(np.clip(np.concatenate([by_rank, by_value]), 0, len(points) - 1))
            points, most, least = points[some], most[some], least[some]
        return n, points, most, least

    return thin


def _combiner():
    """A function that merges summaries ``(cells, points, most below, least up to)`` and leaves at most ``keep`` points."""
    thin = _thinner()

    def combine(parts: list, keep: int | None = None) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
        n = sum(p[0] for p in parts)
        every = np.unique(np.concatenate([np.zeros(0), *[p[1] for p in parts]]))
        most, least = np.zeros(len(every), dtype=np.int64), np.zeros(len(every), dtype=np.int64)
        for cells, points, under, upto in parts:
            # fewer cells lie below a value than below the next point; at least as many lie up to it as up to the last point
            most += np.append(under, cells)[np.searchsorted(points, every, "left")]
            least += np.concatenate([[0], upto])[np.searchsorted(points, every, "right")]
        return thin(n, every, most, least, keep) if keep else (n, every, most, least)

    return combine


def _reader():
    """A function that reads summaries: per position the cells below, and the parts to merge."""

    def parts(table: pa.Table) -> dict[int, list]:
        out: dict[int, list] = {}
        index, below, n = (table.column(c).to_pylist() for c in ("feature_idx", "below", "n"))
        lists = [table.column(c) for c in ("points", "most", "least")]
        for r, i in enumerate(index):
            own = out.setdefault(i, [0, []])
            own[0] += below[r]
            own[1].append((n[r], *[c[r].values.to_numpy(zero_copy_only=False) for c in lists]))
        return out

    return parts


def _merge(keep: int):
    """A function that merges the summaries of some tasks, one row per position."""
    combine = _combiner()
    parts = _reader()

    def merge(table: pa.Table) -> pa.Table:
        rows = [(i, below, *combine(own, keep)) for i, (below, own) in parts(table).items()]
        columns = list(zip(*rows))
        return pa.table(
            {
                "feature_idx": pa.array(columns[0], pa.int32()),
                "task": pa.array([table.column("task")[0].as_py() // 256] * len(rows), pa.int32()),
                "below": pa.array(columns[1], pa.int64()),
                "n": pa.array(columns[2], pa.int64()),
                "points": pa.array(columns[3], pa.list_(pa.float64())),
                "most": pa.array(columns[4], pa.list_(pa.int64())),
                "least": pa.array(columns[5], pa.list_(pa.int64())),
            }
        )

    return merge


def _bound(ranks: dict[int, tuple[int, int]]):
    """A function that bounds both middle cells of each position by values of the merged summaries."""
    combine = _combiner()
    parts = _reader()

    def bound(table: pa.Table) -> pa.Table:
        out = []
        for i, (below, own) in parts(table).items():
            n, points, most, least = combine(own)
            if not n:
                out += [(i, side, 0.0, 0.0, 0) for side in (0, 1)]
                continue
            for side, rank in enumerate(ranks.get(i, ((n - 1) // 2, n // 2))):
                left = rank - below
                low = points[np.searchsorted(most, left, "right") - 1]
                high = points[np.searchsorted(least, left + 1, "left")]
                out.append((i, side, float(low), float(high), n))
        columns = list(zip(*out))
        kinds = (pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int64())
        return pa.table({c: pa.array(v, k) for c, v, k in zip(("feature_idx", "side", "low", "high", "n"), columns, kinds)})

    return bound

