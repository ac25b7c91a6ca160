"""Scalar expressions: casts, time parts, cyclic encodings, hash draws."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names and order of the calendar block, and the month of each season.
CALENDAR_NAMES = (
    "hour_sin",
    "hour_cos",
    "dayofweek_sin",
    "dayofweek_cos",
    "month_sin",
    "month_cos",
    "season_winter",
    "season_spring",
    "season_summer",
    "season_autumn",
)
SEASON_MONTHS = {
    "winter": (12, 1, 2),
    "spring": (3, 4, 5),
    "summer": (6, 7, 8),
    "autumn": (9, 10, 11),
}

# Texts read as a flag.
TRUE_TEXTS = ("true", "1", "1.0")
FALSE_TEXTS = ("false", "0", "0.0")

# Sums over arrays up to this width are written out term by term.
UNROLLED_WIDTH = 100

# Fixed value: largest finite 32-bit float, which stands in for an infinity.
FLOAT32_MAX = 3.4028234663852886e38


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- casts ------------------------------------------------------------------


def parse_time(c: Column | str) -> Column:
    """Text or timestamp to zone-free timestamp; unreadable text is null."""
    return col(c).try_cast("timestamp_ntz")


def flag_to_float(c: Column | str) -> Column:
    """Bool, number or text flag to 0.0/1.0; other numbers keep their value."""
    text = F.lower(F.trim(col(c).cast("string")))
    return (
        F.when(text.isin(*TRUE_TEXTS), F.lit(1.0))
        .when(text.isin(*FALSE_TEXTS), F.lit(0.0))
        .otherwise(text.try_cast("double"))
        .cast("float")
    )


def number_or_null(c: Column | str, nan_is_null: bool = True, dtype: str = "float") -> Column:
    """Non-strict numeric cast; a literal NaN counts as missing unless told otherwise."""
    value = col(c).try_cast(dtype)
    return nan_to_null(value) if nan_is_null else value


def number_or_zero(c: Column | str, nan_is_null: bool = True, dtype: str = "float") -> Column:
    return F.coalesce(number_or_null(c, nan_is_null, dtype), F.lit(0.0).cast(dtype))


# -- missing and infinite ---------------------------------------------------


def nan_to_null(c: Column) -> Column:
    return F.nanvl(c, F.lit(None))


def is_infinite(c: Column) -> Column:
    return F.coalesce(F.abs(c) == F.lit(float("inf")), F.lit(False))


def finite_or_limit(c: Column, missing: float = 0.0) -> Column:
    """Missing to ``missing``, +inf/-inf to the largest finite 32-bit float."""
    return (
        F.when(c.isNull() | F.isnan(c), F.lit(missing))
        .when(c == F.lit(float("inf")), F.lit(FLOAT32_MAX))
        .when(c == F.lit(float("-inf")), F.lit(-FLOAT32_MAX))
        .otherwise(c)
    )


# -- time -------------------------------------------------------------------


# Whole parts of the day that a floored time keeps.
FLOOR_UNITS = {"day": (), "hour": (F.hour,), "minute": (F.hour, F.minute), "second": (F.hour, F.minute, F.second)}


def floor_time(unit: str, c: Column | str) -> Column:
    """Zone-free timestamp cut to its day, hour, minute or second.

    Built from the day and the parts of its time, so a session zone with
    daylight saving, in which some wall clock times do not exist, changes nothing.
    """
    time = col(c).cast("timestamp_ntz")
    parts = [part(time) for part in FLOOR_UNITS[unit]]
    return time.cast("date").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), *parts)


def shift_hours(c: Column | str, hours: int) -> Column:
    return col(c) + F.expr(f"interval {int(hours)} hours")


def time_text(c: Column | str) -> Column:
    """One spelling per second; fractions are dropped, bad text is null."""
    return F.substring(parse_time(c).cast("string"), 1, 19)


def micros(c: Column | str) -> Column:
    """Zone-free timestamp as whole microseconds since 1970."""
    time = col(c).cast("timestamp_ntz")
    days = F.date_diff(time.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    minutes = (days * 24 + F.hour(time)) * 60 + F.minute(time)
    seconds = F.date_part(F.lit("SECONDS"), time).cast("decimal(20,6)") * 1_000_000
    return minutes * 60_000_000 + seconds.cast("bigint")


def _cycle(value: Column, period: int) -> tuple[Column, Column]:
    angle = value * F.lit(2.0 * math.pi) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def calendar_columns(c: Column | str) -> list[Column]:
    """The ten calendar columns of a timestamp, in :data:`CALENDAR_NAMES` order."""
    ts = col(c)
    cyclic = [
        *_cycle(F.hour(ts), 24),
        *_cycle(F.dayofweek(ts) - 1, 7),
        *_cycle(F.month(ts), 12),
    ]
    seasons = [F.month(ts).isin(*months).cast("int").cast("double") for months in SEASON_MONTHS.values()]
    return [e.alias(n) for e, n in zip(cyclic + seasons, CALENDAR_NAMES, strict=True)]


# -- scores -----------------------------------------------------------------


def sigmoid(z: Column | str) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col(z)))


def at_least(p: Column | str, threshold: Column | float) -> Column:
    bound = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (col(p) >= bound).cast("int")


def linear_score(features: Column | str, weights: Sequence[float], bias: float = 0.0) -> Column:
    """``bias + sum(w_i * x_i)`` over an array column; null where the width differs.

    A short sum is written out, which compiles to plain arithmetic; a long one
    stays an array expression, so the plan does not grow with the width.
    """
    cells = col(features).cast("array<double>")
    if len(weights) <= UNROLLED_WIDTH:
        total = F.lit(float(bias))
        for i, w in enumerate(weights):
            total = total + F.get(cells, F.lit(i)) * F.lit(float(w))
        return F.when(F.size(cells) == len(weights), total)
    products = F.zip_with(cells, F.array(*[F.lit(float(w)) for w in weights]), lambda x, y: x * y)
    return F.aggregate(products, F.lit(float(bias)), lambda acc, x: acc + x)


# -- reproducible draws -----------------------------------------------------


def uniform_draw(seed: int | str, *key: Column | str) -> Column:
    """A number in [0, 1) fixed by the seed and the row's key.

    It does not depend on partitioning, task retries or row order, and any SQL
    engine with md5 gives the same value.
    """
    parts = [F.lit(str(seed)), *[col(k).cast("string") for k in key]]
    digest = F.md5(F.concat_ws(":", *parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
