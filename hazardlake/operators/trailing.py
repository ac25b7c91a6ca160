"""Trailing statistics of long windows at a cost that does not depend on the window.

Rows are cut into blocks as long as the window, at multiples of its length. A
window is then the end of one block and the beginning of the next, so one pass
forwards and one backwards over every block give all windows: running sums,
smallest and largest cells, and running means with their squared deviations,
which are merged without subtracting large squares from each other. Blocks
begin at the same rows however the rows are dealt to tasks, and so do not
change a digit of the result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from hazardlake.functions.scalars import FLOAT32_MAX

#: Cells worked on at once; bounds the arrays beside a bucket's rows and results.
CELLS_AT_ONCE = 2_000_000


def trailing_statistics(cells_at_once: int = CELLS_AT_ONCE) -> Callable[..., np.ndarray]:
    """A function ``(x, begin, w, stats) -> (statistic, row, feature)`` of the windows of ``w`` rows that end at each row.

    Row 0 of ``x`` has the index ``begin``. Missing cells are NaN; so is every row before the first. Mean and
    deviation are NaN unless all cells are there, smallest and largest unless one is.
    """

    # Uses nothing of this module, so that executors need not have the package installed.
    def before(x: np.ndarray, fill: float) -> np.ndarray:
        """Shift along the block: what holds for the rows before each row."""
        out = np.empty_like(x)
        out[:, 0], out[:, 1:] = fill, x[:, :-1]
        return out

    def deviations(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Running mean and squared deviations along the block, each row included."""
        mean, squares = np.empty_like(x), np.empty_like(x)
        m, s = np.zeros_like(x[:, 0]), np.zeros_like(x[:, 0])
        for j in range(x.shape[1]):
            gap = x[:, j] - m
            m = m + gap / (j + 1)
            s = s + gap * (x[:, j] - m)
            mean[:, j], squares[:, j] = m, s
        return mean, squares

    def part(x: np.ndarray, lead: int, w: int, stats: Sequence[str]) -> np.ndarray:
        rows, width = x.shape
        # a block in front for windows that begin before the first row, one behind for those that end at the last
        blocks = (lead + rows) // w + 2
        padded = np.full((blocks * w, width), np.nan)
        padded[w + lead : w + lead + rows] = x
        padded = padded.reshape(blocks, w, width)
        back = padded[:, ::-1]

        def windows(end: np.ndarray, begin: np.ndarray, join: Callable[..., np.ndarray], *more: np.ndarray) -> np.ndarray:
            """Join the rest of a block from each row with the rows before that place in the next block."""
            found = join(end[:-1], begin[1:], *more).reshape(-1, width)
            # the window that begins at row s ends at row s + w - 1
            return found[lead + 1 : lead + 1 + rows]

        out = np.empty((len(stats), rows, width))
        if "std" in stats:
            mean, squares = deviations(padded)
            late_mean, late_squares = (a[:, ::-1] for a in deviations(back))
            after = np.arange(w, dtype=np.float64)[:, None]  # rows the next block gives
            shift = windows(late_mean, before(mean, 0.0), lambda a, b: np.square(a - b) * (after * (w - after) / w))
            spread = windows(late_squares, before(squares, 0.0), np.add)
        for k, stat in enumerate(stats):
            if stat == "mean":
                late = np.cumsum(back, axis=1)[:, ::-1]
                out[k] = windows(late, before(np.cumsum(padded, axis=1), 0.0), np.add) / w
            elif stat == "std":
                out[k] = np.sqrt((spread + shift) / w)
            else:
                pick = np.fmin if stat == "min" else np.fmax
                late = pick.accumulate(back, axis=1)[:, ::-1]
                out[k] = windows(late, before(pick.accumulate(padded, axis=1), np.nan), pick)
        return out

    def run(x: np.ndarray, begin: int, w: int, stats: Sequence[str]) -> np.ndarray:
        rows, width = x.shape
        step = max(1, cells_at_once // max(1, rows + 2 * w))
        out = np.empty((len(stats), rows, width))
        with np.errstate(invalid="ignore", over="ignore"):
            for i in range(0, width, step):
                out[:, :, i : i + step] = part(x[:, i : i + step], begin % w, w, stats)
        return out

    return run


def with_trailing(
    df: DataFrame, bucket: str, home: str, index: str, features: str, n: int, windows: Sequence[int], stats: Sequence[str], gap: int, out: str
) -> DataFrame:
    """Rows of their home bucket with an array of the statistics, window by window and statistic by statistic.

    Every bucket has the rows of consecutive index before its own that the windows reach, which go.
    """
    statistics, limit = trailing_statistics(), FLOAT32_MAX
    schema = StructType([*df.schema.fields, StructField(out, ArrayType(DoubleType()))])

    # Uses nothing of this module, so that executors need not have the package installed.
    def matrix(column: pa.Array) -> np.ndarray:
        x = np.full((len(column), n), np.nan)
        size = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
        start, size = np.cumsum(size) - size, np.minimum(size, n)
        row = np.repeat(np.arange(len(size)), size)
        place = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        x[row, place] = flat[start[row] + place]
        return x

    def roll(table: pa.Table) -> pa.Table:
        table = table.sort_by(index).combine_chunks()
        rows = table.column(index).to_numpy().astype(np.int64)
        mine = np.flatnonzero(table.column(bucket).to_numpy() == table.column(home).to_numpy())
        column = table.column(features)
        x = matrix(column.chunk(0) if column.num_chunks else pa.array([], column.type))
        found = np.zeros((len(mine), len(windows) * len(stats), n))
        if len(mine):
            # the row whose window ends gap + 1 rows earlier; rows before the first have none
            ends = mine - gap - 1
            for k, w in enumerate(windows):
                values = statistics(x, int(rows[0]), w, stats)[:, np.maximum(ends, 0)]
                values[:, (ends < 0) | (rows[mine] < w)] = np.nan
                found[:, k * len(stats) : (k + 1) * len(stats)] = values.transpose(1, 0, 2)
        found = np.nan_to_num(found, copy=False, nan=0.0, posinf=limit, neginf=-limit).reshape(-1)
        cells = len(windows) * len(stats) * n
        arrays = pa.ListArray.from_arrays(pa.array(np.arange(len(mine) + 1) * cells, pa.int32()), pa.array(found))
        return table.take(pa.array(mine)).append_column(out, arrays)

    return df.groupBy(bucket).applyInArrow(roll, schema)
