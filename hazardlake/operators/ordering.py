"""Exact global order without a one-task window.

``row_number()`` over an unpartitioned window sends every row to one task. The
functions here range-sort once instead, write the sorted blocks to the shared
checkpoint folder, and add each block's offset to a row's place in its block.
Range partitioning samples the whole sort key, so one timestamp (or label, or
score) that holds a third of the rows is cut into several blocks by the next
key. Once written, a block cannot change when an executor is lost, which is
what makes counting it in one job and numbering it in another safe.

Only sort keys should be ranked this way: :func:`attach` brings a result back
to the wide rows by their key. The only broadcast asked for is the block table,
with one row per sorted partition; other joins are left to the optimizer.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from hazardlake.functions.scalars import col
from hazardlake.session import stored

BLOCK = "_block"
POSITION = "_pos"
BUCKET = "_bucket"
HOME = "_home"
ROWS_PER_BUCKET = 8192

Order = Sequence["Column | str"]


def sorted_blocks(df: DataFrame, order_by: Order) -> DataFrame:
    """Rows in global order, with their block number and place in the block (from 0).

    ``order_by`` should be a total order, otherwise tied rows keep whatever
    order the sort gave them.
    """
    # monotonically_increasing_id: partition number above bit 33, row number below.
    ordered = df.orderBy(*[col(c) for c in order_by]).withColumn("_mono", F.monotonically_increasing_id())
    tagged = stored(ordered, "blocks")
    return tagged.select(
        *df.columns,
        F.shiftright("_mono", 33).cast("int").alias(BLOCK),
        F.col("_mono").bitwiseAND(F.lit((1 << 33) - 1)).alias(POSITION),
    )


def _offsets(blocks: DataFrame, totals: Mapping[str, Column], overall: Mapping[str, str] = {}) -> DataFrame:
    """Per block, the total of every earlier block, and overall totals."""
    # One row per block, so this window's single partition is as small as the block list.
    earlier = W.orderBy(BLOCK).rowsBetween(W.unboundedPreceding, -1)
    sums = blocks.groupBy(BLOCK).agg(*[e.alias(n) for n, e in totals.items()])
    return sums.select(
        BLOCK,
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n) for n in totals],
        *[F.sum(of).over(W.partitionBy()).alias(n) for n, of in overall.items()],
    )


def attach(df: DataFrame, narrow: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the other columns of ``narrow`` to the rows with the same key, nulls included.

    The key must identify a row on both sides.
    """
    right = narrow.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in narrow.columns if c not in set(keys)])
    on = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return df.join(right, on, "inner").drop(*[f"_k_{k}" for k in keys])


def add_row_index(df: DataFrame, order_by: Order, name: str = "row_idx") -> DataFrame:
    """Number rows 0, 1, 2, ... in the given order."""
    blocks = sorted_blocks(df, order_by)
    offsets = _offsets(blocks, {"_before": F.count(F.lit(1))})
    return blocks.join(F.broadcast(offsets), BLOCK).select(
        *df.columns, (F.col("_before") + F.col(POSITION)).alias(name)
    )


def add_group_index(
    df: DataFrame, group: Sequence[str], order_by: Order, name: str = "group_idx"
) -> DataFrame:
    """Number rows 0, 1, 2, ... inside each group, whatever the group's size.

    A group that holds most of the rows spans several sorted blocks; its rows
    get the global number minus the group's first number.
    """
    indexed = add_row_index(df, [*group, *order_by], "_global")
    # Stored, so that its size is known and a small one is broadcast by the optimizer.
    first = stored(indexed.groupBy(*group).agg(F.min("_global").alias("_first")))
    return attach(indexed, first, group).select(
        *df.columns, (F.col("_global") - F.col("_first")).alias(name)
    )


def add_prefix_sums(
    df: DataFrame,
    order_by: Order,
    sums: Mapping[str, str],
    totals: Mapping[str, str] | None = None,
    group: Sequence[str] = (),
) -> DataFrame:
    """Running totals ``{new_column: source_column}`` up to and including each row.

    ``totals`` names a column for the table-wide total of a running total. With
    ``group`` both are those of the row's own group, nulls included, whatever the
    groups' sizes: one sort serves them all, and a large group spans several blocks.
    """
    if group:
        return _grouped_prefix_sums(df, order_by, sums, totals or {}, list(group))
    blocks = sorted_blocks(df, order_by)
    before = {f"_before_{n}": F.sum(c) for n, c in sums.items()}
    within = W.partitionBy(BLOCK).orderBy(POSITION).rowsBetween(W.unboundedPreceding, 0)
    running = [
        (F.col(f"_before_{n}") + F.sum(c).over(within)).alias(n) for n, c in sums.items()
    ]
    overall = {name: f"_before_{of}" for name, of in (totals or {}).items()}
    offsets = _offsets(blocks, before, overall)
    return blocks.join(F.broadcast(offsets), BLOCK).select(*df.columns, *running, *overall)


def _grouped_prefix_sums(
    df: DataFrame, order_by: Order, sums: Mapping[str, str], totals: Mapping[str, str], group: list[str]
) -> DataFrame:
    blocks = sorted_blocks(df, [*group, *order_by])
    # One row per block and group in it: at most the blocks and the groups together.
    pieces = blocks.groupBy(BLOCK, *group).agg(*[F.sum(c).alias(f"_before_{n}") for n, c in sums.items()])
    whole = W.partitionBy(*group)
    earlier = whole.orderBy(BLOCK).rowsBetween(W.unboundedPreceding, -1)
    offsets = pieces.select(
        BLOCK,
        *group,
        *[F.coalesce(F.sum(f"_before_{n}").over(earlier), F.lit(0)).alias(f"_before_{n}") for n in sums],
        *[F.sum(f"_before_{of}").over(whole).alias(name) for name, of in totals.items()],
    )
    within = W.partitionBy(BLOCK, *group).orderBy(POSITION).rowsBetween(W.unboundedPreceding, 0)
    running = [(F.col(f"_before_{n}") + F.sum(c).over(within)).alias(n) for n, c in sums.items()]
    return attach(blocks, offsets, [BLOCK, *group]).select(*df.columns, *running, *totals)


def row_at(df: DataFrame, order_by: Order, position: int) -> DataFrame:
    """The one row at a position; only the sort key is sorted, not the wide row."""
    names = [f"k{i}" for i in range(len(order_by))]
    keys = df.select(*[col(c).alias(n) for c, n in zip(order_by, names, strict=True)])
    return add_row_index(keys, names, "_idx").filter(F.col("_idx") == position).drop("_idx")


def flag_first(df: DataFrame, order_by: Order, rows: int, name: str) -> DataFrame:
    """Mark the first ``rows`` rows of an order.

    The key at the cut is found on the narrow key table; the wide table is then
    only filtered by comparing with it, so its rows are never shuffled.
    """
    if rows <= 0:
        return df.withColumn(name, F.lit(False))
    key = F.struct(*[col(c).alias(f"k{i}") for i, c in enumerate(order_by)])
    cut = row_at(df, order_by, rows - 1)
    last = cut.agg(F.max(F.struct(*cut.columns))).scalar()
    return df.withColumn(name, F.coalesce(key <= last, F.lit(True)))


def over_preceding(call: str, index: str, first: int, last: int) -> Column:
    """An aggregate, as SQL text, over the rows ``first`` to ``last`` before the current one.

    For :func:`with_neighbours`, where hundreds of frames are written more
    quickly as text than composed call by call.
    """
    rows = f"ROWS BETWEEN {first} PRECEDING AND {last} PRECEDING"
    return F.expr(f"{call} OVER (PARTITION BY `{BUCKET}` ORDER BY `{index}` {rows})")


def with_neighbours(
    df: DataFrame,
    index: str,
    before: int,
    after: int,
    frames: Callable[[WindowSpec], Mapping[str, Column]],
    finish: Callable[[], Mapping[str, Column]],
    bucket_rows: int = ROWS_PER_BUCKET,
    keep: Sequence[str] = (),
    grow: Callable[[DataFrame], DataFrame] = lambda framed: framed,
) -> DataFrame:
    """Row-based window expressions over one long sequence, in parallel.

    Rows are cut into buckets of ``bucket_rows`` consecutive index values. The
    last ``before`` rows of a bucket are copied into the next one and the first
    ``after`` rows into the previous one, so every frame reaching at most that
    far is complete inside its bucket; the copies are dropped afterwards.

    ``frames`` gives the bare window expressions by name and ``finish`` the
    result columns built from those names. Kept apart, each window expression
    is evaluated once however often a result refers to it. ``keep`` names
    window expressions that are results as they are. ``grow`` may add columns to
    whole buckets beyond what window expressions can say.
    """
    size = max(int(bucket_rows), before, after, 1)
    place = F.pmod(F.col(index), F.lit(size))
    home = ((F.col(index) - place) / size).cast("bigint")
    targets = [home]
    if before:
        targets.append(F.when(place >= size - before, home + 1))
    if after:
        targets.append(F.when((place < after) & (home > 0), home - 1))
    copies = df.withColumn(HOME, home).withColumn(BUCKET, F.explode(F.array_compact(F.array(*targets))))
    window = W.partitionBy(BUCKET).orderBy(index)
    framed = copies.select("*", *[e.alias(n) for n, e in frames(window).items()])
    kept = grow(framed).filter(F.col(BUCKET) == F.col(HOME))
    results = finish()
    columns = [results[c].alias(c) if c in results else F.col(c) for c in df.columns]
    added = [e.alias(n) for n, e in results.items() if n not in df.columns]
    return kept.select(*columns, *keep, *added)
