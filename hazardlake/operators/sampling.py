"""Splits, samples, folds and rebalancing.

Randomness is a hash of (seed, row key), so a row keeps its draw under retries
and any partitioning. ``key`` must identify a row.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hazardlake.functions.scalars import uniform_draw
from hazardlake.session import drop_scratch, owned_scratch, scratch_path, stored

from .ordering import add_group_index, add_row_index, attach, row_at

DRAW = "_draw"


# Slices of the draw's range that are counted to find where a cut falls.
DRAW_SLICES = 65_536


def _drawn(df: DataFrame, key: Sequence[str], seed: int | str) -> DataFrame:
    return df.withColumn(DRAW, uniform_draw(seed, *key))


def _flag_drawn(df: DataFrame, key: Sequence[str], seed: int | str, share: Callable[[int], int], name: str) -> DataFrame:
    """Mark the ``share(total)`` rows with the smallest draws; no row is sorted or moved.

    Counting rows per slice of the draw's range finds the slice the cut falls
    into; only that slice's keys are sorted to find the last row that counts.
    """
    keys = _drawn(df.select(*key), key, seed).withColumn("_slice", F.floor(F.col(DRAW) * DRAW_SLICES))
    # At most DRAW_SLICES rows.
    counts = sorted((r["_slice"], r["n"]) for r in keys.groupBy("_slice").agg(F.count(F.lit(1)).alias("n")).collect())
    left = share(sum(n for _, n in counts))
    if left <= 0:
        return df.withColumn(name, F.lit(False))
    for number, n in counts:
        if left <= n:
            break
        left -= n
    cut = row_at(keys.filter(F.col("_slice") == number), [DRAW, *key], left - 1)
    last = cut.agg(F.max(F.struct(*cut.columns))).scalar()
    own = F.struct(*[c.alias(f"k{i}") for i, c in enumerate([uniform_draw(seed, *key), *map(F.col, key)])])
    return df.withColumn(name, own <= last)


def random_split(
    df: DataFrame, key: Sequence[str], test_size: float = 0.2, seed: int = 42, name: str = "is_train"
) -> DataFrame:
    """Mark ``ceil(n * test_size)`` random rows as validation rows, the rest as training rows."""
    marked = _flag_drawn(df, key, seed, lambda n: math.ceil(n * test_size), name)
    return marked.withColumn(name, ~F.col(name))


def random_sample(df: DataFrame, key: Sequence[str], fraction: float, seed: int = 42) -> DataFrame:
    """Exactly ``round(n * fraction)`` random rows."""
    marked = _flag_drawn(df, key, seed, lambda n: round(n * fraction), "_keep")
    return marked.filter("_keep").drop("_keep")


def stratified_folds(
    df: DataFrame, key: Sequence[str], label: str, k: int = 5, seed: int = 42, name: str = "fold"
) -> DataFrame:
    """Shuffled folds that share each label's rows out evenly."""
    ranked = add_group_index(_drawn(df.select(*key, label), key, seed), [label], [DRAW, *key], "_nth")
    return attach(df, ranked.select(*key, F.pmod("_nth", F.lit(k)).cast("int").alias(name)), key)


def plain_folds(df: DataFrame, key: Sequence[str], k: int = 2, seed: int = 42, name: str = "fold") -> DataFrame:
    ranked = add_row_index(_drawn(df.select(*key), key, seed), [DRAW, *key], "_nth")
    return attach(df, ranked.select(*key, F.pmod("_nth", F.lit(k)).cast("int").alias(name)), key)


def undersample(df: DataFrame, key: Sequence[str], label: str, seed: int = 42) -> DataFrame:
    """As many random rows of every label as the rarest label has.

    Rows per label and slice of the draw's range are counted; only the keys of
    the slice in which a label's cut falls are ranked, and the rows themselves
    are only compared with their label's last draw.
    """
    narrow = _drawn(df.select(*key, label), key, seed).withColumn("_slice", F.floor(F.col(DRAW) * DRAW_SLICES))
    counts = stored(narrow.groupBy(label, "_slice").agg(F.count(F.lit(1)).alias("n")))
    smallest = counts.groupBy(label).agg(F.sum("n").alias("n")).agg(F.min("n").alias("n")).scalar()
    upto = F.sum("n").over(W.partitionBy(label).orderBy("_slice"))  # at most DRAW_SLICES rows of a label
    placed = counts.withColumn("_before", upto - F.col("n")).withColumn("_want", smallest - F.col("_before"))
    cut = stored(placed.filter((F.col("_want") > 0) & (F.col("_want") <= F.col("n"))).select(label, "_slice", "_want"))
    same = [F.col(label).eqNullSafe(F.col("_label")), F.col("_slice") == F.col("_cut")]
    inside = narrow.join(cut.select(F.col(label).alias("_label"), F.col("_slice").alias("_cut"), "_want"), same)
    rank = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate([DRAW, *key])])
    nth = F.row_number().over(W.partitionBy(label).orderBy(rank))  # the rows of one slice
    last = inside.withColumn("_nth", nth).filter(F.col("_nth") == F.col("_want")).select(label, rank.alias("_last"))
    kept = attach(_drawn(df, key, seed), stored(last), [label]).filter(rank <= F.col("_last"))
    return kept.select(*df.columns)


# -- nearest neighbours ------------------------------------------------------

# A block holds as many members as fit in so many bytes, however large the table is.
BLOCK_BYTES = 8 << 20
BLOCK_MEMBERS = 2048
# Block outlines sent to tasks at once, about a kilobyte each; more blocks are routed in several passes.
OUTLINES = 20_000
PIVOTS = 64
# After so many of its nearest blocks a vector's limit is tightened before it visits more.
TIGHTEN_AFTER = (8, 64)
# Vectors that a task holds beside those that ask, as doubles.
HOST_BYTES = 64 << 20


def _shuffled(table: DataFrame) -> DataFrame:
    """To be joined by a shuffle of both sides.

    The optimizer takes an array for one number, so a table of vectors looks
    small to it and would be broadcast, whole, through the driver.
    """
    return table.hint("merge")


def _pivots(vectors: DataFrame, key: str, seed: int, wanted: int) -> list[list[float]]:
    """Up to PIVOTS vectors chosen by hash; fewer for a small table, which needs fewer cells."""
    chosen = vectors.orderBy(uniform_draw(seed, key), key).limit(min(max(wanted, 1), PIVOTS)).select("x")
    return [list(r["x"]) for r in chosen.collect()]


def _distances(pivots: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """Distances of vectors to all pivots; like the other functions for tasks it uses nothing of this module."""

    def away(matrix: np.ndarray) -> np.ndarray:
        return np.column_stack([np.sqrt(((matrix - p) ** 2).sum(axis=1)) for p in pivots])

    return away


def _reader() -> tuple[Callable, Callable]:
    """Functions that read the vectors of a packed row, and the values of a list in a row of a batch."""

    def values(batch: pa.RecordBatch, column: str, row: int) -> np.ndarray:
        return batch.column(column)[row].values.to_numpy(zero_copy_only=False)

    def matrix(batch: pa.RecordBatch, row: int, side: str = "") -> np.ndarray:
        kind = np.float32 if batch.column(side + "bits")[row].as_py() == 32 else np.float64
        x = np.frombuffer(batch.column(side + "x")[row].as_buffer(), dtype=kind)
        return x.reshape(len(batch.column(side + "keys")[row].values), -1).astype(np.float64)

    return values, matrix


def _packer(pivots: np.ndarray) -> Callable[[pa.Table], pa.Table]:
    """A function that makes one row of a stretch (``stretch, host_group, block, key, x``): its blocks one after the other.

    ``first`` is where each block begins; ``lower`` and ``upper`` are the block's
    outline, the range of its members' distances to every pivot. Vectors that
    single precision holds exactly are kept in it.
    """
    away = _distances(pivots)

    def pack(rows: pa.Table) -> pa.Table:
        rows = rows.take(pa.array(np.argsort(rows.column("block").to_numpy(), kind="stable"))).combine_chunks()
        block = rows.column("block").to_numpy()
        x = np.stack(rows.column("x").to_pandas().to_numpy())
        at = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
        d = away(x)
        with np.errstate(over="ignore"):
            short = x.astype(np.float32)
        bits = 32 if np.array_equal(short, x, equal_nan=True) else 64
        one = lambda a: pa.ListArray.from_arrays([0, len(a)], a)
        keys = rows.column("key")
        keys = keys.chunk(0) if isinstance(keys, pa.ChunkedArray) else keys
        return pa.table(
            {
                "stretch": pa.array([rows.column("stretch")[0].as_py()], pa.int64()),
                "bits": pa.array([bits], pa.int32()),
                "x": pa.array([(short if bits == 32 else x).tobytes()], pa.binary()),
                "keys": one(keys),
                "first": one(pa.array(at, pa.int32())),
                "blocks": one(pa.array(block[at], pa.int64())),
                "lower": one(pa.array(np.minimum.reduceat(d, at).ravel(), pa.float64())),
                "upper": one(pa.array(np.maximum.reduceat(d, at).ravel(), pa.float64())),
                "host_group": pa.array([rows.column("host_group")[0].as_py()], pa.int32()),
            }
        )

    return pack


def _block_search(k: int) -> Callable:
    """A function that finds what a block's members can add to the k nearest of each asking vector.

    It is built here, and uses nothing of this module, so that executors need
    not have the package installed.
    """

    def search(seekers, asked, limit2, hosts, hosted) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The asking vector's place, the member's place and their squared distance, none beyond ``limit2``."""
        norms = np.einsum("ij,ij->i", hosts, hosts)
        same = bool(np.isin(asked, hosted).any())
        found = []
        for start in range(0, len(seekers), 256):
            part, part_keys, most = seekers[start : start + 256], asked[start : start + 256], limit2[start : start + 256]
            own = np.einsum("ij,ij->i", part, part)
            # A matrix product ranks the members to within rounding; all that
            # could be among the k nearest are then measured exactly.
            rough = (-2.0 * part) @ hosts.T
            rough += norms
            if same:
                rough[part_keys[:, None] == hosted[None, :]] = np.inf
            slack = 1e-9 * (own + norms.max()) + 1e-300
            near = rough <= (most - own + slack)[:, None]
            many = np.flatnonzero(near.sum(axis=1) > 4 * k)
            if len(many):
                some, nth = rough[many], min(k, rough.shape[1]) - 1
                near[many] &= some <= (np.partition(some, nth, axis=1)[:, nth] + slack[many])[:, None]
            rows, columns = np.nonzero(near)
            finite = np.isfinite(rough[rows, columns])
            rows, columns = rows[finite], columns[finite]
            gap = part[rows] - hosts[columns]
            exact = np.einsum("ij,ij->i", gap, gap)
            keep = exact <= most[rows]
            rows, columns, exact = rows[keep], columns[keep], exact[keep]
            order = np.lexsort((hosted[columns], exact, rows))
            rows, columns, exact = rows[order], columns[order], exact[order]
            keep = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left") < k
            found.append((rows[keep] + start, columns[keep], exact[keep]))
        return tuple(np.concatenate(c) for c in zip(*found))

    return search


def _found(k: int) -> tuple[Callable, Callable]:
    """Functions that keep the k nearest of each place, and that tell each place's k-th squared distance."""

    def nearest(row, neighbour, distance2):
        order = np.lexsort((neighbour, distance2, row))
        row, neighbour, distance2 = row[order], neighbour[order], distance2[order]
        keep = np.arange(len(row)) - np.searchsorted(row, row, side="left") < k
        return row[keep], neighbour[keep], distance2[keep]

    def limits(n: int, row, distance2) -> np.ndarray:
        limit2 = np.full(n, np.inf)
        last = np.flatnonzero(np.arange(len(row)) - np.searchsorted(row, row, side="left") == k - 1)
        limit2[row[last]] = distance2[last]
        return limit2

    return nearest, limits


def _at_home(k: int) -> Callable:
    """A function from packed rows to asking rows, each of whose vectors has looked in its own block."""
    search, (nearest, _), (values, matrix) = _block_search(k), _found(k), _reader()

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                x, keys = matrix(batch, r), values(batch, "keys", r)
                first = values(batch, "first", r)
                found = []
                for lo, hi in zip(first, [*first[1:], len(x)]):
                    rows, columns, d2 = search(x[lo:hi], keys[lo:hi], np.full(hi - lo, np.inf), x[lo:hi], keys[lo:hi])
                    found.append((rows + lo, keys[lo:hi][columns], d2))
                row, neighbour, d2 = nearest(*(np.concatenate(c) for c in zip(*found)))
                one = lambda a: pa.ListArray.from_arrays([0, len(a)], a)
                kind = batch.schema.field("keys").type.value_type
                own = batch.slice(r, 1)
                empty = {c: one(pa.array([], t)) for c, t in (("wanted", pa.int64()), ("from_low", pa.float64()), ("from_name", pa.int64()), ("to_low", pa.float64()), ("to_name", pa.int64()))}
                yield pa.RecordBatch.from_pydict(
                    {c: own.column(c) for c in ("stretch", "bits", "x", "keys", "first", "blocks")}
                    | {"row": one(pa.array(row, pa.int32())), "neighbour": one(pa.array(neighbour, from_pandas=True).cast(kind)), "distance2": one(pa.array(d2, pa.float64()))}
                    | empty
                    | {"visits": pa.array([0], pa.int64())}
                )

    return home


def _bounds() -> Callable:
    """A function that tells how near blocks can come to vectors: ``rows, columns, low`` of those within reach.

    No member of a block is closer than the gap between the vector's distance to
    a pivot and the block's range of distances to it; the widest gap of all
    pivots is the block's bound.
    """

    def bounds(d, reach, home, names, lower, upper) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows, columns = np.nonzero(names[None, :] != home[:, None])
        low = np.zeros(len(rows))
        for j in range(d.shape[1]):
            gap = np.maximum(d[rows, j] - upper[columns, j], lower[columns, j] - d[rows, j])
            low = np.maximum(low, gap)
            if j % 4 == 3 or j + 1 == d.shape[1]:  # most blocks are ruled out by a few pivots
                within = low <= reach[rows]
                rows, columns, low = rows[within], columns[within], low[within]
        return rows, columns, low

    return bounds


def _asking(k: int, pivots: np.ndarray) -> Callable:
    """A function that reads an asking row: vectors, distances to pivots, squared limits, reaches and home blocks."""
    away, (_, limits), (values, matrix) = _distances(pivots), _found(k), _reader()

    def reach(limit2: np.ndarray) -> np.ndarray:
        # A hair of slack keeps rounding from hiding an equally near block.
        return np.sqrt(limit2) * (1 + 1e-9) + 1e-12

    def read(batch: pa.RecordBatch, r: int) -> tuple:
        x = matrix(batch, r)
        limit2 = limits(len(x), values(batch, "row", r), values(batch, "distance2", r))
        first = values(batch, "first", r)
        home = np.repeat(values(batch, "blocks", r), np.diff(np.append(first, len(x))))
        return x, away(x), limit2, home

    return read, reach


def _router(k: int, pivots: np.ndarray, outlines: Sequence, first: int, last: int) -> Callable:
    """A function that adds to asking rows which of some blocks each vector has to visit next.

    Blocks within a vector's limit are put in the order of their bounds (and
    names); those from place ``first`` to before ``last`` are named, by the
    bound and name at either place: from ``from_low, from_name`` to before
    ``to_low, to_name``. ``wanted`` are their stretches, ``visits`` their number.
    A smaller limit only cuts the end of that order, so places stay as they are.
    """
    read, reach = _asking(k, pivots)
    bounds, (values, _) = _bounds(), _reader()
    cells = len(pivots)
    names = np.concatenate([np.array(r["blocks"], dtype=np.int64) for r in outlines])
    lower, upper = (np.concatenate([np.array(r[c]).reshape(-1, cells) for r in outlines]) for c in ("lower", "upper"))
    order = np.argsort(names)
    names, lower, upper = names[order], lower[order], upper[order]
    rows_at_once = max(1, 2_000_000 // len(names))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                x, d, limit2, home = read(batch, r)
                cuts = {"from_low": np.full(len(x), np.inf), "to_low": np.full(len(x), np.inf)}
                cuts |= {c: np.full(len(x), np.iinfo(np.int64).max) for c in ("from_name", "to_name")}
                visits, wanted = batch.column("visits")[r].as_py(), [values(batch, "wanted", r)]
                for start in range(0, len(x), rows_at_once):
                    part = slice(start, start + rows_at_once)
                    rows, columns, low = bounds(d[part], reach(limit2[part]), home[part], names, lower, upper)
                    order = np.lexsort((columns, low, rows))
                    rows, columns, low = rows[order], columns[order], low[order]
                    place = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")
                    for side, at in (("from", place == first), ("to", place == last)):
                        cuts[f"{side}_low"][rows[at] + start] = low[at]
                        cuts[f"{side}_name"][rows[at] + start] = names[columns[at]]
                    named = (place >= first) & (place < last)
                    visits += int(named.sum())
                    wanted.append(np.unique(names[columns[named]]) // cells)
                one = lambda a: pa.ListArray.from_arrays([0, len(a)], a)
                own = batch.slice(r, 1)
                changed = {c: one(pa.array(np.concatenate([values(batch, c, r), cuts[c]]))) for c in cuts}
                changed |= {"wanted": one(pa.array(np.unique(np.concatenate(wanted)), pa.int64())), "visits": pa.array([visits], pa.int64())}
                yield pa.RecordBatch.from_pydict({c: changed.get(c, own.column(i)) for i, c in enumerate(batch.schema.names)})

    return route


def _visitor(k: int, pivots: np.ndarray, asking_columns: list[str]) -> Callable:
    """A function from pairs of an asking and a host row (``host_*``) to asking rows that know the hosts.

    All pairs of one asking row come one after the other. A host without a
    stretch is nobody: it only keeps the asking row.
    """
    read, reach = _asking(k, pivots)
    search, (nearest, limits), bounds, (values, matrix) = _block_search(k), _found(k), _bounds(), _reader()
    cells = len(pivots)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None

        def known() -> pa.RecordBatch:
            one = lambda a: pa.ListArray.from_arrays([0, len(a)], a)
            kind = own.schema.field("keys").type.value_type
            changed = {"row": one(pa.array(row, pa.int32())), "neighbour": one(pa.array(neighbour, from_pandas=True).cast(kind)), "distance2": one(pa.array(d2, pa.float64()))}
            return pa.RecordBatch.from_pydict({c: changed.get(c, own.column(c)) for c in asking_columns})

        for batch in batches:
            for r in range(batch.num_rows):
                if own is None or batch.column("stretch")[r].as_py() != own.column("stretch")[0].as_py():
                    if own is not None:
                        yield known()
                    # taken out of the batch, which is far larger
                    own = batch.select(asking_columns).take(pa.array([r]))
                    (x, d, limit2, home), keys = read(own, 0), values(own, "keys", 0)
                    row, neighbour, d2 = (values(own, c, 0) for c in ("row", "neighbour", "distance2"))
                    cuts = {c: values(own, c, 0).reshape(-1, len(x)) for c in ("from_low", "from_name", "to_low", "to_name")}
                stretch = batch.column("host_stretch")[r].as_py()
                if stretch is None:
                    continue
                names, first = values(batch, "host_blocks", r), values(batch, "host_first", r)
                lower, upper = (values(batch, c, r).reshape(-1, cells) for c in ("host_lower", "host_upper"))
                rows, columns, low = bounds(d, reach(limit2), home, names, lower, upper)
                cut = {c: v[stretch % len(v)][rows] for c, v in cuts.items()}
                name = names[columns]
                named = (low > cut["from_low"]) | (low == cut["from_low"]) & (name >= cut["from_name"])
                named &= (low < cut["to_low"]) | (low == cut["to_low"]) & (name < cut["to_name"])
                rows, columns = rows[named], columns[named]
                if not len(rows):
                    continue
                hosts, hosted = matrix(batch, r, "host_"), values(batch, "host_keys", r)
                found = [(row, neighbour, d2)]
                for b in np.unique(columns):
                    ask, lo, hi = rows[columns == b], first[b], first[b + 1] if b + 1 < len(first) else len(hosts)
                    at, member, gap = search(x[ask], keys[ask], limit2[ask], hosts[lo:hi], hosted[lo:hi])
                    found.append((ask[at], hosted[lo:hi][member], gap))
                if any(len(f[0]) for f in found[1:]):
                    row, neighbour, d2 = nearest(*(np.concatenate(c) for c in zip(*found)))
                    limit2 = limits(len(x), row, d2)
        if own is not None:
            yield known()

    return visit


def nearest_neighbours(
    vectors: DataFrame,
    k: int,
    key: str = "key",
    seed: int = 7,
    block_members: int = BLOCK_MEMBERS,
    outlines_at_once: int = OUTLINES,
    tighten_after: Sequence[int] = TIGHTEN_AFTER,
    visits: list[int] | None = None,
) -> DataFrame:
    """The exact ``k`` nearest other vectors of each vector: ``(key, rank, neighbour, distance2)``.

    ``vectors`` has a unique ``key`` and an array ``x``. Nothing is compared
    with everything: vectors are cut into blocks of bounded size, ordered by
    (closest pivot, second closest, distance). Each block keeps the range of its
    members' distances to all pivots. A vector first looks in its own block,
    whose k-th distance bounds its true k-th distance. By the triangle
    inequality it then only has to visit blocks whose ranges come closer than
    that, the nearest first; after every ``tighten_after`` blocks (per pass of
    outlines) what was found lowers its limit. The number of visits of each
    round is appended to ``visits``.

    Visits are made by stretches of vectors, packed in one row each, and move
    nothing through a shuffle: a task reads its asking stretches and a bounded
    group of hosts from stored tables and pairs them there. Each group's round
    is stored in place of the one before, so the disk in use grows with the
    vectors, not with the visits.
    """
    spark = vectors.sparkSession
    vectors = vectors.select(F.col(key).alias("key"), F.col("x").cast("array<double>").alias("x"))
    total = vectors.count()
    width = vectors.select(F.size("x")).head()[0] if total else 1
    members_limit = max(2, min(block_members, BLOCK_BYTES // (8 * max(1, width))))
    pivots = np.array(_pivots(vectors, "key", seed, total // members_limit))
    if not total:
        return spark.createDataFrame([], "key bigint, rank int, neighbour bigint, distance2 double")

    key_type = vectors.schema["key"].dataType.simpleString()
    away = _distances(pivots)

    @F.pandas_udf("pivot int, second int, radius double")
    def closest(x: pd.Series) -> pd.DataFrame:
        d = away(np.stack(x.to_numpy()))
        order = np.argsort(d, axis=1, kind="stable")
        first, second = order[:, 0], order[:, min(1, d.shape[1] - 1)]
        return pd.DataFrame({"pivot": first.astype(np.int32), "second": second.astype(np.int32), "radius": d.min(axis=1)})

    packed_type = (
        f"stretch long, bits int, x binary, keys array<{key_type}>, first array<int>, blocks array<long>, "
        "lower array<double>, upper array<double>, host_group int"
    )
    path = scratch_path(spark, "packed")
    with owned_scratch(spark):  # the sorted rows go when they are packed
        placed = vectors.withColumn("_c", closest("x")).select("key", "x", "_c.*")
        # Consecutive rows of one pivot's cell form a block.
        ordered = add_row_index(placed, ["pivot", "second", "radius", "key"], "_i")
        stretch = ((F.col("_i") - F.pmod("_i", F.lit(members_limit))) / members_limit).cast("bigint")
        group_size = max(1, HOST_BYTES // (members_limit * 8 * max(1, width)))
        rows = ordered.select(
            stretch.alias("stretch"),
            F.floor(stretch / group_size).cast("int").alias("host_group"),
            (stretch * F.lit(len(pivots)) + F.col("pivot")).alias("block"),
            "key",
            "x",
        )
        rows.groupBy("stretch").applyInArrow(_packer(pivots), packed_type).write.partitionBy("host_group").parquet(path)
    packed = spark.read.schema(packed_type).parquet(path)

    ranked = W.partitionBy("key").orderBy("distance2", "neighbour")

    def closest_first(asking: DataFrame) -> DataFrame:
        keys = F.transform("row", lambda i: F.element_at("keys", i + 1)).alias("key")
        found = asking.select(keys, "neighbour", "distance2").select(F.explode(F.arrays_zip("key", "neighbour", "distance2")).alias("n")).select("n.*")
        best = found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
        return best.select("key", "rank", "neighbour", "distance2")

    asking_type = (
        f"stretch long, bits int, x binary, keys array<{key_type}>, first array<int>, blocks array<long>, row array<int>, neighbour array<{key_type}>, "
        "distance2 array<double>, wanted array<long>, from_low array<double>, from_name array<long>, to_low array<double>, to_name array<long>, visits long"
    )
    held: list[str] = []

    def hold(asking: DataFrame) -> DataFrame:
        """Stored in place of what it was made from."""
        held.append(scratch_path(spark, "asking"))
        asking.write.parquet(held[-1])
        if len(held) > 1:
            drop_scratch(spark, held.pop(0))
        return spark.read.schema(asking.schema).parquet(held[-1])

    asking = packed.drop("host_group").mapInArrow(_at_home(k), asking_type)
    n_blocks = packed.agg(F.sum(F.size("blocks"))).head()[0]
    if n_blocks == 1:
        return closest_first(asking)
    asking = hold(asking)
    groups = [r["host_group"] for r in packed.select("host_group").distinct().orderBy("host_group").collect()]
    passes = math.ceil(n_blocks / outlines_at_once)
    nobody = spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f"host_{f.name}") for f in packed.drop("host_group").schema])
    edges = [0, *(n for n in tighten_after if n < n_blocks - 1), n_blocks]
    for first, last in zip(edges, edges[1:]):
        none = {c: F.array().cast(asking.schema[c].dataType) for c in ("wanted", "from_low", "from_name", "to_low", "to_name")}
        asking = asking.withColumns(none | {"visits": F.lit(0).cast("bigint")})
        # Which blocks can hold something closer, asked of a bounded number of outlines at a time.
        for i in range(passes):
            some = packed.filter(F.pmod("stretch", F.lit(passes)) == i).select("blocks", "lower", "upper").collect()
            if some:
                asking = hold(asking.mapInArrow(_router(k, pivots, some, first, last), asking_type))
        count = asking.agg(F.sum("visits")).head()[0]
        if visits is not None:
            visits.append(count)
        if not count:
            break
        for group in groups:
            # The stretches of this group that anybody visits: a number each.
            named = asking.select(F.explode("wanted").alias("stretch")).distinct()
            hosts = packed.filter(F.col("host_group") == group).drop("host_group").join(F.broadcast(named), "stretch", "left_semi")
            hosts = hosts.select(*[F.col(c).alias(f"host_{c}") for c in hosts.columns]).unionByName(nobody)
            meets = F.col("host_stretch").isNull() | F.array_contains("wanted", F.col("host_stretch"))
            # Pairs of a task's asking rows with all hosts of the group, read by that task.
            pairs = asking.hint("shuffle_replicate_nl").join(hosts.coalesce(1), meets)
            met = pairs.mapInArrow(_visitor(k, pivots, asking.columns), asking_type)
            final = last == edges[-1] and group == groups[-1]
            asking = met if final else hold(met)
    return closest_first(asking)


def synthetic_count(majority: int, minority: int, ratio: float) -> int:
    """New minority rows that lift minority/majority to ``ratio``."""
    n = int(majority * ratio - minority)
    if n < 0:
        raise ValueError("the minority already exceeds the requested ratio")
    return n


def smote(
    df: DataFrame,
    key: str,
    label: str,
    features: str = "features",
    ratio: float = 0.5,
    k: int = 5,
    seed: int = 42,
    strict: bool = True,
) -> DataFrame:
    """Synthetic minority rows: ``(new_id, base_key, neighbour_key, label, features)``.

    Each lies on the line from a minority row to one of its k nearest minority
    rows. Equal vectors are searched once: copies of a vector are its nearest
    neighbours at distance 0, and the line to a copy is the vector itself.
    Append the result with ``unionByName`` to get the rebalanced table. A table
    of one class has no minority and gets no new rows. Where the minority exceeds
    ``ratio`` already, that is an error, or if not ``strict`` there are no new rows.
    """
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy("n", label).limit(3).collect()
    if len(counts) > 2:
        raise ValueError("more than two classes")
    sizes = [c["n"] for c in counts]
    if len(sizes) < 2 or not strict and int(sizes[1] * ratio) <= sizes[0]:
        nothing = df.filter(F.lit(False))
        number = F.lit(0).cast("bigint")
        return nothing.select(
            number.alias("new_id"),
            F.col(key).alias("base_key"),
            number.alias("neighbour_row"),
            label,
            F.col(features).cast("array<double>").alias(features),
        )
    minority_label, n_min, n_maj = counts[0][label], counts[0]["n"], counts[1]["n"]
    n_new = synthetic_count(n_maj, n_min, ratio)

    minority = df.filter(F.col(label) == F.lit(minority_label)).select(
        F.col(key).alias("key"), F.col(features).cast("array<double>").alias("x")
    )
    minority = add_row_index(minority, ["key"], "nth")
    # One representative per distinct vector, and how many copies it stands for.
    groups = minority.groupBy("x").agg(F.min("nth").alias("rep"), F.count(F.lit(1)).alias("copies"))
    groups = stored(groups)
    near = nearest_neighbours(groups.select(F.col("rep").alias("key"), "x"), k)
    # Neighbour slots in order: the other copies first, then each neighbour's copies.
    copies = groups.select(F.col("rep").alias("neighbour"), "copies", F.col("x").alias("y"))
    slots = near.join(_shuffled(copies), "neighbour").groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct("rank", "neighbour", "copies", "y"))).alias("near")
    )
    table = groups.join(_shuffled(slots), groups["rep"] == slots["key"], "left").select("x", "rep", "copies", "near")

    # Draws: the base row comes round-robin from a shuffled minority, so no row
    # is drawn far more often than another; slot and position are hash draws.
    draws = minority.select("nth", "key", uniform_draw(f"{seed}/base", "nth").alias(DRAW))
    draws = add_row_index(draws, [DRAW, "nth"], "turn")
    turns = F.floor((F.lit(n_new) - 1 - F.col("turn")) / F.lit(n_min)).cast("int")
    drawn = (
        draws.filter(F.col("turn") < n_new)
        .withColumn("round", F.explode(F.sequence(F.lit(0), turns)))
        .withColumn("new_id", F.col("turn") + F.col("round").cast("bigint") * n_min)
        .withColumn("u", uniform_draw(f"{seed}/slot", "new_id"))
        .withColumn("g", uniform_draw(f"{seed}/gap", "new_id"))
    )
    base = drawn.join(_shuffled(minority.select("nth", "x")), "nth").join(_shuffled(table), "x").select(
        "new_id", F.col("key").alias("base_key"), "x", "u", "g", "rep", "copies", "near"
    )
    near_or_none = F.coalesce("near", F.array().cast(table.schema["near"].dataType))
    reach = F.aggregate(near_or_none, F.lit(0).cast("bigint"), lambda a, n: a + n["copies"])
    usable = F.least(F.lit(k).cast("bigint"), F.col("copies") - 1 + reach)
    base = base.withColumn("slot", F.floor(F.col("u") * usable) - (F.col("copies") - 1))
    # slot < 0: another copy of the same vector; otherwise walk the neighbours' copies.
    walk = F.aggregate(
        near_or_none,
        F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("int").alias("hit")),
        lambda a, n: F.struct(
            (a["seen"] + n["copies"]).alias("seen"),
            F.coalesce(a["hit"], F.when(F.col("slot") < a["seen"] + n["copies"], n["rank"])).alias("hit"),
        ),
    )["hit"]
    base = base.withColumn("hit", F.when(F.col("slot") >= 0, walk))
    chosen = F.when(F.col("hit").isNotNull(), F.filter("near", lambda n: n["rank"] == F.col("hit"))[0])
    base = base.withColumn("n", chosen)
    other = F.coalesce(F.col("n.y"), F.col("x"))
    return base.select(
        "new_id",
        "base_key",
        F.coalesce(F.col("n.neighbour"), F.col("rep")).alias("neighbour_row"),
        F.lit(minority_label).alias(label),
        F.zip_with("x", other, lambda a, b: a + F.col("g") * (b - a)).alias(features),
    )


def concat_rows(first: DataFrame, *more: DataFrame) -> DataFrame:
    """Append tables by column name."""
    for other in more:
        first = first.unionByName(other)
    return first

