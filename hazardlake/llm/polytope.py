"""Near-duplicate vectors: cross-polytope hashing after fast Hadamard rotations.

A vector is turned by three rounds of random signs and a fast Hadamard
transform; the axis it then lies closest to, with its sign, is its hash. Two
hashes make a bucket, ``TABLES`` such buckets a vector's places, and every table
is probed at the buckets that the vector misses by least as well. Vectors of one
bucket whose sign sketches (``SKETCH`` random planes) differ in at most ``BITS``
bits are candidates.

Candidates that hang together are a block. A block's vectors travel once, and
the cosine in double precision decides on all its pairs, so that a pair that no
table brought together still links if both hang on others. A crowded bucket or
block is cut in parts, and each pair of parts is a unit of work of its own: no
pairs leave a task, only counts of links and a forest of them.

At a cosine of exactly 0.93, a pair of 64 components shares no bucket with a
probability of 1 in 1700 (simulated), and 1 in 100 000 misses the sketch's limit.

Equal vectors of one label are one class, compared once. Defined results: a
vector that is null, empty, zero or holds a null or non-finite component links
with nothing, nor does one whose label is null; vectors of different length
never link; every row is a vector, repeated ids too; a class or group without
any id has none as ``component_id``, and its rows are kept; an empty table gives
no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardlake.llm.simhash import components
from hazardlake.llm.words import mixed
from hazardlake.session import stored

COSINE = 0.93
TABLES = 5
HASHES = 2
PROBES = 3
SKETCH = 128
BITS = 31
SEED = 20
#: Entries of a bucket that one task compares with one another, about.
CROWD = 20_000
#: Components of the vectors of one unit of work, about: 8 MB of doubles.
UNIT = 1 << 20
#: Components handled at once, and cosines held at once.
_AT_ONCE = 1 << 19
_COSINES = 1 << 22


# --- vectors ----------------------------------------------------------------


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and vectors (doubles, one length) of the usable rows of a list column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.fill_null(column.flatten().cast(pa.float64()), np.nan).to_numpy(zero_copy_only=False)  # null lists have no cells here
    start = np.cumsum(sizes) - sizes
    for size in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == size)
        step = max(1, _AT_ONCE // size)
        for i in range(0, len(rows), step):
            some = rows[i : i + step]
            x = flat[start[some][:, None] + np.arange(size)] + 0.0  # minus zero is zero
            good = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
            if good.any():
                yield some[good], x[good]


def scaled(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The vectors times powers of two that keep squares in range, and their lengths."""
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    return x, np.sqrt(np.einsum("ij,ij->i", x, x))


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Hadamard transform of each row; its length is a power of two."""
    n, size = x.shape
    half = 1
    while half < size:
        pairs = x.reshape(n, -1, 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, size)
        half *= 2
    return x


def _signs(size: int, table: int, hash_: int) -> np.ndarray:
    return np.random.default_rng([SEED, size, table, hash_]).choice([-1.0, 1.0], size=(3, size))


def nearest_axes(x: np.ndarray, table: int, hash_: int, most: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` signed axes that each rotated row (unit length, padded) is closest to, and its coordinates on them."""
    size = x.shape[1]
    for signs in _signs(size, table, hash_):
        x = hadamard(x * signs) / np.sqrt(size)
    far = np.abs(x)
    order = np.argsort(-far, axis=1, kind="stable")[:, :most]
    on = np.take_along_axis(x, order, axis=1)
    return order * 2 + (on < 0), np.abs(on)


def _probe_choices(hashes: int, most: int) -> list[tuple[int, ...]]:
    """Which nearest axis each hash may take in a probe: the first, one or two seconds, or one third."""
    base = [0] * hashes
    out = [tuple(base)]
    for many in (1, 2):
        for which in combinations(range(hashes), many):
            out.append(tuple(1 if i in which else 0 for i in range(hashes)))
    out += [tuple(2 if i == which else 0 for i in range(hashes)) for which in range(hashes)]
    return [c for c in out if max(c) < most]


def buckets(x: np.ndarray, tables: int = TABLES, hashes: int = HASHES, probes: int = PROBES) -> np.ndarray:
    """Per unit vector its buckets: in every table its own and those it misses by least."""
    n, size = x.shape
    padded = np.zeros((n, max(2, 1 << (size - 1).bit_length())))
    padded[:, :size] = x
    most = min(3, padded.shape[1])
    choices = _probe_choices(hashes, most)
    probes = min(probes, len(choices))
    out = np.zeros((n, tables, probes), dtype=np.uint64)
    for t in range(tables):
        near = [nearest_axes(padded, t, h, most) for h in range(hashes)]
        code = np.full((n, len(choices)), t + 1, dtype=np.uint64)
        lost = np.zeros((n, len(choices)))
        for c, choice in enumerate(choices):
            for (axis, on), pick in zip(near, choice):
                code[:, c] = code[:, c] * np.uint64(2 * padded.shape[1] + 1) + axis[:, pick].astype(np.uint64)
                lost[:, c] += (on[:, 0] - on[:, pick]) ** 2
        best = np.argsort(lost, axis=1, kind="stable")[:, :probes]
        out[:, t] = np.take_along_axis(code, best, axis=1)
    return out.reshape(n, tables * probes)


def sketches(x: np.ndarray) -> np.ndarray:
    """Sides of random planes, as two words of 64 bits a row."""
    planes = np.random.default_rng([SEED, x.shape[1], SKETCH]).normal(size=(x.shape[1], SKETCH))
    return np.packbits(x @ planes > 0, axis=1, bitorder="little").view("<u8")


def digest(label: str, vector: np.ndarray) -> bytes:
    """Names a label's vector."""
    return hashlib.blake2b(label.encode() + b"\0" + vector.astype("<f8").tobytes(), digest_size=16).digest()


def _node(leaves: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(leaves), dtype="<i8")[::2]


# --- Spark jobs -------------------------------------------------------------


def _usable(docs: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    kind = docs.schema[vector].dataType
    plain = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.FloatType, T.DoubleType))
    vec: Column = F.col(f"`{vector}`") if plain else F.col(f"`{vector}`").cast("array<double>")
    return docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").cast("string").alias("label"), vec.alias("vec"))


def _leaves(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, list[str], list[bytes]]]:
    """Row numbers, vectors, labels and class names of the rows that can link."""
    labels = batch.column("label").to_pylist()
    for rows, x in matrices(batch.column("vec")):
        named = np.array([labels[r] is not None for r in rows.tolist()])
        rows, x = rows[named], x[named]
        if len(rows):
            own = [labels[r] for r in rows.tolist()]
            yield rows, x, own, [digest(la, v) for la, v in zip(own, x)]


def classes(rows: DataFrame) -> DataFrame:
    """``key, leaf, node, size``: each row's class, its name as a number, and components (null where the row cannot link).

    Two classes may share a node; they are only compared once more for it.
    """

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = np.full(batch.num_rows, None, dtype=object)
            node, size = np.zeros(batch.num_rows, dtype=np.int64), np.zeros(batch.num_rows, dtype=np.int64)
            for at, x, _, leaves in _leaves(batch):
                leaf[at], node[at], size[at] = leaves, _node(leaves), x.shape[1]
            yield pa.record_batch(
                [batch.column("key"), pa.array(leaf.tolist(), pa.binary()), pa.array(node), pa.array(size)], names=["key", "leaf", "node", "size"]
            )

    return rows.mapInArrow(name, f"key {rows.schema['key'].dataType.simpleString()}, leaf binary, node long, size long")


def _entries(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Nodes, buckets and sketches of a batch's classes, each once."""
    for _, x, labels, leaves in _leaves(batch):
        _, first = np.unique(np.array(leaves, dtype="S16"), return_index=True)
        x, long = scaled(x[first])
        x /= long[:, None]
        names = {la: int.from_bytes(hashlib.blake2b(f"{x.shape[1]} {la}".encode(), digest_size=8).digest(), "little") for la in set(labels)}
        of = np.array([names[labels[i]] for i in first.tolist()], dtype=np.uint64)
        yield _node([leaves[i] for i in first.tolist()]), mixed(mixed(buckets(x)) + of[:, None]).view(np.int64), sketches(x).view(np.int64)


def candidates(rows: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Edges ``a, b`` that connect all nodes of one bucket whose sketches are near, directly or in steps."""
    tasks = max(1, rows.rdd.getNumPartitions())
    # a bucket with more than `crowd` entries has at least its even share of them in some task
    share = max(2, crowd // tasks)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [np.zeros(0, dtype=np.int64)]
        for batch in batches:
            found += [b.ravel() for _, b, _ in _entries(batch)]
        bucket, n = np.unique(np.concatenate(found), return_counts=True)
        yield pa.record_batch({"bucket": pa.array(bucket[n >= share]), "n": pa.array(n[n >= share].astype(np.int64))})

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, bucket, sketch in _entries(batch):
                many = bucket.shape[1]
                yield pa.record_batch(
                    {"bucket": pa.array(bucket.ravel()), "node": pa.array(np.repeat(node, many)), "s0": pa.array(np.repeat(sketch[:, 0], many)), "s1": pa.array(np.repeat(sketch[:, 1], many))}
                )

    full = rows.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).filter(F.col("n") >= crowd)
    full = stored(full.select("bucket", F.ceil(F.col("n") / crowd + 1).cast("int").alias("parts")), "crowded")
    entries = rows.mapInArrow(spread, "bucket long, node long, s0 long, s1 long")
    if full.isEmpty():
        dealt = entries.select(F.lit(0).alias("i"), F.lit(0).alias("j"), "*").repartition("bucket", "i", "j")
    else:
        part = F.pmod(F.xxhash64("node"), "parts").cast("int")
        pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: F.struct(F.least("part", p).alias("i"), F.greatest("part", p).alias("j")))
        cut = entries.join(full, "bucket", "left").withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("part", part)
        dealt = cut.select("bucket", "node", "s0", "s1", F.explode(pairs).alias("x")).select("x.i", "x.j", "bucket", "node", "s0", "s1").repartition("bucket", "i", "j")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts)
        bucket, i, j, node, s0, s1 = (table.column(c).to_numpy() for c in ("bucket", "i", "j", "node", "s0", "s1"))
        order = np.lexsort((node, j, i, bucket))
        bucket, i, j, node, s0, s1 = bucket[order], i[order], j[order], node[order], s0[order].view(np.uint64), s1[order].view(np.uint64)
        new = np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
        once = new | np.concatenate([[True], node[1:] != node[:-1]])  # a class that several tasks sent
        group = np.cumsum(new)[once]
        node, s0, s1 = node[once], s0[once], s1[once]
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        size = np.diff(np.append(first, len(node)))
        a, b = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for at, n in zip(first[size > 1].tolist(), size[size > 1].tolist()):
            p, q, nodes = s0[at : at + n], s1[at : at + n], node[at : at + n]

            def near(k: int, pool: np.ndarray) -> np.ndarray:
                return np.bitwise_count(p[pool] ^ p[k]).astype(np.int64) + np.bitwise_count(q[pool] ^ q[k]) <= BITS

            for k, found in forest(n, near):
                a.append(np.full(len(found), nodes[k]))
                b.append(nodes[found])
        pairs = np.unique(np.sort(np.column_stack([np.concatenate(a), np.concatenate(b)]), axis=1), axis=0)
        yield pa.record_batch({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    return dealt.mapInArrow(join, "a long, b long").distinct()


def forest(n: int, near) -> Iterator[tuple[int, np.ndarray]]:
    """Links that connect what ``near(i, pool)`` says is near, directly or in steps; each member is linked once."""
    pool = np.arange(n)
    while len(pool):
        queue, pool = [int(pool[0])], pool[1:]
        while queue and len(pool):
            i = queue.pop()
            yes = near(i, pool)
            if yes.any():
                yield i, pool[yes]
                queue += pool[yes].tolist()
                pool = pool[~yes]


def linked(x: np.ndarray, weight: np.ndarray, left: int, cosine: float) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Weights of the links of each row, and a forest of links.

    Links of the first ``left`` rows with the rest count, or of all rows with
    one another if ``left`` is 0.
    """
    x, long = scaled(x)
    links = np.zeros(len(x), dtype=np.int64)
    stop, start = (left, left) if left else (len(x), 0)
    step = max(1, _COSINES // max(1, len(x) - start))
    for i in range(0, stop, step):
        to = min(i + step, stop)
        yes = (x[i:to] @ x[start:].T) / (long[i:to, None] * long[start:]) >= cosine
        if not left:
            yes[np.arange(to - i), np.arange(i, to)] = False
        links[i:to] += yes @ weight[start:]
        if left:
            links[start:] += weight[i:to] @ yes

    def near(k: int, pool: np.ndarray) -> np.ndarray:
        return (x[pool] @ x[k]) / (long[pool] * long[k]) >= cosine

    return links, list(forest(len(x), near))


def verified(rows: DataFrame, leaves: DataFrame, edges: DataFrame, cosine: float = COSINE, unit: int = UNIT) -> DataFrame:
    """``a, b, n``: links of class ``a`` counted in vectors (``b`` null), and edges that connect the linked classes."""
    roots = stored(components(edges), "blocks")
    block = roots.select("node", F.col("root").alias("block")).unionByName(roots.select(F.col("root").alias("node"), F.col("root").alias("block")).distinct())
    member = stored(leaves.join(block, "node").select("leaf", "n", "size", "block"), "members")
    weight = member.groupBy("block").agg(F.sum("size").alias("weight"))
    crowded = stored(weight.filter(F.col("weight") > 2 * unit).select("block", F.ceil(F.col("weight") / unit).cast("int").alias("parts")), "crowded")
    units = int((member.agg(F.sum("size")).first()[0] or 0) // unit) + 1
    part = F.pmod(F.xxhash64("leaf"), "parts").cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda p: F.struct(F.col("block").alias("unit"), F.least("part", p).alias("i"), F.greatest("part", p).alias("j")),
    )
    alone = F.array(F.struct(F.pmod(F.xxhash64("block"), F.lit(units)).alias("unit"), F.lit(-1).alias("i"), F.lit(-1).alias("j")))
    dealt = member.join(crowded, "block", "left").withColumn("part", F.coalesce(part, F.lit(-1)))
    dealt = dealt.select("leaf", "n", "block", "part", F.explode(F.when(F.col("parts").isNull(), alone).otherwise(pairs)).alias("x")).select("leaf", "n", "block", "part", "x.*")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[bytes] = set()
        for batch in batches:
            for _, x, labels, names in _leaves(batch):
                new = [i for i, leaf in enumerate(names) if leaf not in sent and not sent.add(leaf)]
                short = np.float32 if batch.column("vec").type.value_type == pa.float32() else np.float64
                yield pa.record_batch(
                    {"leaf": pa.array([names[i] for i in new], pa.binary()), "label": pa.array([labels[i] for i in new], pa.string()), "vec": pa.array([x[i].astype(short).tobytes() for i in new], pa.binary())}
                )
            if len(sent) > 200_000:
                sent.clear()

    double = rows.schema["vec"].dataType.elementType != T.FloatType()

    def verify(table: pa.Table) -> pa.Table:
        block, part, j = (table.column(c).to_numpy() for c in ("block", "part", "j"))
        leaf, label, vec, n = table.column("leaf").to_pylist(), table.column("label").to_pylist(), table.column("vec").to_pylist(), table.column("n").to_numpy()
        groups: dict[tuple, dict[bytes, int]] = {}
        for r in range(len(leaf)):
            # one row of each class, whatever the number of tasks that sent it
            groups.setdefault((block[r], label[r], len(vec[r])), {}).setdefault(leaf[r], r)
        a, b, count = [], [], []
        for own in groups.values():
            at = sorted(own.values(), key=lambda r: (part[r], leaf[r]))
            one, other = int(table.column("i")[at[0]].as_py()), int(j[at[0]])
            left = int(sum(part[r] == one for r in at)) if one != other else 0
            if len(at) < 2 or (one != other and left in (0, len(at))):
                continue
            x = np.frombuffer(b"".join(vec[r] for r in at), dtype=np.float64 if double else np.float32).astype(np.float64).reshape(len(at), -1)
            links, tree = linked(x, n[at], left, cosine)
            some = np.flatnonzero(links)
            a += [leaf[at[i]] for i in some.tolist()]
            b += [None] * len(some)
            count += links[some].tolist()
            for i, found in tree:
                a += [leaf[at[i]]] * len(found)
                b += [leaf[at[k]] for k in found.tolist()]
                count += [0] * len(found)
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary()), "n": pa.array(count, pa.int64())})

    vectors = rows.mapInArrow(send, "leaf binary, label string, vec binary")
    return vectors.join(dealt, "leaf").groupBy("unit", "i", "j").applyInArrow(verify, "a binary, b binary, n long")


def near_duplicates(
    docs: DataFrame, *, key: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE, crowd: int = CROWD, unit: int = UNIT
) -> DataFrame:
    """``key, n_links, component_id, kept`` of every vector."""
    rows = _usable(docs, key, vector, label)
    named = stored(classes(rows), "classes")
    usable = named.filter("leaf is not null")
    leaves = stored(usable.groupBy("leaf", "node", "size").agg(F.min("key").alias("least"), F.count("*").alias("n")), "leaves")
    found = stored(verified(rows, leaves, stored(candidates(rows, crowd), "candidates"), cosine, unit), "links")
    links = found.filter("b is null").groupBy("a").agg(F.sum("n").alias("links")).withColumnRenamed("a", "leaf")
    roots = components(found.filter("b is not null").select("a", "b")).withColumnRenamed("node", "leaf")
    rooted = leaves.join(roots, "leaf", "left").withColumn("root", F.coalesce("root", "leaf"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    about = rooted.join(least, "root").join(links, "leaf", "left").select("leaf", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    out = usable.join(about, "leaf").select("key", "n_links", "component_id")
    alone = named.filter("leaf is null").select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"))
    return out.unionByName(alone).select(F.col("key").alias(key), "n_links", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))

