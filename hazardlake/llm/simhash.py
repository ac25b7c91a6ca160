"""SimHash near-duplicates: fingerprints joined by walking a binary trie against itself.

Fingerprints are the leaves of a binary trie. Walking pairs of its nodes
together, a pair's error is the number of bits in which the two paths differ;
a pair whose error exceeds the budget is dropped with everything below it, and
pairs that reach the leaves are links.

To deal the walk out, the trie is built five times, each time with another
fifth of the bits on top: two fingerprints that differ in at most four bits
agree in one of the fifths, so the walk for that trie may start with no error
in its top levels. Each subtrie below the top levels is one unit of work. A
subtrie with more than ``subtrie`` leaves is cut in parts whose pairs are units
of their own. Equal fingerprints are one leaf, and a unit reports a spanning
forest of its links, not every pair, so its output never exceeds its leaves.

Groups are the connected components of the links, found by star contraction
over stored edge tables.

Defined results: a text without words (null, empty, blank) has fingerprint 0
and is linked like any other; repeated rows are grouped with themselves; a
group's id is its smallest id (nulls only count if there is nothing else).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlake.llm.words import slices
from hazardlake.session import stored

WORDS = 4
SEED = 42
BITS = 4
#: Leaves of one unit of work.
SUBTRIE = 20_000
#: Node pairs walked at once, and leaves laid out at once; they bound a task's memory.
FRONTIER = 1 << 18
LAYOUT = 1 << 17

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_HASHES_AT_ONCE = 1 << 15


def shingles(text: bytes | None, words: int = WORDS, seed: int = SEED) -> Iterator[np.ndarray]:
    """XXH64 hashes of the shingles, a bounded number at once; a shorter text is one shingle."""
    from xxhash import xxh64_intdigest

    split = (text or b"").translate(LOWER).split()
    if not split:
        return
    line = b" ".join(split)
    end = np.cumsum([len(w) + 1 for w in split]) - 1
    start = np.concatenate([[0], end[:-1] + 1])
    cut = max(0, min(words, len(split)) - 1)
    starts, ends = start[: len(split) - cut].tolist(), end[cut:].tolist()
    for i in range(0, len(starts), _HASHES_AT_ONCE):
        h = [xxh64_intdigest(line[a:b], seed) for a, b in zip(starts[i : i + _HASHES_AT_ONCE], ends[i : i + _HASHES_AT_ONCE])]
        yield np.array(h, dtype="<u8")


def majority(hashes: np.ndarray) -> tuple[np.ndarray, int]:
    """How many of the hashes have each bit, and how many there are."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64), len(hashes)


def fingerprint(text: bytes | None, words: int = WORDS, seed: int = SEED) -> int:
    """Majority of the bits of the shingles' XXH64 hashes."""
    ones, n = np.zeros(64, dtype=np.int64), 0
    for h in shingles(text, words, seed):
        some, m = majority(h)
        ones, n = ones + some, n + m
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, fingerprint`` (a long with the 64 bits) of every document."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                marks = np.array([fingerprint(t) for t in part.column("text").to_pylist()], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(marks.view(np.int64))], names=["key", "fingerprint"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text"))
    marked = rows.mapInArrow(mark, f"key {rows.schema['key'].dataType.simpleString()}, fingerprint long")
    return marked.withColumnRenamed("key", key)


# --- the walk ---------------------------------------------------------------


class Components:
    """Connected components of numbered leaves; links may be added bit by bit."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            if not apart.any():
                return
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


def walk(leaves: np.ndarray, pairs: np.ndarray, budget: int = BITS, top: int = 0) -> np.ndarray:
    """Component (smallest member's number) of each leaf under the links found from ``pairs``.

    ``leaves`` are distinct and sorted within each of the ranges that ``pairs``
    names, as rows ``(a_lo, a_hi, b_lo, b_hi)``; equal ranges join a trie with itself.
    The first ``top`` bits are the same within a pair.
    """
    found = Components(len(leaves))
    ones: dict[int, np.ndarray] = {}

    def before(bit: int) -> np.ndarray:
        if bit not in ones:
            ones[bit] = np.concatenate([[0], np.cumsum((leaves >> np.uint64(bit)) & np.uint64(1), dtype=np.int32)])
        return ones[bit]

    todo = [(63 - top, np.column_stack([pairs, np.zeros(len(pairs), dtype=np.int64)]))]
    while todo:
        bit, front = todo.pop()
        if len(front) > FRONTIER:
            todo += [(bit, front[i : i + FRONTIER]) for i in range(0, len(front), FRONTIER)]
            continue
        a, b, c, d, err = front.T
        single = (b - a == 1) & (d - c == 1)
        if single.any():
            i, j = a[single], c[single]
            near = np.bitwise_count(leaves[i] ^ leaves[j]) <= budget
            found.add(i[near], j[near])
            a, b, c, d, err = front[~single].T
        if not len(a):
            continue
        # leaves already in one component need no further walk
        root = found.root
        if len(a) > 64:
            joined = (root[a] == root[c]) & (root[b - 1] == root[d - 1]) & (root[a] == root[b - 1]) & (b - a <= 2) & (d - c <= 2)
            if joined.any():
                a, b, c, d, err = a[~joined], b[~joined], c[~joined], d[~joined], err[~joined]
        sums = before(bit)
        m = b - (sums[b] - sums[a])
        n = d - (sums[d] - sums[c])
        same = (a == c) & (b == d)
        children = np.concatenate(
            [
                np.column_stack([a, m, c, n, err]),
                np.column_stack([m, b, n, d, err]),
                np.column_stack([a, m, n, d, err + 1]),
                np.column_stack([m, b, c, n, err + 1])[~same],
            ]
        )
        lo, hi, x, y, e = children.T
        alive = (hi > lo) & (y > x) & (e <= budget) & ~((lo == x) & (hi - lo == 1) & (y - x == 1))
        if alive.any():
            todo.append((bit - 1, children[alive]))
    return found.root


def _blocks(budget: int) -> list[int]:
    """Sizes of ``budget + 1`` nearly equal blocks of the 64 bits."""
    n = budget + 1
    return [64 // n + (i < 64 % n) for i in range(n)]


def links(marks: DataFrame, budget: int = BITS, subtrie: int = SUBTRIE) -> DataFrame:
    """Edges ``a, b`` that connect exactly the distinct fingerprints within ``budget`` bits of each other, directly or in steps."""
    sizes = _blocks(budget)
    shift = [sum(sizes[:i]) for i in range(len(sizes))]
    turned = [
        F.struct(
            F.lit(i).alias("turn"),
            (F.shiftleft("fingerprint", s).bitwiseOR(F.shiftrightunsigned("fingerprint", 64 - s)) if s else F.col("fingerprint")).alias("leaf"),
        )
        for i, s in enumerate(shift)
    ]
    leaves = marks.select(F.explode(F.array(*turned)).alias("x")).select("x.turn", "x.leaf")
    top = F.element_at(F.array(*[F.shiftrightunsigned("leaf", 64 - n) for n in sizes]), F.col("turn") + 1)
    leaves = leaves.select("turn", top.alias("top"), "leaf")
    crowded = stored(
        leaves.groupBy("turn", "top").count().filter(F.col("count") > subtrie).select("turn", "top", F.ceil(F.col("count") / subtrie).cast("int").alias("parts")),
        "crowded",
    )
    if crowded.isEmpty():
        units = leaves.select("turn", "top", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("side"), "leaf")
    else:
        part = F.pmod(F.xxhash64("leaf"), "parts").cast("int")
        pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: F.struct(F.least("part", p).alias("i"), F.greatest("part", p).alias("j")))
        units = (
            leaves.join(crowded, ["turn", "top"], "left")
            .withColumn("parts", F.coalesce("parts", F.lit(1)))
            .withColumn("part", part)
            .withColumn("pair", F.explode(pairs))
            .select("turn", "top", "pair.i", "pair.j", (F.col("part") > F.col("pair.i")).cast("int").alias("side"), "leaf")
        )
    common = min(sizes)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts)
        turn, head, i, j, side = (table.column(c).to_numpy().astype(np.int64) for c in ("turn", "top", "i", "j", "side"))
        leaf = table.column("leaf").to_numpy().view(np.uint64)
        order = np.lexsort((leaf, side, j, i, head, turn))
        key = np.column_stack([turn, head, i, j])[order]
        side, leaf = side[order], leaf[order]
        first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)]))
        edge = np.append(first, len(leaf))
        at = 0
        while at < len(first):
            stop = max(at + 1, int(np.searchsorted(edge, edge[at] + LAYOUT, "right")) - 1)
            lo, hi = edge[at:stop], edge[at + 1 : stop + 1]
            base = edge[at]
            here, sides = leaf[base : edge[stop]], side[base : edge[stop]]
            ones = np.concatenate([[0], np.cumsum(sides)])
            lo, hi = lo - base, hi - base
            mid = hi - (ones[hi] - ones[lo])
            diagonal = key[first[at:stop], 2] == key[first[at:stop], 3]
            ranges = np.column_stack([lo, np.where(diagonal, hi, mid), np.where(diagonal, lo, mid), hi])
            ranges = ranges[(ranges[:, 1] > ranges[:, 0]) & (ranges[:, 3] > ranges[:, 2]) & (~diagonal | (hi - lo > 1))]
            root = walk(here, ranges, budget, common)
            linked = np.flatnonzero(root != np.arange(len(root)))
            if len(linked):
                turns = key[base : edge[stop], 0][linked]
                back = np.array(shift, dtype=np.uint64)[turns]
                ends = []
                for v in (here[linked], here[root[linked]]):
                    low = np.where(back == 0, v, v << ((np.uint64(64) - back) % np.uint64(64)))
                    ends.append(np.where(back == 0, v, (v >> back) | low).view(np.int64))
                yield pa.record_batch({"a": pa.array(ends[0]), "b": pa.array(ends[1])})
            at = stop

    dealt = units.repartition("turn", "top", "i", "j")
    return dealt.mapInArrow(join, "a long, b long").distinct()


# --- groups -----------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every end of an edge; the root is the component's smallest node.

    Alternates large stars (every neighbour above a node moves to the smallest
    around it) and small stars (every neighbour below it does), which only ever
    rewires, until nothing changes. Each round's edges are a stored table.
    """

    def large(e: DataFrame) -> DataFrame:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()

    def small(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return moved.unionByName(least.select("a", F.col("m").alias("b"))).filter("a != b").distinct()

    def digest(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    now = stored(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = digest(now)
    while True:
        now = stored(small(large(now)), "edges")
        new = digest(now)
        if new == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = new


def _classes(marked: DataFrame, key: str, budget: int, subtrie: int) -> DataFrame:
    """``fingerprint, component_id``: each fingerprint's group."""
    leaves = stored(marked.groupBy("fingerprint").agg(F.min(key).alias("_least")), "leaves")
    roots = components(links(leaves.select("fingerprint"), budget, subtrie))
    rooted = leaves.join(roots, leaves["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "_least", F.coalesce("root", "fingerprint").alias("_root")
    )
    least = rooted.groupBy("_root").agg(F.min("_least").alias("component_id"))
    return rooted.join(least, "_root").select("fingerprint", "component_id")


def groups(docs: DataFrame, *, key: str = "doc_id", text: str = "text", budget: int = BITS, subtrie: int = SUBTRIE) -> DataFrame:
    """``key, fingerprint, component_id`` of every document."""
    marked = stored(fingerprints(docs, key=key, text=text), "fingerprints")
    classes = _classes(marked, key, budget, subtrie)
    return marked.join(classes, "fingerprint").select(key, "fingerprint", "component_id")

