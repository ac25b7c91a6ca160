"""Repeated-line removal that can be undone: exact reference counts behind sharded cuckoo filters.

A line's key is the line without blanks at its ends, in lower case, as a
128-bit digest. The *reference-count table* holds, for every key, the number of
documents it stands in; documents are added and deleted by adding and
subtracting their keys, so the table after a deletion is the table as if the
documents had never come. *Cuckoo filters*, one per shard of the key space,
hold the keys that reached the threshold, and follow it in both directions:
keys that cross it are inserted or deleted.

Documents are scanned against the filters. A filter may claim a key it does not
hold, so the table's keys below the threshold are looked up once, and those
claimed wrongly are listed as *exceptions*. Since every line of the documents
is in the table, filters and exceptions together answer exactly, and texts are
never shuffled. Filters and exceptions are broadcast only up to a size; beyond
it the frequent keys are joined to the lines instead, with the same result.

Defined results: null and empty texts are one empty line, and stay as they are; empty keys are never
dropped; every row counts as a document, repeated rows too; counting a table
that later changes needs ``add``/``delete`` before the scan.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlake.llm.words import apart, mixed, slices, together
from hazardlake.session import stored

MIN_DOCUMENTS = 10
#: Most keys of one filter, and most bytes of filters and exceptions that are broadcast.
SHARD_KEYS = 16_384
BROADCAST_BYTES = 64 << 20

BLANK = b" \t\n\x0b\x0c\r"
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
SLOTS = 4
MAX_KICKS = 500

FILTER_SCHEMA = "shard int, shards int, slots binary, stash array<binary>"


def key_of(line: bytes) -> bytes | None:
    """128-bit key of a line, None for a blank one."""
    bare = line.strip(BLANK)
    return hashlib.blake2b(bare.translate(LOWER), digest_size=16).digest() if bare else None


# --- reference counts -------------------------------------------------------


def line_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``key, refs``: in how many documents each line key stands."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                seen: Counter[bytes] = Counter()
                for body in part.column("text").to_pylist():
                    if body:
                        seen.update({k for line in body.split(b"\n") if (k := key_of(line))})
                yield pa.record_batch({"key": pa.array(list(seen), pa.binary()), "refs": pa.array(list(seen.values()), pa.int64())})

    rows = docs.select(F.col(text).cast("binary").alias("text")).mapInArrow(count, "key binary, refs long")
    return rows.groupBy("key").agg(F.sum("refs").alias("refs"))


def add(counts: DataFrame, docs: DataFrame, text: str = "text", sign: int = 1) -> DataFrame:
    """The table after documents came."""
    change = line_counts(docs, text).select("key", (F.col("refs") * sign).alias("refs"))
    total = counts.select("key", "refs").unionByName(change).groupBy("key").agg(F.sum("refs").alias("refs"))
    return total.filter("refs != 0")


def delete(counts: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """The table after documents that it counts were deleted."""
    return add(counts, docs, text, sign=-1)


# --- cuckoo filters ---------------------------------------------------------


class CuckooFilter:
    """Fingerprints of 16 bits in buckets of four; supports deletion.

    A key that finds no place after ``MAX_KICKS`` moves is kept whole in the
    stash, so insertion never fails and nothing is forgotten.
    """

    def __init__(self, slots: np.ndarray, stash: set[bytes]):
        self.slots, self.stash = slots, stash

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        buckets = 1 << max(4, int(np.ceil(np.log2(max(1, keys) / (SLOTS * 0.8)))))
        return cls(np.zeros((buckets, SLOTS), dtype=np.uint16), set())

    @classmethod
    def load(cls, slots: bytes, stash: list[bytes]) -> CuckooFilter:
        return cls(np.frombuffer(slots, dtype=np.uint16).reshape(-1, SLOTS).copy(), set(stash))

    def places(self, key: bytes) -> tuple[int, int, int]:
        marks, first, second = places(as_words([key]), np.array([len(self.slots) - 1], dtype=np.uint64))
        return int(marks[0]), int(first[0]), int(second[0])

    def insert(self, key: bytes) -> None:
        mark, first, second = self.places(key)
        for bucket in (first, second):
            free = np.flatnonzero(self.slots[bucket] == 0)
            if len(free):
                self.slots[bucket, free[0]] = mark
                return
        bucket, moved = second, []
        for kick in range(MAX_KICKS):
            slot = kick % SLOTS
            moved.append((bucket, slot, self.slots[bucket, slot]))
            mark, self.slots[bucket, slot] = int(self.slots[bucket, slot]), mark
            bucket = int(np.uint64(bucket) ^ (step(np.array([mark], dtype=np.uint64))[0] & np.uint64(len(self.slots) - 1)))
            free = np.flatnonzero(self.slots[bucket] == 0)
            if len(free):
                self.slots[bucket, free[0]] = mark
                return
        for bucket, slot, before in reversed(moved):
            self.slots[bucket, slot] = before
        self.stash.add(key)

    def delete(self, key: bytes) -> None:
        """Remove a key that was inserted."""
        if key in self.stash:
            self.stash.remove(key)
            return
        mark, first, second = self.places(key)
        for bucket in (first, second):
            at = np.flatnonzero(self.slots[bucket] == mark)
            if len(at):
                self.slots[bucket, at[0]] = 0
                return
        raise KeyError("the filter does not hold this key")

    def row(self, shard: int, shards: int) -> dict:
        return {"shard": shard, "shards": shards, "slots": self.slots.tobytes(), "stash": sorted(self.stash)}


def as_words(keys: list[bytes]) -> np.ndarray:
    """Keys as two unsigned 64-bit numbers each: one names the shard, one the place."""
    return np.frombuffer(b"".join(keys), dtype=np.uint64).reshape(-1, 2)


def step(marks: np.ndarray) -> np.ndarray:
    return mixed(marks + np.uint64(0x9E3779B97F4A7C15))


def places(words: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprint (never 0) and the two buckets of each key."""
    place = words[:, 1]
    marks = (place >> np.uint64(48)) % np.uint64(65535) + np.uint64(1)
    first = place & mask
    return marks, first, first ^ (step(marks) & mask)


class FilterSet:
    """All shards' filters side by side, for looking up many keys at once."""

    def __init__(self, rows):
        rows = sorted(rows, key=lambda r: r["shard"])
        shards = rows[0]["shards"] if rows else 1
        sizes = np.zeros(shards, dtype=np.uint64)
        for r in rows:
            sizes[r["shard"]] = len(r["slots"]) // (2 * SLOTS)
        self.present = sizes > 0
        self.mask = np.where(self.present, sizes - np.uint64(1), np.uint64(0))
        self.base = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.uint64)
        empty = np.zeros((1, SLOTS), dtype=np.uint16)
        self.slots = np.concatenate([np.frombuffer(r["slots"], dtype=np.uint16).reshape(-1, SLOTS) for r in rows] or [empty])
        self.stash = {bytes(k) for r in rows for k in r["stash"]}

    def claims(self, keys: list[bytes]) -> np.ndarray:
        if not keys:
            return np.zeros(0, dtype=bool)
        words = as_words(keys)
        shard = (words[:, 0] % np.uint64(len(self.mask))).astype(np.int64)
        marks, first, second = places(words, self.mask[shard])
        top = np.uint64(len(self.slots) - 1)
        hit = np.zeros(len(keys), dtype=bool)
        for bucket in (first, second):
            hit |= (self.slots[np.minimum(self.base[shard] + bucket, top)] == marks[:, None]).any(axis=1)
        hit &= self.present[shard]
        if self.stash:
            hit |= np.fromiter((k in self.stash for k in keys), dtype=bool, count=len(keys))
        return hit


def _with_shard(keys: DataFrame, shards: int) -> DataFrame:
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("key").to_pylist()
            shard = as_words(found)[:, 0] % np.uint64(shards) if found else np.zeros(0)
            yield batch.append_column("shard", pa.array(np.asarray(shard).astype(np.int32)))

    return keys.select("key").mapInArrow(split, "key binary, shard int")


def build_filters(frequent: DataFrame, shards: int) -> DataFrame:
    """One filter per shard that has keys: ``shard, shards, slots, stash``."""

    def build(keys: pd.DataFrame) -> pd.DataFrame:
        made = CuckooFilter.sized(len(keys))
        for key in sorted(keys["key"]):
            made.insert(bytes(key))
        return pd.DataFrame([made.row(int(keys["shard"].iloc[0]), shards)])

    return _with_shard(frequent, shards).groupBy("shard").applyInPandas(build, FILTER_SCHEMA)


def update_filters(filters: DataFrame, before: DataFrame, after: DataFrame, shards: int, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Filters that follow the table: keys that came up to the threshold go in, those that fell below it out."""
    was = before.filter(F.col("refs") >= min_documents).select("key")
    now = after.filter(F.col("refs") >= min_documents).select("key")
    entered = _with_shard(now.join(was, "key", "left_anti"), shards).withColumn("enters", F.lit(True))
    left = _with_shard(was.join(now, "key", "left_anti"), shards).withColumn("enters", F.lit(False))

    def change(old: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
        shard = int((keys if len(keys) else old)["shard"].iloc[0])
        if len(old):
            made = CuckooFilter.load(old["slots"].iloc[0], [bytes(k) for k in old["stash"].iloc[0]])
        else:
            made = CuckooFilter.sized(len(keys))
        for key in sorted(keys.loc[~keys["enters"].astype(bool), "key"]):
            made.delete(bytes(key))
        for key in sorted(keys.loc[keys["enters"].astype(bool), "key"]):
            made.insert(bytes(key))
        return pd.DataFrame([made.row(shard, shards)])

    moves = entered.unionByName(left)
    return filters.groupBy("shard").cogroup(moves.groupBy("shard")).applyInPandas(change, FILTER_SCHEMA)


# --- scanning ---------------------------------------------------------------


def exceptions(counts: DataFrame, filters, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Keys of the table below the threshold that the filters claim; ``filters`` is a broadcast :class:`FilterSet`."""

    def claimed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_pylist()
            yield batch.filter(pa.array(filters.value.claims(keys)))

    return counts.filter(F.col("refs") < min_documents).select("key").mapInArrow(claimed, "key binary")


def _kept(body: bytes | None, drop) -> tuple[bytes, int, int]:
    lines = (body or b"").split(b"\n")
    flags = drop(lines)
    kept = [line for line, gone in zip(lines, flags) if not gone]
    return b"\n".join(kept), len(lines), len(lines) - len(kept)


def _scan(docs: DataFrame, text: str, filters, wrong) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: FilterSet = filters.value
        not_held: frozenset[bytes] = wrong.value
        for batch in batches:
            for part in slices(batch, "text"):
                bodies = part.column("text").cast(pa.binary()).to_pylist()
                keys = [key_of(line) for body in bodies for line in (body or b"").split(b"\n")]
                real = [k for k in keys if k]
                held = {k for k, hit in zip(real, known.claims(real)) if hit} - not_held
                at = iter(keys)
                kept = [_kept(body, lambda lines: [next(at) in held for _ in lines]) for body in bodies]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc"),
                        pa.array([None if b is None else k[0] for k, b in zip(kept, bodies)], pa.binary()).cast(pa.string()),
                        pa.array([k[1] for k in kept], pa.int64()),
                        pa.array([k[2] for k in kept], pa.int64()),
                    ],
                    names=["doc", "text", "n_lines", "n_dropped"],
                )

    rows = apart(docs, text)
    out = rows.select("doc", "text", F.lit(0).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_dropped")).schema
    return rows.mapInArrow(scan, out)


def _scan_by_join(docs: DataFrame, text: str, frequent: DataFrame) -> DataFrame:
    """The same rows as :func:`_scan`, with the frequent keys joined to the lines."""
    rows = stored(apart(docs, text).select(F.monotonically_increasing_id().alias("at"), "*"), "lines")

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                at, line, key = [], [], []
                for row, body in zip(part.column("at").to_pylist(), part.column("text").cast(pa.binary()).to_pylist()):
                    for n, one in enumerate((body or b"").split(b"\n")):
                        if k := key_of(one):
                            at.append(row), line.append(n), key.append(k)
                yield pa.record_batch({"at": pa.array(at, pa.int64()), "line": pa.array(line, pa.int64()), "key": pa.array(key, pa.binary())})

    hits = rows.select("at", "text").mapInArrow(keys, "at long, line long, key binary").join(frequent.select("key"), "key")
    drop = hits.groupBy("at").agg(F.collect_set("line").alias("drop"))
    lines = F.transform(F.split(F.coalesce("text", F.lit("")), "\n", -1), lambda s, i: F.struct(i.cast("long").alias("i"), s.alias("s")))
    kept = F.filter("lines", lambda x: ~F.array_contains("drop", x["i"]))
    joined = rows.join(drop, "at", "left").withColumn("drop", F.coalesce("drop", F.array().cast("array<bigint>")))
    return joined.withColumn("lines", lines).select(
        "doc",
        F.when(F.col("text").isNotNull(), F.array_join(F.transform(kept, lambda x: x["s"]), "\n")).alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size("drop").cast("long").alias("n_dropped"),
    )


def scan(
    docs: DataFrame,
    counts: DataFrame,
    *,
    text: str = "text",
    min_documents: int = MIN_DOCUMENTS,
    shard_keys: int = SHARD_KEYS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``doc`` (all columns but the text), kept ``text``, ``n_lines``, ``n_dropped`` of every document.

    ``counts`` must be a table that counts these documents; it is read several
    times, so give a stored one.
    """
    spark = docs.sparkSession
    frequent = counts.filter(F.col("refs") >= min_documents)
    n, shards = frequent.count(), 1
    if n * 4 <= broadcast_bytes:  # two bytes a slot, at most a half and four fifths full
        shards = max(1, -(-n // shard_keys))
        filters = spark.sparkContext.broadcast(FilterSet(build_filters(frequent, shards).collect()))
        wrong = stored(exceptions(counts, filters, min_documents), "exceptions")
        if wrong.count() * 100 <= broadcast_bytes:
            held = frozenset(bytes(r["key"]) for r in wrong.collect())
            return _scan(docs, text, filters, spark.sparkContext.broadcast(held))
    return _scan_by_join(docs, text, frequent)


def drop_repeated_lines(docs: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """:func:`scan` of documents against the counts of their own lines."""
    return scan(docs, stored(line_counts(docs, text), "line-counts"), text=text, **options)


def clean(docs: DataFrame, *, text: str = "text", chars: str = "n_chars", **options) -> DataFrame:
    """The documents with all their columns, repeated lines gone, and ``chars`` (if there) counting what is left."""
    rows = drop_repeated_lines(docs, text=text, **options)
    kind = dict(docs.dtypes).get(chars)
    if kind not in ("int", "bigint"):
        return rows.select(*together(docs.columns, text))
    left = F.when(F.col("n_dropped") == 0, F.col("doc").getField(chars)).otherwise(F.char_length("text").cast(kind))
    return rows.select(*together(docs.columns, text, **{chars: left}))
