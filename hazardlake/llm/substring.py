"""Repeated-passage removal: k-mers of words as edges, repeated paths compacted and verified at their source.

Every run of ``window`` words is an edge of the de Bruijn graph of the corpus,
named by a hash of ``bits`` bits. An edge that starts in several documents is
repeated; its source is the smallest document that has it, and it is to be
removed everywhere else.

1. *Edges.* A task deduplicates the edges of its documents (a document that is
   not the smallest with an edge is decided on the spot) and sends each edge
   once, packed in byte arrays, to the hash's bucket. So an edge that a third of
   all documents share arrives once per task.
2. *Joins.* A bucket finds the edges that several documents sent. Its answers,
   to the documents that lose an edge and to the sources, are grouped by
   document and joined to the documents, which are shuffled once.
3. *Paths.* In a document, consecutive repeated edges with one source form a
   nonbranching path; a path is one span.
4. *Verification.* Every word of a path is covered by edges (each ``window``-th
   and the last) whose second, independent hash must be found at the source.
   Edges that fail name different passages with equal first hashes: they are
   looked at again, alone, under another seed, until none fails.

Defined results: words are runs of non-blanks; null, empty and short texts lose
nothing and their words are joined by one space like all others; rows with equal
ids are one document; rows with a null id neither lose words nor count as
sources; windows are judged on the input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlake.llm.words import NOT_BLANK, Words, apart, covered, slices, window_hashes, windows
from hazardlake.session import stored

WINDOW = 13
BITS = 56
#: Bytes of text whose edges share a bucket: about twenty bytes of memory for each of its words.
BUCKET_BYTES = 10 << 20
#: Bytes of text whose edges are deduplicated and sent together.
SENT_BYTES = 2 << 20
#: Failed hashes that are broadcast for another look; with more, the search begins again with longer hashes.
MAX_FAILED = 1_000_000

PACKED = "bucket int, ids binary, counts binary, edges binary, sources binary"


def _edges(w: Words, window: int, seed: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Where edges start, and their hashes."""
    begin = windows(w.first, window)
    return begin, window_hashes(w.hashes(seed), begin, window, seed) & np.uint64(2**bits - 1)


def _narrow(values: np.ndarray, bits: int) -> bytes:
    """Unsigned numbers in as few bytes as they need, the first bytes of all, then the second bytes, and so on."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : -(-bits // 8)].T.tobytes()


def _wide(packed: bytes, bits: int) -> np.ndarray:
    width = -(-bits // 8)
    out = np.zeros((len(packed) // width, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(packed, dtype=np.uint8).reshape(width, -1).T
    return out.reshape(-1).view("<u8")


def _changes(values: np.ndarray) -> np.ndarray:
    """Which values begin a run of equal ones."""
    out = np.ones(len(values), dtype=bool)
    out[1:] = values[1:] != values[:-1]
    return out


def _starts(values: np.ndarray) -> np.ndarray:
    return np.flatnonzero(_changes(values))


def _sources(edge: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For every entry, the smallest document with its edge."""
    if not len(edge):
        return doc
    order = np.argsort(edge)
    at = _starts(edge[order])
    out = np.empty_like(doc)
    out[order] = np.repeat(np.minimum.reduceat(doc[order], at), np.diff(np.append(at, len(order))))
    return out


def _pack(bucket: np.ndarray, doc: np.ndarray, edge: np.ndarray, source: np.ndarray | None, bits: int) -> pa.RecordBatch:
    """One row per bucket, with its entries in the order of the texts."""
    order = np.argsort(bucket.astype(np.uint16) if bucket.max() < 1 << 16 else bucket, kind="stable")
    bucket, doc, edge = bucket[order], doc[order], edge[order]
    source = None if source is None else source[order]
    rows: dict[str, list] = {"bucket": [], "ids": [], "counts": [], "edges": [], "sources": []}
    edges_of = np.append(_starts(bucket), len(bucket))
    for a, b in zip(edges_of, edges_of[1:]):
        at = _starts(doc[a:b])
        ids = doc[a:b][at]
        rows["bucket"].append(bucket[a])
        # differences from id to id, the first one whole
        rows["ids"].append(_narrow(np.diff(ids, prepend=0).view(np.uint64), 64))
        rows["counts"].append(_narrow(np.diff(np.append(at, b - a)), 32))
        rows["edges"].append(_narrow(edge[a:b], bits))
        rows["sources"].append(None if source is None else _narrow(source[a:b].view(np.uint64), 64))
    return pa.record_batch([pa.array(rows["bucket"], pa.int32()), *[pa.array(rows[c], pa.binary()) for c in list(rows)[1:]]], names=list(rows))


def _unpack(row: dict, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    ids = np.cumsum(_wide(row["ids"], 64).view(np.int64))
    doc = np.repeat(ids, _wide(row["counts"], 32).astype(np.int64))
    return doc, _wide(row["edges"], bits), None if row["sources"] is None else _wide(row["sources"], 64).view(np.int64)


def packed_edges(docs: DataFrame, *, seed: int, bits: int, buckets: int, window: int, only=None) -> DataFrame:
    """Edges of ``docs`` (``doc_id``, ``text``) by bucket; with ``only`` (seeds, bits and hashes) just those that failed before."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SENT_BYTES):
                w = Words(part.column("text"), NOT_BLANK)
                begin, edge = _edges(w, window, seed, bits)
                if only is not None:
                    chosen = np.zeros(len(edge), dtype=bool)
                    for before, before_bits, hashes in only.value:
                        chosen |= np.isin(_edges(w, window, before, before_bits)[1], hashes)
                    begin, edge = begin[chosen], edge[chosen]
                if not len(edge):
                    continue
                doc = part.column("doc_id").to_numpy()[w.row[begin]]
                source = _sources(edge, doc)
                lost = doc > source
                bucket = (edge % np.uint64(buckets)).astype(np.int32)
                yield _pack(bucket[~lost], doc[~lost], edge[~lost], None, bits)
                if lost.any():
                    yield _pack(bucket[lost], doc[lost], edge[lost], source[lost], bits)

    return docs.mapInArrow(pack, PACKED)


def answers(packed: DataFrame, bits: int, groups: int) -> DataFrame:
    """Packed by group of documents (``bucket``): the edges that documents lose with their sources, and the edges they are the source of (without)."""

    def match(table: pa.Table) -> pa.Table:
        rows = [_unpack(r, bits) for r in table.select(["ids", "counts", "edges", "sources"]).to_pylist()]
        sent = [r for r in rows if r[2] is None]
        decided = [r for r in rows if r[2] is not None]
        doc = np.concatenate([np.zeros(0, dtype=np.int64), *[r[0] for r in sent]])
        edge = np.concatenate([np.zeros(0, dtype=np.uint64), *[r[1] for r in sent]])
        source = _sources(edge, doc)
        lost = doc > source
        target = np.concatenate([doc[lost], *[r[0] for r in decided]])
        loses = np.concatenate([edge[lost], *[r[1] for r in decided]])
        come_from = np.concatenate([source[lost], *[r[2] for r in decided]])
        parts = []
        if len(target):
            by_doc = np.argsort(target, kind="stable")
            target, loses, come_from = target[by_doc], loses[by_doc], come_from[by_doc]
            parts.append(_pack(np.mod(target, groups).astype(np.int32), target, loses, come_from, bits))
            order = np.lexsort((loses, come_from))
            once = order[_changes(come_from[order]) | _changes(loses[order])]
            parts.append(_pack(np.mod(come_from[once], groups).astype(np.int32), come_from[once], loses[once], None, bits))
        return pa.Table.from_batches(parts, schema=_PACKED_ARROW)

    return packed.groupBy("bucket").applyInArrow(match, PACKED)


_PACKED_ARROW = pa.schema([("bucket", pa.int32()), *[(c, pa.binary()) for c in ("ids", "counts", "edges", "sources")]])


SPAN = pa.struct([("start", pa.int32()), ("words", pa.int32()), ("source", pa.int64())])
CHECK = ("round", "doc", "edge", "second")


def _check_lists(rows: list[list[tuple]]) -> pa.ListArray:
    """Per row, (round, doc, edge, second) of the edges in its groups of arrays."""
    groups = [(n, d, e.view(np.int64), x.view(np.int64)) for row in rows for n, d, e, x in row]
    none = np.zeros(0, dtype=np.int64)
    numbers = np.concatenate([none, *[np.full(len(d), n) for n, d, _, _ in groups]]).astype(np.int32)
    columns = [pa.array(numbers), *[pa.array(np.concatenate([none, *[g[i] for g in groups]])) for i in (1, 2, 3)]]
    sizes = np.cumsum([0, *[sum(len(g[1]) for g in row) for row in rows]]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(sizes), pa.StructArray.from_arrays(columns, names=list(CHECK)))


class _Round:
    """One look at the edges: the hash it used and the hashes that it cannot tell apart."""

    def __init__(self, number: int, bits: int, failed: np.ndarray):
        self.number, self.bits, self.failed = number, bits, failed


class _Answers:
    """What one round found for the documents of a group."""

    def __init__(self, look: _Round, rows: list[dict]):
        self.look = look
        found = [_unpack(r, look.bits) for r in rows]
        self.lost = self._by_id([(d, e, s) for d, e, s in found if s is not None])
        self.wanted = self._by_id([(d, e, d) for d, e, s in found if s is None])

    @staticmethod
    def _by_id(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        doc = np.concatenate([np.zeros(0, dtype=np.int64), *[p[0] for p in parts]])
        edge = np.concatenate([np.zeros(0, dtype=np.uint64), *[p[1] for p in parts]])
        source = np.concatenate([np.zeros(0, dtype=np.int64), *[p[2] for p in parts]])
        order = np.lexsort((edge, doc))
        return doc[order], edge[order], source[order]

    @staticmethod
    def _of(table: tuple, doc_id: int) -> tuple[np.ndarray, np.ndarray]:
        doc, edge, source = table
        a, b = np.searchsorted(doc, [doc_id, doc_id + 1])
        return edge[a:b], source[a:b]

    def concerns(self, doc_id: int) -> bool:
        return bool(len(self._of(self.lost, doc_id)[0]) or len(self._of(self.wanted, doc_id)[0]))

    def repeated(self, edge: np.ndarray, doc_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Which of a text's edges are repeated, and their sources."""
        lost, source = self._of(self.lost, doc_id)
        if not len(lost):
            return np.zeros(len(edge), dtype=bool), np.zeros(len(edge), dtype=np.int64)
        at = np.minimum(np.searchsorted(lost, edge), len(lost) - 1)
        hit = lost[at] == edge
        if len(self.look.failed):
            hit &= ~np.isin(edge, self.look.failed)
        return hit, source[at]

    def asked(self, edge: np.ndarray, doc_id: int) -> np.ndarray:
        return np.isin(edge, self._of(self.wanted, doc_id)[0])


def _paths(begin: np.ndarray, hit: np.ndarray, source: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last+1 index of each run of repeated edges with one source."""
    at = np.flatnonzero(hit)
    if not len(at):
        return at, at
    breaks = np.flatnonzero((np.diff(at) != 1) | (source[at[1:]] != source[at[:-1]]))
    return at[np.concatenate([[0], breaks + 1])], at[np.concatenate([breaks, [len(at) - 1]])] + 1


def _squeezed(rows: DataFrame) -> DataFrame:
    """``text`` compressed, with its ``size``: what is shuffled is a third smaller than with Spark's own compression."""

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text").cast(pa.binary()).to_pylist()
                packed = [t and pa.compress(t, codec="zstd", asbytes=True) for t in texts]
                columns = {c: part.column(c) for c in part.schema.names if c != "text"}
                columns |= {"text": pa.array(packed, pa.binary()), "size": pa.array([len(t or b"") for t in texts], pa.int64())}
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    others = [c for c in rows.columns if c != "text"]
    return rows.mapInArrow(squeeze, rows.select(*others, F.col("text").cast("binary"), F.lit(0).cast("long").alias("size")).schema)


def _cut(text: bytes, doc_id: int, found: list[_Answers], window: int):
    """Kept words, counts, spans, what must hold at the sources, and what holds here."""
    w = Words(pa.array([text], pa.binary()), NOT_BLANK)
    words = text.split()
    gone = np.zeros(len(w), dtype=bool)
    spans, checks, holds = [], [], []
    # after a failure every edge is verified: paths without the failed ones begin elsewhere
    step = window if len(found) == 1 else 1
    for answer in found:
        if not answer.concerns(doc_id):
            continue
        look = answer.look
        begin, edge = _edges(w, window, look.number, look.bits)
        hit, source = answer.repeated(edge, doc_id)
        first, last = _paths(begin, hit, source)
        second = window_hashes(w.hashes(look.number + 500), begin, window, look.number + 500)
        if len(first):
            gone |= covered(begin[hit], window, len(w))
            spans += [{"start": int(begin[a]), "words": int(b - a + window - 1), "source": int(source[a])} for a, b in zip(first, last)]
            picks = np.unique(np.concatenate([[*range(a, b, step), b - 1] for a, b in zip(first, last)]))
            checks.append((look.number, source[picks], edge[picks], second[picks]))
        mine = answer.asked(edge, doc_id)
        if mine.any():
            holds.append((look.number, np.full(int(mine.sum()), doc_id, dtype=np.int64), edge[mine], second[mine]))
    kept = b" ".join(compress(words, (~gone).tolist()))
    return kept, len(words), int(gone.sum()), spans, checks, holds


def _apply(docs: DataFrame, found: DataFrame, looks: list[_Round], window: int) -> DataFrame:
    """The documents of each group beside the answers for it."""

    def cut(docs: pa.Table, answers: pa.Table) -> pa.Table:
        sent = answers.to_pylist()
        rounds = [_Answers(look, [r for r in sent if r["round"] == look.number]) for look in looks]
        concerned = np.unique(np.concatenate([t[0] for r in rounds for t in (r.lost, r.wanted)]))
        out = []
        for packed, size, doc_id in zip(*(docs.column(c).to_pylist() for c in ("text", "size", "_key"))):
            text = pa.decompress(packed, size, codec="zstd", asbytes=True) if size else b""
            at = len(concerned) if doc_id is None else int(np.searchsorted(concerned, doc_id))
            if text and at < len(concerned) and concerned[at] == doc_id:
                out.append(_cut(text, doc_id, rounds, window))
            else:
                words = text.split()
                out.append((b" ".join(words), len(words), 0, [], [], []))
        return pa.table(
            [
                docs.column("doc"),
                pa.array([o[0] for o in out], pa.binary()).cast(pa.string()),
                pa.array([o[1] for o in out], pa.int64()),
                pa.array([o[2] for o in out], pa.int64()),
                pa.array([o[3] for o in out], pa.list_(SPAN)),
                _check_lists([o[4] for o in out]),
                _check_lists([o[5] for o in out]),
            ],
            names=["doc", "text", "n_words", "n_removed", "spans", "checks", "holds"],
        )

    check = "array<struct<round:int,doc:bigint,edge:bigint,second:bigint>>"
    more = {"n_words": "long", "n_removed": "long", "spans": "array<struct<start:int,words:int,source:bigint>>", "checks": check, "holds": check}
    schema = docs.select("doc", F.lit("").alias("text"), *[F.lit(None).cast(t).alias(c) for c, t in more.items()]).schema
    return docs.groupBy("_group").cogroup(found.groupBy("bucket")).applyInArrow(cut, schema)


def _prime(n: int) -> int:
    """The smallest prime that is not below n, so that no step from id to id favours a group."""
    while any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def remove_repeats(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    bits: int = BITS,
    bucket_bytes: int = BUCKET_BYTES,
    project: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """``doc`` (all columns but the text), kept ``text``, ``n_words``, ``n_removed``, ``spans`` of every document.

    The result is a stored table; ``project`` may replace its columns (but for
    ``checks`` and ``holds``) before it is written. ``key`` is an integer column.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).filter("doc_id is not null and text is not null")
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = _prime(max(7, -(-size // bucket_bytes)))
    rows = apart(docs, text).withColumn("_key", F.col("doc").getField(key).cast("long"))
    rows = rows.withColumn("_group", F.coalesce(F.pmod("_key", F.lit(buckets)), F.pmod(F.xxhash64("text"), F.lit(buckets))).cast("int"))
    looks: list[_Round] = []
    found: DataFrame | None = None
    only = None
    while True:
        number, width = len(looks), bits if not looks else 63
        edges = packed_edges(source, seed=number, bits=width, buckets=buckets, window=window, only=only)
        one = answers(edges, width, buckets).withColumn("round", F.lit(number))
        found = one if found is None else found.unionByName(one)
        looks.append(_Round(number, width, np.zeros(0, dtype=np.uint64)))
        done = stored(project(_apply(_squeezed(rows), found, looks, window)), "passages")
        proof = F.xxhash64("round", "doc", "edge", "second").alias("proof")
        needed = done.select(F.explode("checks").alias("c")).select("c.*").select("round", "edge", proof).distinct()
        here = done.select(F.explode("holds").alias("c")).select("c.*").select(proof)
        failed = stored(needed.join(here, "proof", "left_anti").select("round", "edge").distinct(), "failed")
        count = failed.count()
        if not count:
            return done.drop("checks", "holds")
        if count > MAX_FAILED and bits < 63:  # too short for so many passages: begin again with the longest
            return remove_repeats(docs, key=key, text=text, window=window, bits=63, bucket_bytes=bucket_bytes, project=project)
        new: dict[int, list[int]] = {}
        for r in failed.collect():
            new.setdefault(r["round"], []).append(r["edge"])
        again = [(n, looks[n].bits, np.sort(np.array(edges, dtype=np.int64).view(np.uint64))) for n, edges in new.items()]
        for n, _, hashes in again:
            looks[n].failed = np.union1d(looks[n].failed, hashes)
        only = spark.sparkContext.broadcast(again)
