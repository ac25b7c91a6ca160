"""Benchmark decontamination: find, report and remove passages of test items.

Items and documents are folded to lower-case words. Every run of ten item
words is a window; an item of fewer words is one window. The windows' hashes
are broadcast in blocks of at most ``block_windows``; documents are scanned by
rolling hashes, and each proposed hit is verified word by word. With more
windows than one block holds, the documents pass one block after the other,
with the hits so far kept in a stored table.

Defined results: null text has no words; null or repeated items and repeated
documents are taken as they are (an item id is reported once); a row with a
null item id marks hits but is not listed; an empty benchmark hits nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlake.llm.words import ALNUM, LOWER, Words, apart, code_points_before, covered, runs, slices, together, window_hashes, windows
from hazardlake.session import stored

WINDOW = 10
#: Windows broadcast at once: about 200 bytes each.
BLOCK_WINDOWS = 200_000
_FILTER_BITS = 20

HIT = "array<struct<item:string,begin:array<int>,length:int>>"
HIT_ARROW = pa.list_(pa.struct([("item", pa.string()), ("begin", pa.list_(pa.int32())), ("length", pa.int32())]))


def item_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Distinct windows: ``hash, length, words, items`` (ids as strings, sorted)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                w = Words(part.column("text"), ALNUM, LOWER)
                hashes = w.hashes()
                ids = part.column("item").to_pylist()
                short = np.flatnonzero((w.counts() > 0) & (w.counts() < window))
                begin = np.concatenate([windows(w.first, window), w.first[short]])
                length = np.concatenate([np.full(len(begin) - len(short), window), w.counts()[short]])
                h = window_hashes(hashes, begin, length)
                yield pa.record_batch(
                    {
                        "hash": pa.array(h.view(np.int64)),
                        "length": pa.array(length.astype(np.int32)),
                        "words": pa.array([w.text(b, b + n).decode() for b, n in zip(begin, length)], pa.string()),
                        "item": pa.array([ids[r] for r in w.row[begin]], pa.string()),
                    }
                )

    rows = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text"))
    return (
        rows.mapInArrow(cut, "hash long, length int, words string, item string")
        .groupBy("hash", "length", "words")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )


class _Block:
    """Windows of one block, looked up by length and hash, compared by words."""

    def __init__(self, rows):
        self.items: dict[tuple[int, int], list[tuple[bytes, list[str]]]] = {}
        by_length: dict[int, set[int]] = {}
        for r in rows:
            h = r["hash"] % 2**64
            self.items.setdefault((r["length"], h), []).append((r["words"].encode(), r["items"]))
            by_length.setdefault(r["length"], set()).add(h)
        self.known = {n: np.sort(np.fromiter(hs, dtype=np.uint64, count=len(hs))) for n, hs in by_length.items()}

    def filters(self) -> dict[int, np.ndarray]:
        out = {}
        for n, known in self.known.items():
            out[n] = np.zeros(1 << _FILTER_BITS, dtype=bool)
            out[n][known >> np.uint64(64 - _FILTER_BITS)] = True
        return out

    def hits(self, w: Words, filters: dict[int, np.ndarray]) -> Iterator[tuple[int, int, list[str]]]:
        """(first word, length, items) of every occurrence."""
        hashes = w.hashes()
        for n, known in self.known.items():
            begin = windows(w.first, n)
            h = window_hashes(hashes, begin, n)
            maybe = np.flatnonzero(filters[n][h >> np.uint64(64 - _FILTER_BITS)])
            place = np.minimum(np.searchsorted(known, h[maybe]), len(known) - 1)
            maybe = maybe[known[place] == h[maybe]]
            for i in maybe:
                words = w.text(begin[i], begin[i] + n)
                for own, items in self.items[n, int(h[i])]:
                    if own == words:
                        yield int(begin[i]), n, items


def _marked(docs: DataFrame, block) -> DataFrame:
    """``docs`` (key columns, ``text``, ``n_words``, ``hits``) with the block's hits appended."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: _Block = block.value
        filters = known.filters()
        for batch in batches:
            for part in slices(batch, "text"):
                w = Words(part.column("text"), ALNUM, LOWER)
                found: dict[int, dict[tuple[str | None, int], list[int]]] = {}
                for begin, n, items in known.hits(w, filters):
                    row = int(w.row[begin])
                    for item in items or [None]:
                        found.setdefault(row, {}).setdefault((item, n), []).append(begin - int(w.first[row]))
                at = part.schema.get_field_index("hits")
                before = part.column(at).to_pylist() if found else None
                if found:
                    for row, own in found.items():
                        before[row] = (before[row] or []) + [{"item": i, "begin": b, "length": n} for (i, n), b in own.items()]
                    hits = pa.array(before, HIT_ARROW)
                else:
                    hits = part.column(at).cast(HIT_ARROW)
                columns = [part.column(c) for c in part.schema.names[:-2]]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(w.counts().astype(np.int64)), hits], names=part.schema.names)

    return docs.mapInArrow(scan, docs.schema)


def find_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """One row per document: ``doc`` (struct of its other columns), ``text``, ``n_words``, ``hits``.

    A hit has the item's id, the word positions at which its windows begin in
    the document, and the windows' length.
    """
    spark = docs.sparkSession
    table = stored(item_windows(benchmark, item, item_text, window), "windows")
    blocks = -(-table.count() // block_windows)
    out = apart(docs, text).select("*", F.lit(0).cast("long").alias("n_words"), F.array().cast(HIT).alias("hits"))
    for k in range(max(1, blocks)):
        rows = table.filter(F.pmod("hash", F.lit(max(1, blocks))) == k).collect()
        out = _marked(out if k == 0 else stored(out, "hits"), spark.sparkContext.broadcast(_Block(rows)))
    return out


def _item_ids(hits: str = "hits"):
    return F.array_sort(F.array_distinct(F.filter(F.transform(hits, lambda h: h["item"]), lambda i: i.isNotNull())))


def _n_hit():
    """Words inside any window: merges the runs of sorted positions."""
    spans = F.array_sort(
        F.flatten(F.transform("hits", lambda h: F.transform(h["begin"], lambda b: F.struct(b.alias("a"), (b + h["length"]).alias("b")))))
    )
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        spans,
        zero,
        lambda s, x: F.struct(
            F.greatest(s["end"], x["b"]).alias("end"),
            (s["n"] + F.greatest(F.lit(0), x["b"] - F.greatest(s["end"], x["a"]))).cast("long").alias("n"),
        ),
        lambda s: s["n"],
    )


def report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``doc_id, n_words, n_hit, items, contaminated`` of every document."""
    return find_hits(docs.select("doc_id", "text"), benchmark, **options).select(
        F.col("doc.doc_id").alias("doc_id"),
        "n_words",
        F.when(F.size("hits") == 0, F.lit(0).cast("long")).otherwise(_n_hit()).alias("n_hit"),
        F.when(F.size("hits") == 0, F.array().cast("array<string>")).otherwise(_item_ids()).alias("items"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", **options) -> DataFrame:
    """The documents, with all their columns, without what the benchmark shares with them.

    ``remove="documents"`` drops documents with a hit, ``"spans"`` cuts the hit
    passages (from the first to the last hit word of each run) out of the text.
    """
    marked = find_hits(docs, benchmark, **options)
    if remove == "documents":
        kept = marked.filter(F.size("hits") == 0)
        return kept.select(*together(docs.columns, options.get("text", "text")))
    if remove != "spans":
        raise ValueError(f"remove is 'documents' or 'spans', not {remove!r}")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for r, hits in enumerate(batch.column("hits").to_pylist()):
                if hits:
                    texts[r] = cut_spans(texts[r], hits)
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(texts, pa.string())], names=["doc", "text"])

    cleaned = marked.select("doc", "text", "hits").mapInArrow(cut, marked.select("doc", "text").schema)
    return cleaned.select(*together(docs.columns, options.get("text", "text")))


def cut_spans(text: str, hits: list[dict]) -> str:
    """The text without the passages of its hits."""
    w = Words(pa.array([text], pa.string()), ALNUM, LOWER)
    begin = np.concatenate([np.asarray(h["begin"], dtype=np.int64) for h in hits])
    length = np.concatenate([np.full(len(h["begin"]), h["length"]) for h in hits])
    points = code_points_before(w.data)
    out, at = [], 0
    for a, b in zip(*runs(covered(begin, length, len(w)))):
        out.append(text[at : points[w.start[a]]])
        at = points[w.end[b - 1]]
    return "".join([*out, text[at:]])
