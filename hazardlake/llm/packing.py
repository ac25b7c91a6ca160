"""Sequence packing: sum-of-squares online packing of token windows.

A document's ids are cut every ``capacity`` ids. Pieces are dealt to shards by
hash; in a shard they are placed online, in the order of the documents: a piece
is placed for good before the next one is seen. Only the number of open windows
per fill level matters, kept in one level array: a piece goes to the
level (or a new window) that leaves the smallest sum of squared counts, which
keeps many different levels open and so finds exact fits. A full window closes.
A shard's work is bounded by its number of documents, and its open windows at
the end are all that is padded: the larger the shard, the smaller their share.

Defined results: a null or empty text is the end id alone; every row is a
document, repeated rows too; sequence ids are unique, not dense; an empty table
gives no pieces. An order within shards (id, start, digest) makes a retry
repeat the same placement.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlake.llm.words import slices

CAPACITY = 2048
END = 1
TOKENIZER = "word_bpe_49k.json"
SHARD_DOCUMENTS = 16384
#: Bytes of text encoded at once: the more, the fewer pieces are looked up twice.
ENCODED_BYTES = 4 << 20
#: Pieces whose ids a worker remembers, and their length; bounds on memory, not on results.
CACHE_PIECES = 500_000
CACHE_CHARS = 40
_ENCODERS: dict[str, Encoder] = {}
# The pieces that the vocabulary's own rule makes of plain lower-case text.
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
_PLAIN = re.compile(r"[\t\n\r\x20-\x7eÀ-ÖØ-öø-ÿ]*")
_SPECIAL = "<|"  # the beginning of a special token's name


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit bytes.

    Tokens of this vocabulary never reach over white space, letters of one word
    stay together, and case is dropped. So texts of plain characters are cut in
    pieces whose ids are remembered; any other text goes through the tokenizer
    whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # the same model for lower-case pieces that are already apart
        self.bare = Tokenizer.from_file(path)
        self.bare.normalizer = normalizers.Sequence([])
        self.bare.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.known: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> Encoder:
        """The worker process's encoder, kept from task to task."""
        if path not in _ENCODERS:
            _ENCODERS[path] = cls(path)
        return _ENCODERS[path]

    def _learn(self, pieces: set[str]) -> None:
        new = list(pieces.difference(self.known))
        if len(self.known) + len(new) > CACHE_PIECES:
            self.known, new = {}, list(pieces)
        for i in range(0, len(new), 2000):
            group = new[i : i + 2000]
            coded = self.bare.encode(" ".join(group), add_special_tokens=False)
            # each piece is one "word" to the bare tokenizer
            cut = (np.searchsorted(np.array(coded.word_ids), np.arange(len(group) + 1)) * 4).tolist()
            ids = np.array(coded.ids, dtype="<u4").tobytes()
            self.known.update((w, ids[a:b]) for w, a, b in zip(group, cut, cut[1:]))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        plain = [t is not None and _PLAIN.fullmatch(t) is not None and _SPECIAL not in t for t in texts]
        split = [_PIECE.findall(t.lower()) if p else [] for t, p in zip(texts, plain)]
        pieces = set().union(*split) if split else set()
        self._learn(pieces)
        ids = self.known.__getitem__
        end = np.array([END], dtype="<u4").tobytes()
        out = [b"".join([*map(ids, w), end]) for w in split]
        for i, (text, p) in enumerate(zip(texts, plain)):
            if text and not p:
                out[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes() + end
        for w in pieces:
            if len(w) > CACHE_CHARS:
                del self.known[w]
        return out


def cut_pieces(docs: DataFrame, *, key: str = "doc_id", text: str = "text", tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """``key, start, length, ids, doc_tokens``: each document's ids in pieces of at most ``capacity``."""
    path = tokenizer or tokenizer_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path)
        for batch in batches:
            for part in slices(batch, "text", ENCODED_BYTES):
                coded = encoder.encode(part.column("text").to_pylist())
                tokens = np.array([len(c) // 4 for c in coded], dtype=np.int64)
                pieces = -(-tokens // capacity)
                row = np.repeat(np.arange(len(coded)), pieces)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * capacity
                length = np.minimum(capacity, tokens[row] - start)
                ids = [coded[r][4 * s : 4 * (s + n)] for r, s, n in zip(row, start, length)]
                yield pa.record_batch(
                    [part.column("key").take(pa.array(row)), pa.array(start), pa.array(length), pa.array(ids, pa.binary()), pa.array(tokens[row])],
                    names=["key", "start", "length", "ids", "doc_tokens"],
                )

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    pieces = rows.mapInArrow(cut, f"key {kind}, start long, length long, ids binary, doc_tokens long")
    return pieces.withColumnRenamed("key", key)


class Levels:
    """Open windows by fill level, and the sum-of-squares choice among them."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.count = np.zeros(capacity + 1, dtype=np.int64)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.made = 0

    def place(self, size: int) -> tuple[int, int]:
        """Window and offset for a piece of ``size``."""
        room = self.capacity - size
        level = 0
        if room:
            # change of the sum of squares if the piece joins a window at level h
            now = self.count[1 : room + 1]
            change = 2 * (self.count[size + 1 :] - now + 1)
            change[-1] = 1 - 2 * now[-1]  # a full window is no longer counted
            change[now == 0] = np.iinfo(np.int64).max
            best = len(change) - 1 - int(np.argmin(change[::-1]))  # of equals the fullest
            if change[best] <= 2 * self.count[size] + 1:
                level = best + 1
        if level:
            window = self.open[level].pop()
            self.count[level] -= 1
        else:
            window, self.made = self.made, self.made + 1
        after = level + size
        if after < self.capacity:
            self.open[after].append(window)
            self.count[after] += 1
        return window, level


def place_pieces(pieces: DataFrame, shards: int, *, key: str = "doc_id", order: tuple[str, ...] = (), capacity: int = CAPACITY) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; other columns ride along.

    ``order`` names columns that tell equal keys and starts apart.
    """
    sort = [key, "start", *order]

    def place(group: pd.DataFrame) -> pd.DataFrame:
        # Online: in the order of the documents, each piece placed for good before the next one is seen.
        group = group.sort_values(sort, kind="stable")
        levels = Levels(capacity)
        placed = [levels.place(int(n)) for n in group["length"]]
        group["sequence_id"] = np.array([w for w, _ in placed], dtype=np.int64) + (group["_shard"].astype("int64").iloc[0] << 32)
        group["offset"] = np.array([o for _, o in placed], dtype=np.int64)
        return group.drop(columns="_shard")

    dealt = pieces.withColumn("_shard", F.pmod(F.xxhash64(*sort), F.lit(shards)).cast("int"))
    out = pieces.withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long")).schema
    return dealt.groupBy("_shard").applyInPandas(place, out)


def shards_for(documents: int, shard_documents: int = SHARD_DOCUMENTS) -> int:
    return max(1, -(-documents // shard_documents))


def sequences(placed: DataFrame, *, key: str = "doc_id", capacity: int = CAPACITY, padding: int = 0) -> DataFrame:
    """Whole training sequences: ``sequence_id, ids, docs, tokens``.

    ``ids`` are little-endian bytes padded to ``capacity`` unless the tokens
    are a power of two; ``docs`` are the pieces in order. A group has at most
    ``capacity`` pieces.
    """
    piece = F.struct("offset", "length", F.col(key).alias("doc"), "start", "ids")
    rows = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(piece)).alias("pieces"), F.sum("length").alias("tokens"))
    whole = F.aggregate("pieces", F.lit(b""), lambda out, p: F.concat(out, p["ids"]))
    pad = F.when(F.expr("bit_count(tokens) = 1"), F.lit(0)).otherwise(F.lit(capacity) - F.col("tokens"))
    filler = F.unhex(F.expr(f"repeat('{np.array([padding], dtype='<u4').tobytes().hex()}', cast({{}} as int))".format("_pad")))
    return rows.withColumn("_pad", pad).select(
        "sequence_id", F.concat(whole, filler).alias("ids"), F.transform("pieces", lambda p: p.dropFields("ids")).alias("docs"), "tokens"
    )
