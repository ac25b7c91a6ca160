"""Cross-tokenizer alignment: which tokens of one tokenizer cover the same bytes as which of another.

Both id lists of a text cover the same bytes. Their cumulative ends are put in
dictionaries from end to index; the ends in both, sorted, cut the lists into
groups, and within each group the token pairs whose byte ranges overlap are
expanded to links.

Counts of id pairs over the corpus: documents are encoded once into chunks, a
chunk holding its distinct pairs and, for each document, the places of its
links among them. The pairs are summed over all chunks and the sums travel back
to the chunks. Nothing but distinct pairs per chunk is shuffled beside the
chunks themselves, and a pair has one row a chunk at most.

Defined results: null and empty texts, and texts that either tokenizer does not
give back byte for byte, have no tokens: zeros and an empty digest; every row
is a document, repeated rows too; an empty table gives no rows. A text that
holds a special token's name is plain text.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlake.llm.words import slices
from hazardlake.session import stored

BYTE_LEVEL = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
#: Links of one chunk, about; bounds a task's memory.
CHUNK_LINKS = 1_500_000
_ALIGNERS: dict[tuple[str, str], Aligner] = {}
# How the byte-level vocabulary cuts a text into words before it merges bytes.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Texts of letters whose classes are the same in every Unicode version, and without words of extreme length.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-\u024f\u0391-\u03a1\u03a3-\u03ff\u0410-\u044f\u2013\u2014\u2018-\u201e\u2026]*")
_ENDLESS = re.compile(r"\S{500}")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary, turned round: printable ones for themselves, the rest from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """Ids and token bytes of a byte-level BPE.

    A vocabulary whose ids follow its merges is read as ranks by a faster
    encoder, for texts on whose word borders the two libraries cannot differ;
    the rest goes through the tokenizer itself.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        letters, vocabulary = byte_letters(), self.model.get_vocab(with_added_tokens=False)
        self.bytes = [b""] * self.model.get_vocab_size(with_added_tokens=True)
        for token, i in vocabulary.items():
            if all(c in letters for c in token):
                self.bytes[i] = bytes(letters[c] for c in token)
        described = json.loads(self.model.to_str())
        merges = [m.split(" ") if isinstance(m, str) else m for m in described["model"]["merges"]]
        before = described["pre_tokenizer"]
        ranked = (
            all(vocabulary.get(x + y) == 256 + i for i, (x, y) in enumerate(merges))
            and {len(x) for x in self.bytes[:256]} == {1}
            and not described["normalizer"]
            and (before["type"], before["add_prefix_space"], before.get("use_regex", True)) == ("ByteLevel", False, True)
        )
        ranks = {x: i for i, x in enumerate(self.bytes[: 256 + len(merges)])}
        self.quick = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}) if ranked else None

    def encode(self, text: str) -> list[int]:
        if self.quick and _PLAIN.fullmatch(text) and not _ENDLESS.search(text):
            return self.quick.encode_ordinary(text)
        return self.model.encode(text, add_special_tokens=False).ids


class Pieces:
    """Ids and token bytes of a piece model that puts a blank before a text by itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text)


class Alignment:
    """Aligned texts: ids of both sides end to end, their groups and links.

    ``first_a[r]`` tokens of A stand before row ``r``, likewise ``first_b``,
    ``first_group`` and ``first_link``; ``until_a[k]`` tokens of A stand before
    the end of group ``k``.
    """

    def __init__(self, a: list[list[int]], b: list[list[int]], sizes_a: np.ndarray, sizes_b: np.ndarray):
        self.a, self.b = (np.fromiter(chain.from_iterable(ids), dtype=np.int64) for ids in (a, b))
        self.first_a, self.first_b = (np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)]) for ids in (a, b))
        ends_a, ends_b = np.cumsum(sizes_a[self.a]), np.cumsum(sizes_b[self.b])
        each_a, each_b = ends_a.tolist(), ends_b.tolist()
        common: list[int] = []
        until_a: list[int] = []
        until_b: list[int] = []
        i = j = 0
        for k, m in zip(self.first_a[1:].tolist(), self.first_b[1:].tolist()):
            at_a = dict(zip(each_a[i:k], range(i + 1, k + 1)))
            at_b = dict(zip(each_b[j:m], range(j + 1, m + 1)))
            both = sorted(at_a.keys() & at_b.keys())
            common += both
            until_a += map(at_a.__getitem__, both)
            until_b += map(at_b.__getitem__, both)
            i, j = k, m
        self.ends, self.until_a, self.until_b = (np.array(x, dtype=np.int64) for x in (common, until_a, until_b))
        # within a group, every end of either side ends the overlap of one token of A and one of B
        every = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
        every = every[np.concatenate([every[1:] != every[:-1], np.ones(min(1, len(every)), dtype=bool)])]
        self.pairs = (self.a[np.searchsorted(ends_a, every)] << 32) | self.b[np.searchsorted(ends_b, every)]
        row_ends = np.concatenate([[0], ends_a])[self.first_a]
        self.first_group = np.searchsorted(self.ends, row_ends, "right")
        self.first_link = np.searchsorted(every, row_ends, "right")

    def written(self, names_a: np.ndarray, names_b: np.ndarray) -> list[str]:
        """The groups of each row as text."""
        n, m = len(self.a), len(self.b)
        last_a, last_b = np.zeros(n, dtype=np.int64), np.zeros(m, dtype=np.int64)
        last_a[self.until_a - 1] = last_b[self.until_b - 1] = 1
        # a group's tokens of A follow all earlier groups; those of B also follow its own of A
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        line = np.empty(n + m, dtype=object)
        line[np.arange(n) + np.concatenate([[0], self.until_b])[group_a]] = names_a[last_a, self.a]
        line[np.arange(m) + self.until_a[group_b]] = names_b[last_b, self.b]
        at = self.first_a + self.first_b
        return ["".join(line[i:j])[:-1] for i, j in zip(at.tolist(), at[1:].tolist())]


class Aligner:
    """Aligns texts by two tokenizers."""

    def __init__(self, a: str, b: str):
        self.a, self.b = ByteLevel(a), Pieces(b)
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in side.bytes], dtype=np.int64) for side in (self.a, self.b))
        self.names_a, self.names_b = (
            np.array([[f"{i}{sign}" for i in range(len(side.bytes))] for sign in signs], dtype=object) for side, signs in ((self.a, ",|"), (self.b, ",;"))
        )

    @classmethod
    def of(cls, a: str, b: str) -> Aligner:
        """The worker process's aligner, kept from task to task."""
        if (a, b) not in _ALIGNERS:
            _ALIGNERS[a, b] = cls(a, b)
        return _ALIGNERS[a, b]

    def ids(self, text: str | None) -> tuple[list[int], list[int]]:
        """Ids on either side; none if the bytes of one of them are not the text's."""
        if text:
            raw = b" " + text.encode()
            b = self.b.encode(text)
            if b"".join(map(self.b.bytes.__getitem__, b)) == raw:
                a = self.a.encode(" " + text)
                if b"".join(map(self.a.bytes.__getitem__, a)) == raw:
                    # a token without bytes covers nothing and links with nothing
                    return [x for x in a if self.a.bytes[x]], [x for x in b if self.b.bytes[x]]
        return [], []

    def align(self, texts: list[str | None]) -> Alignment:
        both = [self.ids(t) for t in texts]
        return Alignment([a for a, _ in both], [b for _, b in both], self.sizes_a, self.sizes_b)


_DOC = "id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def chunks(docs: DataFrame, *, key: str = "doc_id", text: str = "text", a: str | None = None, b: str | None = None, links: int = CHUNK_LINKS) -> DataFrame:
    """``chunk, docs, pairs, times, places``: documents with their counts, the chunk's distinct id pairs (``A << 32 | B``), how often it
    links them, and each link's place among the pairs, document by document (compressed)."""
    paths = a or tokenizer_path(BYTE_LEVEL), b or tokenizer_path(PIECES)
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, made, held = Aligner.of(*paths), 0, 0
        docs: list[pa.Array] = []
        found: list[np.ndarray] = []

        def chunk() -> pa.RecordBatch:
            every = np.concatenate([np.zeros(0, dtype=np.int64), *found])
            pairs, places, times = np.unique(every, return_inverse=True, return_counts=True)
            each = pa.concat_arrays(docs)
            number = (TaskContext.get().partitionId() << 24) | made
            return pa.record_batch(
                [
                    pa.array([number], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(each)], pa.int32()), each),
                    pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), pa.array(pairs)),
                    pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), pa.array(times.astype(np.int32))),
                    pa.array([pa.compress(places.astype("<u4").tobytes(), codec="zstd", asbytes=True)], pa.binary()),
                ],
                names=["chunk", "docs", "pairs", "times", "places"],
            )

        for batch in batches:
            for part in slices(batch, "text"):
                made_of = aligner.align(part.column("text").to_pylist())
                written = made_of.written(aligner.names_a, aligner.names_b)
                digests = pa.array([hashlib.sha256(w.encode()).hexdigest() if w else "" for w in written], pa.string())
                counts = [pa.array(np.diff(first)) for first in (made_of.first_a, made_of.first_b, made_of.first_group, made_of.first_link)]
                names = ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
                docs.append(pa.StructArray.from_arrays([part.column("key"), *counts, digests], names=names))
                found.append(made_of.pairs)
                held += len(made_of.pairs) + part.num_rows
                if held > links:
                    yield chunk()
                    docs, found, held, made = [], [], 0, made + 1
        if docs:
            yield chunk()

    schema = f"chunk long, docs array<struct<{_DOC.format(kind=kind).replace(' ', ':').replace(',:', ',')}>>, pairs array<long>, times array<int>, places binary"
    return rows.mapInArrow(encode, schema)


def pair_counts(made: DataFrame) -> DataFrame:
    """``pair, total, best``: links of every id pair over all chunks, and whether no pair of its B id has more."""
    rows = made.select(F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    totals = rows.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum(F.col("x.times").cast("long")).alias("total"))
    totals = stored(totals, "pairs")
    b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    highest = totals.groupBy(b.alias("b")).agg(F.max("total").alias("most"))
    return totals.join(highest, b == F.col("b")).select("pair", "total", (F.col("total") == F.col("most")).alias("best"))


def document_links(docs: DataFrame, *, key: str = "doc_id", text: str = "text", a: str | None = None, b: str | None = None, links: int = CHUNK_LINKS) -> DataFrame:
    """Per document: token counts, groups, links, links that are their B id's most frequent, the sum of the links' counts, and a digest of the groups."""
    made = stored(chunks(docs, key=key, text=text, a=a, b=b, links=links), "chunks")
    counted = pair_counts(made)
    each = made.select("chunk", F.posexplode("pairs").alias("place", "pair"))
    answers = each.join(counted, "pair").select(F.col("chunk").alias("its"), "place", "total", "best")
    kind = made.schema["docs"].dataType.elementType["id"].dataType.simpleString()

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right.column("place").to_numpy())
        total, best = right.column("total").to_numpy()[order], right.column("best").to_numpy(zero_copy_only=False)[order]
        rows, tables = left.column("docs").combine_chunks(), []
        for i in range(left.num_rows):
            each = pa.Table.from_struct_array(rows.slice(i, 1).flatten())
            until = np.cumsum(each.column("n_links").to_numpy())
            start = until - each.column("n_links").to_numpy()
            size = 4 * int(until[-1])
            places = np.frombuffer(pa.decompress(left.column("places")[i].as_py(), size, codec="zstd", asbytes=True) if size else b"", dtype="<u4")

            def sums(values: np.ndarray) -> pa.Array:
                running = np.concatenate([[0], np.cumsum(values[places], dtype=np.int64)])
                return pa.array(running[until] - running[start])

            tables.append(each.append_column("n_best", sums(best.astype(np.int64))).append_column("count_sum", sums(total)))
        return pa.concat_tables(tables)

    out = f"{_DOC.format(kind=kind)}, n_best long, count_sum long"
    done = made.select("chunk", "docs", "places").groupBy("chunk").cogroup(answers.groupBy("its")).applyInArrow(finish, out)
    return done.withColumnRenamed("id", key)


def groups(docs: DataFrame, *, key: str = "doc_id", text: str = "text", a: str | None = None, b: str | None = None) -> DataFrame:
    """``key, groups``: the groups themselves, each with its ids on either side and the byte where it begins (the blank in front is byte 0)."""
    paths = a or tokenizer_path(BYTE_LEVEL), b or tokenizer_path(PIECES)
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner.of(*paths)
        for batch in batches:
            for part in slices(batch, "text"):
                out = aligner.align(part.column("text").to_pylist())
                lists = []
                for until, ids in ((out.until_a, out.a), (out.until_b, out.b)):
                    lists.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], until]), pa.int32()), pa.array(ids, pa.int32())))
                begin = np.concatenate([[0], out.ends[:-1]]) if len(out.ends) else out.ends
                many = np.diff(out.first_group)
                base = np.concatenate([[0], out.ends])[out.first_group[:-1]]
                each = pa.StructArray.from_arrays([*lists, pa.array(begin - np.repeat(base, many))], names=["a", "b", "start"])
                yield pa.record_batch([part.column("key"), pa.ListArray.from_arrays(pa.array(out.first_group, pa.int32()), each)], names=["key", "groups"])

    kind = rows.schema["key"].dataType.simpleString()
    made = rows.mapInArrow(find, f"key {kind}, groups array<struct<a:array<int>,b:array<int>,start:long>>")
    return made.withColumnRenamed("key", key)
