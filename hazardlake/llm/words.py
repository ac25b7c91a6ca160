"""Words and rolling hashes of whole Arrow batches, computed with numpy.

Texts are handled as UTF-8 bytes. The byte classes used here are closed under
UTF-8: a code point beyond ASCII is either wholly inside words or wholly
outside, so words of bytes are words of code points.

Hashes are polynomials modulo 2**64 over random values for bytes (or words),
so that the hash of every slice comes from one running sum. They only propose
matches; callers verify what they act on.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text handled at once; bounds the memory of the numpy arrays beside it.
SLICE_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SAME = np.arange(256, dtype=np.uint8)

#: ``[^\x20\x09-\x0D]``
NOT_BLANK = np.ones(256, dtype=bool)
NOT_BLANK[[0x20, *range(0x09, 0x0E)]] = False

#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]``: digits, a-z and all beyond ASCII
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts have about ``limit`` bytes; a longer text comes alone."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(sizes)
    start = 0
    while start < len(total):
        before = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, before + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array, and where each row's begin (one more entry than rows). Null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, at, data = texts.buffers()
    offsets = np.frombuffer(at, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def apart(docs: DataFrame, text: str) -> DataFrame:
    """The text as ``text``, beside a struct ``doc`` of all other columns, so that no column's name matters."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(0).alias("_none")]
    return docs.select(F.struct(*others).alias("doc"), F.col(f"`{text}`").alias("text"))


def together(columns: list[str], text: str, **changed: Column) -> list[Column]:
    """The columns of :func:`apart` in their own places, some of them ``changed``."""
    return [F.col("text").alias(c) if c == text else changed.get(c, F.col("doc").getField(c)).alias(c) for c in columns]


class Words:
    """Words of the rows of a string array.

    ``data`` are the (folded) bytes, ``start``/``end`` the bytes of each word,
    ``row`` its row, ``first[r]`` the number of words before row ``r``.
    """

    def __init__(self, texts: pa.Array, is_word: np.ndarray, fold: np.ndarray = SAME):
        raw, self.offsets = text_bytes(texts)
        self.data = raw if fold is SAME else fold[raw]
        inside = np.zeros(len(raw) + 2, dtype=bool)
        inside[1:-1] = is_word[self.data]
        here = inside[1:-1]
        begins = here & ~inside[:-2]
        ends = here & ~inside[2:]
        cuts = self.offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(raw))]
        begins[cuts] = here[cuts]
        ends[cuts - 1] = here[cuts - 1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, self.offsets)
        self.row = np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, seed: int = 0) -> np.ndarray:
        values = _byte_values(seed)
        return slice_hashes(values[self.data], self.start, self.end, seed)

    def text(self, start: int, stop: int) -> bytes:
        """Words ``start`` to ``stop``, joined by one space."""
        return b" ".join(self.data[a:b].tobytes() for a, b in zip(self.start[start:stop], self.end[start:stop]))


def windows(first: np.ndarray, length: int) -> np.ndarray:
    """Indexes of words at which a window of ``length`` words of one row begins."""
    n = int(first[-1])
    ok = np.zeros(n + 1, dtype=np.int32)
    have = np.maximum(np.diff(first) - length + 1, 0)
    begin = first[:-1][have > 0]
    np.add.at(ok, begin, 1)
    np.add.at(ok, begin + have[have > 0], -1)
    return np.flatnonzero(np.cumsum(ok[:-1]))


def window_hashes(words: np.ndarray, begin: np.ndarray, length: int | np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of the ``length`` word hashes from each of ``begin``."""
    return slice_hashes(words, begin, begin + length, seed + 1_000_003)


def slice_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """Order-sensitive hash of ``values[start:end]`` for many slices, from one running sum."""
    up, down = _powers(len(values), seed)
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mixed((total[end] - total[start]) * down[start])


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit over the word (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=8)
def _byte_values(seed: int) -> np.ndarray:
    return np.random.default_rng(1_000 + seed).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """``b**i`` and ``b**-i`` modulo 2**64 for i below n, for an odd base drawn from the seed."""
    kept = _POWERS.get(seed)
    if kept is None or len(kept[0]) <= n:
        size = ((n >> 18) + 1) << 18
        base = (int(np.random.default_rng(77 + seed).integers(2**40, 2**62)) << 1) | 5
        with np.errstate(over="ignore"):
            up = np.full(size, base % 2**64, dtype=np.uint64)
            down = np.full(size, pow(base, -1, 2**64), dtype=np.uint64)
            up[0] = down[0] = 1
            kept = (np.multiply.accumulate(up), np.multiply.accumulate(down))
        if len(_POWERS) > 4:
            _POWERS.clear()
        if n <= SLICE_BYTES * 4:
            _POWERS[seed] = kept
    return kept


def covered(begin: np.ndarray, length: np.ndarray | int, n: int) -> np.ndarray:
    """Which of ``n`` positions lie in one of the runs."""
    delta = np.zeros(n + 1, dtype=np.int64)
    np.add.at(delta, begin, 1)
    np.add.at(delta, np.minimum(begin + length, n), -1)
    return np.cumsum(delta[:-1]) > 0


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of true flags."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def code_points_before(data: np.ndarray) -> np.ndarray:
    """Per byte position (and one past the end), the code points that begin before it."""
    out = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out
