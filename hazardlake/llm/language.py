"""Language identification by rank-order profiles.

A profile is a language's most frequent letter n-grams (one to three letters,
with word borders) in order of frequency. A document's own list is compared to
every profile by out-of-place distance: for each of its n-grams, how far its
rank is from the profile's rank, or the whole profile's length if the profile
lacks it. The nearest profile names the language; the score is how much nearer
it is than the second.

Profiles are learned from a sample of about ``profile_documents`` documents per
language, chosen by a hash of the id; sampled texts are read whole.

Defined results: a null text, or one without a letter, is ``und`` with score 0,
and so is every text if there is nothing to learn from; ties of rank go to the
smaller n-gram, ties of distance to the smaller language name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from hazardlake.llm.words import apart, slices, together

PROFILE_NGRAMS = 400
DOCUMENT_NGRAMS = 300
#: About as many documents per language make its profile.
PROFILE_DOCUMENTS = 2000
UNKNOWN = "und"
#: A document is of none of the languages if its n-grams are further out of place than this share of the profile's length. All labelled
#: documents at hand lie below 0.59, sentences in other Latin scripts than the learned ones at 0.63 to 0.80, other scripts at 1.
MOST_AWAY = 0.7

_BORDER = 1  # letters are at least 65
_BITS = 21
_LETTER: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Which code points are letters."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTER[0]


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text and their counts.

    The n-gram ``abc`` is the number ``a, b, c`` in base 2**21; borders of
    words count as a letter, so lengths never mix.
    """
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    points = np.where(letters()[points], points, _BORDER).astype(np.int64)
    line = np.full(len(points) + 2, _BORDER, dtype=np.int64)
    line[1:-1] = points
    border = line == _BORDER
    line = line[np.concatenate([[True], ~(border[1:] & border[:-1])])]
    letter = line != _BORDER
    two = (line[:-1] << _BITS) | line[1:]
    three = (two[:-1] << _BITS) | line[2:]
    found = np.concatenate([line[letter], two[letter[:-1] | letter[1:]], three[letter[1:-1]]])
    found.sort()
    at = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])) if len(found) else np.zeros(0, dtype=np.int64)
    return found[at], np.diff(np.append(at, len(found)))


def ranked(grams: np.ndarray, counts: np.ndarray, limit: int) -> np.ndarray:
    """The ``limit`` most frequent n-grams, most frequent first."""
    if len(grams) > 4 * limit:
        least = np.partition(counts, len(counts) - limit)[len(counts) - limit]
        keep = counts >= least
        grams, counts = grams[keep], counts[keep]
    return grams[np.lexsort((grams, -counts))[:limit]]


def _part(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary"))


def held_out(key: str = "doc_id", parts: int = 4, part: int = 2) -> Column:
    return F.coalesce(_part(F.col(key)) % parts == part, F.lit(False))


def learn(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    profile_documents: int = PROFILE_DOCUMENTS,
    profile_ngrams: int = PROFILE_NGRAMS,
) -> dict[str, np.ndarray]:
    """Each language's n-grams in order of rank, from the given labelled documents."""
    known = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")).filter("lang is not null")
    sizes = known.groupBy("lang").count()
    # a hash in [0, 2**20) below the share that is wanted
    share = F.ceil(F.lit(float(profile_documents << 20)) / F.col("count")).alias("share")
    chosen = known.join(F.broadcast(sizes.select("lang", share)), "lang").filter(F.pmod(F.xxhash64("key", "lang"), F.lit(1 << 20)) < F.col("share"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[str, int], int] = {}
        for batch in batches:
            for language, body in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                for gram, n in zip(*(a.tolist() for a in ngrams(body))):
                    total[language, gram] = total.get((language, gram), 0) + n
        yield pa.record_batch(
            {
                "lang": pa.array([k[0] for k in total], pa.string()),
                "gram": pa.array([k[1] for k in total], pa.int64()),
                "n": pa.array(list(total.values()), pa.int64()),
            }
        )

    sums = chosen.select("lang", "text").mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    profiles: dict[str, list[int]] = {}
    for r in sums.withColumn("rank", rank).filter(F.col("rank") <= profile_ngrams).orderBy("lang", "rank").collect():
        profiles.setdefault(r["lang"], []).append(r["gram"])
    return {k: np.array(v, dtype=np.int64) for k, v in profiles.items()}


class Profiles:
    """Profiles laid out for look-up."""

    def __init__(self, profiles: dict[str, np.ndarray]):
        self.names = sorted(profiles)
        self.length = max([len(v) for v in profiles.values()], default=1)
        self.grams = np.unique(np.concatenate([np.zeros(0, dtype=np.int64), *profiles.values()]))
        # rank of each n-gram in each profile; the profile's length if it is not there
        self.rank = np.full((len(self.grams) + 1, len(self.names)), -1, dtype=np.int64)
        for i, name in enumerate(self.names):
            self.rank[np.searchsorted(self.grams, profiles[name]), i] = np.arange(len(profiles[name]))

    def nearest(self, text: str | None, document_ngrams: int = DOCUMENT_NGRAMS) -> tuple[str, float, float]:
        """The nearest language, its lead over the second, and its distance (0 to 1)."""
        grams = ranked(*ngrams(text), document_ngrams)
        if not len(grams) or not self.names:
            return UNKNOWN, 0.0, 1.0
        at = np.searchsorted(self.grams, grams)
        known = at < len(self.grams)
        known[known] = self.grams[at[known]] == grams[known]
        theirs = self.rank[np.where(known, at, len(self.grams))]
        away = np.where(theirs < 0, self.length, np.abs(theirs - np.arange(len(grams))[:, None]))
        distance = np.minimum(away, self.length).sum(axis=0) / (self.length * len(grams))
        best = int(np.argmin(distance))
        others = np.delete(distance, best)
        second = float(others.min()) if len(others) else 1.0
        score = 1.0 - float(distance[best]) / second if second > 0 else 0.0
        return self.names[best], score, float(distance[best])


def predict(docs: DataFrame, profiles: dict[str, np.ndarray], *, text: str = "text") -> DataFrame:
    """The documents' other columns in a struct ``doc``, ``text``, ``lang_pred``, ``score`` and ``away``, the distance to that language."""
    model = Profiles(profiles)

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = [model.nearest(t) for t in part.column("text").to_pylist()]
                told = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.float64()))]
                yield pa.RecordBatch.from_arrays([part.column("doc"), part.column("text"), *told], names=["doc", "text", "lang_pred", "score", "away"])

    rows = apart(docs, text)
    out = rows.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("away")).schema
    return rows.mapInArrow(name, out)


def learn_and_predict(docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang", **options) -> DataFrame:
    """Profiles from the documents outside the held-out quarter, applied to all: ``key, held_out, lang_pred, score``."""
    known = docs.filter(_part(F.col(key)) % 4 != 2)
    profiles = learn(known, key=key, text=text, lang=lang, **options)
    rows = predict(docs.select(F.col(key), F.col(text)), profiles, text=text)
    return rows.select(F.col("doc").getField(key).alias(key), "lang_pred", "score").select(key, held_out(key).alias("held_out"), "lang_pred", "score")


def keep_identified(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang", languages: tuple[str, ...] | None = None, most_away: float = MOST_AWAY, **options
) -> DataFrame:
    """The documents, with all their columns, predicted to be in one of the ``languages`` (all that are learned, if none are named).

    A text without a letter goes, and so does one further than ``most_away`` from every learned language.
    """
    profiles = learn(docs.filter(_part(F.col(key)) % 4 != 2), key=key, text=text, lang=lang, **options)
    kept = predict(docs, profiles, text=text).filter((F.col("lang_pred") != UNKNOWN) & (F.col("away") <= most_away))
    if languages is not None:
        kept = kept.filter(F.col("lang_pred").isin(*languages))
    return kept.select(*together(docs.columns, text))
