"""Bottom-k document sketches, built and compared with SQL functions alone.

A sketch is the sorted array of the ``k`` smallest distinct hashes of a text's
shingles (five words; a shorter text is one shingle). Sketches of parts merge
into the sketch of the whole, and two sketches estimate how many distinct
shingles their texts have, how much of them they share, and how much of one
lies in the other.

Defined results: a null or blank text has an empty sketch; two empty sketches
are alike (1), an empty and another are not (0); a sketch with fewer than ``k``
hashes is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import Window as W

K = 128
WORDS = 5
#: Documents that share a bucket of the descending order, and most buckets.
BUCKET_DOCUMENTS = 1024
MAX_BUCKETS = 1 << 16


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"[ \t\n\x0B\f\r]+"), lambda w: w != "")


def shingle_hashes(text: Column, size: int = WORDS) -> Column:
    """One hash per shingle, repeats included; built from the words' hashes."""

    def of(hashes: Column) -> Column:
        whole = F.array(F.xxhash64(F.array_join(F.transform(hashes, lambda h: h.cast("string")), " ")))
        many = F.transform(F.sequence(F.lit(0), F.size(hashes) - size), lambda i: F.xxhash64(*[hashes[i + k] for k in range(size)]))
        none = F.array().cast("array<bigint>")
        return F.when(F.size(hashes) == 0, none).when(F.size(hashes) < size, whole).otherwise(many)

    return let(F.transform(words(F.coalesce(text, F.lit(""))), lambda w: F.xxhash64(w)), of)


def sketch(text: Column, k: int = K, size: int = WORDS) -> Column:
    return bottom(shingle_hashes(text, size), k)


def bottom(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of two parts together. (Shingles across the seam belong to neither part.)"""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merged(parts: DataFrame, by: list[str], column: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per group of parts.

    Groups of any size: hashes are deduplicated with a partial aggregate, and
    only the ``k`` smallest of a group survive each task before the shuffle.
    """
    hashes = parts.select(*by, F.explode(column).alias("_h")).distinct()
    rank = F.row_number().over(W.partitionBy(*by).orderBy("_h"))
    least = hashes.withColumn("_rank", rank).filter(F.col("_rank") <= k)
    return least.groupBy(*by).agg(F.sort_array(F.collect_list("_h")).alias(column))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the distinct shingles of both that they have in common."""
    shared = let(F.array_intersect(a, b), lambda both: let(merge(a, b, k), lambda u: F.size(F.array_intersect(u, both)) / F.size(u)))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(shared)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first text's distinct shingles that the second has, too."""
    union = distinct_count(merge(a, b, k), k)
    shared = resemblance(a, b, k) * union / distinct_count(a, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared))


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    reach = (F.element_at(a, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / reach)


def as_text(a: Column) -> Column:
    """The sketch as text: 16 hex digits a hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


# --- each document beside the next ------------------------------------------


def _bucket(bounds: list[int], key: Column) -> Column:
    """Number of bounds at or below the key, by binary search; null keys are in bucket 0."""
    if not bounds:
        return F.lit(0)
    table = F.array(*[F.lit(b) for b in bounds]) if len(bounds) <= 64 else F.from_json(F.lit(str(bounds)), "array<bigint>")
    steps = F.sequence(F.lit(1), F.lit(len(bounds).bit_length()))

    def halve(bounds_: Column):
        def step(s: Column, _: Column) -> Column:
            mid = ((s["lo"] + s["hi"]) / 2).cast("int")
            below = bounds_[F.least(mid, F.lit(len(bounds) - 1))] <= key
            return (
                F.when(s["lo"] >= s["hi"], s)
                .when(below, F.struct((mid + 1).alias("lo"), s["hi"].alias("hi")))
                .otherwise(F.struct(s["lo"].alias("lo"), mid.alias("hi")))
            )

        return step

    found = let(table, lambda t: F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi")), halve(t), lambda s: s["lo"]))
    return F.coalesce(found, F.lit(0))


def descending(docs: DataFrame, *, key: str = "doc_id", bucket_documents: int = BUCKET_DOCUMENTS) -> tuple[DataFrame, WindowSpec]:
    """The rows in buckets of a descending order, and the window in which ``lead`` finds the next row.

    The order of an integer key is cut at its quantiles in buckets of about
    ``bucket_documents`` rows, so no task sees the whole order. Rows with
    ``_border`` are copies: the first row of each bucket is also the last of
    the bucket before it, and the first of all follows the last of all. Drop
    them at the end. Equal keys are ordered by their other columns, null keys
    come last.
    """
    names = docs.columns
    count = docs.select(key).count()
    n = min(MAX_BUCKETS, max(1, -(-count // bucket_documents)))
    cuts = docs.select(F.percentile_approx(key, [i / n for i in range(1, n)], 20 * n)).first()[0] if n > 1 else None
    bounds = sorted(set(cuts or []))
    dealt = docs.withColumn("_bucket", _bucket(bounds, F.col(key))).withColumn("_border", F.lit(False))
    heads = dealt.groupBy("_bucket").agg(F.max(key).alias("head")).orderBy(F.desc("_bucket")).collect()
    # at most MAX_BUCKETS pairs of numbers
    pairs = [(h["head"], heads[i - 1]["_bucket"]) for i, h in enumerate(heads)]
    table = docs.sparkSession.createDataFrame(pairs, "_head long, _before int")
    border = docs.join(F.broadcast(table), F.col(key).eqNullSafe(F.col("_head"))).select(
        *names, F.col("_before").alias("_bucket"), F.lit(True).alias("_border")
    )
    order = W.partitionBy("_bucket").orderBy("_border", F.desc(key), *[c for c in names if c != key])
    return dealt.unionByName(border), order


def edited_beside_next(docs: DataFrame, *, key: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """Sketches of every text, of the text with its last third replaced by the next document's beginning, and their likeness.

    Returns ``key, text, n_chars, edited, sketch, edited_sketch, near_edited, near_next``.
    """
    rows, order = descending(docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("text")), key=key)
    beside = rows.withColumn("_next_text", F.lead("text").over(order)).withColumn("n_chars", F.char_length("text").cast("long"))
    last = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.expr("substring(text, 1, cast(n_chars - floor(n_chars / 3) as int))"), F.substring("_next_text", F.lit(1), last))
    made = beside.select(key, "_bucket", "_border", "text", "n_chars", F.coalesce(edited, F.lit("")).alias("edited"), sketch(F.col("text"), k).alias("sketch"))
    both = made.withColumn("_next_sketch", F.lead("sketch").over(order)).filter(~F.col("_border"))
    return both.withColumn("edited_sketch", sketch(F.col("edited"), k)).select(
        key,
        "text",
        "n_chars",
        "edited",
        "sketch",
        "edited_sketch",
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("_next_sketch"), k).alias("near_next"),
    )
