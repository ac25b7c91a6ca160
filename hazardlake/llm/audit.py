"""Filter interaction audit: what each filter removes in every order of a filter chain.

A document fails a set of filters, kept as a bit mask. What a filter removes
after others depends only on the *set* of the others, a state of the lattice of
subsets. So documents are counted once per part and mask, and the counts become
removals on the lattice's edges (a state and the filter applied next). Paths
through the lattice are orders of the filters: counting the paths that reach a
state (forward) and that leave the next one (backward) weighs every edge for
the Shapley sums without walking an order, and a single order's steps are read
from the edges on its path.

Texts leave no trace but a digest: the shuffle carries some fifty bytes a
document. Copies of a text are found by SHA-256.

Defined results: a null text is empty; a null part is ''; a document without an
id is never a copy of another one, nor the first of its text; rows that share
the smallest id of a text all count as first; every row counts, repeated rows
too; labels that repeat are good (toxic) if one of them is; an empty table has no
parts and gives no rows.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlake.session import stored

#: Orders are listed for this many filters at most: 7 have 5040 orders. The lattice alone takes more.
MOST_ORDERED = 7
# The thresholds of the conditions and their patterns.
WORD = r"[^\x20\x09-\x0D]+"
CAPITAL = "[^A-Z]"
SYMBOLS = "[#$%&*|]"


def text_conditions(text: Column) -> dict[str, Column]:
    """Failure conditions A to D of one text: few words, repeated words, capitals, symbols."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    return {
        "A": n < 100,
        "B": 100 * distinct.cast("long") < 80 * n.cast("long"),
        "C": 100 * F.length(F.regexp_replace(text, CAPITAL, "")).cast("long") > 10 * F.length(text).cast("long"),
        "D": text.rlike(SYMBOLS),
    }


def failures(docs: DataFrame, *, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """``doc_id, part, mask, n``: the failed conditions of every document as bits (A is 1, E is 16).

    Equal rows are counted in ``n``.
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"), F.col(f"`{text}`").alias("text"))
    bits = [F.when(failed, 1 << i).otherwise(0) for i, failed in enumerate(text_conditions(body).values())]
    marks = rows.select("doc_id", "part", F.unhex(F.sha2(body.cast("binary"), 256)).alias("digest"), sum(bits[1:], bits[0]).alias("mask"))
    marks = stored(marks, "marks")
    seen = marks.groupBy("doc_id", "digest", "part", "mask").agg(F.count("*").alias("n"))
    # the smallest id is part of the join key: a text that a third of the documents share does not meet in one task
    first = marks.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    copied = F.col("doc_id").isNotNull() & F.col("is_first").isNull()
    joined = seen.join(first, ["doc_id", "digest"], "left")
    return joined.select("doc_id", "part", (F.col("mask") + F.when(copied, 16).otherwise(0)).alias("mask"), "n")


def with_labels(failed: DataFrame, labels: DataFrame, *, key: str = "doc_id", good: str = "quality", toxic: str = "toxic") -> DataFrame:
    """``failed`` with ``good`` and ``toxic`` (0 or 1)."""
    marked = labels.groupBy(F.col(f"`{key}`").alias("doc_id")).agg(
        F.max((F.col(f"`{good}`") == 1).cast("int")).alias("good"), F.max((F.col(f"`{toxic}`") == 1).cast("int")).alias("toxic")
    )
    named = failed.filter("doc_id is not null").join(marked, "doc_id", "left").fillna(0, ["good", "toxic"])
    return named.unionByName(failed.filter("doc_id is null").withColumns({"good": F.lit(0), "toxic": F.lit(0)}))


def cells(failed: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents by part and failed filters."""
    return failed.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def path_counts(filters: int) -> tuple[list[int], list[int]]:
    """Per state of the lattice: the orders that reach it from the empty set, and those that lead on to the full one."""
    states, bits = range(1 << filters), [1 << f for f in range(filters)]
    forward, backward = [0] * len(states), [0] * len(states)
    forward[0] = backward[-1] = 1
    for state in states:
        for bit in bits:
            if not state & bit:
                forward[state | bit] += forward[state]
    for state in reversed(states):
        for bit in bits:
            if not state & bit:
                backward[state] += backward[state | bit]
    return forward, backward


def edges(counted: DataFrame, filters: int) -> DataFrame:
    """Per part, state and next filter (a bit): what it removes there, and the filter's Shapley sum over all orders.

    ``orders`` is the number of orders that pass the edge.
    """
    forward, backward = path_counts(filters)
    table = [
        F.struct(F.lit(s).alias("state"), F.lit(1 << f).alias("bit"), F.lit(forward[s] * backward[s | 1 << f]).cast("long").alias("orders"))
        for s in range(1 << filters)
        for f in range(filters)
        if not s >> f & 1
    ]
    x = counted.withColumn("edge", F.explode(F.array(*table))).select("*", "edge.*")
    mask, state, bit = F.col("mask"), F.col("state"), F.col("bit")
    fails, before = mask.bitwiseAND(bit) != 0, mask.bitwiseAND(state) != 0

    def total(amount: str, when: Column) -> Column:
        return F.sum(F.when(when, F.col(amount)).otherwise(0)).alias(amount)

    summed = x.groupBy("part", "state", "bit", "orders").agg(
        total("n", mask.bitwiseAND(state.bitwiseOR(bit)) == 0).alias("kept"),
        total("n", fails & ~before).alias("removed"),
        total("n", fails & before).alias("redundant"),
        total("n", mask == bit).alias("unique_fails"),
        total("good", fails & ~before).alias("good_lost"),
        total("toxic", fails & ~before).alias("toxic_lost"),
    )
    shapley = summed.groupBy("part", "bit").agg(F.sum(F.col("removed") * F.col("orders")).alias("shapley"))
    return summed.join(shapley, ["part", "bit"])


def orders(lattice: DataFrame, names: str) -> DataFrame:
    """The steps of every order of the filters ``names`` (one letter for each bit), read from the lattice's edges."""
    if len(names) > MOST_ORDERED:
        raise ValueError(f"{len(names)} filters have too many orders to list; read the lattice")
    steps = []
    for order in permutations(range(len(names))):
        state = 0
        for step, f in enumerate(order, 1):
            steps.append(("".join(names[i] for i in order), step, state, 1 << f))
            state |= 1 << f
    paths = lattice.sparkSession.createDataFrame(steps, "filter_order string, step int, state int, bit int")
    # at most 5040 orders of 7 steps
    return lattice.join(F.broadcast(paths), ["state", "bit"])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part, order and step of the filters A to E: what is kept, removed, redundant, unique and lost, and the Shapley sum."""
    counted = cells(with_labels(failures(docs), labels))
    return orders(edges(counted, 5), "ABCDE").select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )
