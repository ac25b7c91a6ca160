"""Fingerprints, groups, sketches and repeated passages beside plain Python versions."""

import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from hazardlake.llm import near, simhash, sketches, substring

from .conftest import odd_rows, prose

LOW = {i: i + 32 for i in range(65, 91)}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# --- SimHash ----------------------------------------------------------------


def brute_fingerprint(text):
    w = words((text or "").translate(LOW))
    parts = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] if w else []
    ones = Counter()
    for p in parts:
        h = xxhash.xxh64_intdigest(p.encode(), 42)
        ones.update(b for b in range(64) if h >> b & 1)
    return sum(1 << b for b, n in ones.items() if 2 * n > len(parts))


def brute_groups(marks, budget):
    """Smallest mark of each mark's group, by comparing all."""
    marks = sorted(set(marks))
    up = {m: m for m in marks}

    def top(m):
        while up[m] != m:
            m = up[m]
        return m

    for i, a in enumerate(marks):
        for b in marks[i + 1 :]:
            if bin(a ^ b).count("1") <= budget and top(a) != top(b):
                low, high = sorted((top(a), top(b)))
                up[high] = low
    return {m: top(m) for m in marks}


def near_marks(n, seed=5):
    """Numbers of 64 bits with chains, stars and lonely ones among them."""
    rng = random.Random(seed)
    out = [0, 2**64 - 1, 1, 2**63]
    while len(out) < n:
        base = rng.choice(out) if rng.random() < 0.7 else rng.getrandbits(64)
        for _ in range(rng.randint(0, 5)):
            base ^= 1 << rng.randrange(64)
        out.append(base)
    return out


def signed(v):
    return v - 2**64 if v >= 2**63 else v


@pytest.mark.parametrize("subtrie", [20_000, 7])
def test_links_connect_the_same_groups_as_all_pairs(spark, subtrie):
    marks = near_marks(400)
    want = brute_groups(marks, 4)
    table = spark.createDataFrame([(signed(m),) for m in set(marks)], "fingerprint long")
    roots = simhash.components(simhash.links(table, 4, subtrie))
    label = {r["node"] % 2**64: r["root"] % 2**64 for r in roots.collect()}
    got = {}
    for m in set(marks):
        got.setdefault(label.get(m, m), set()).add(m)
    expected = {}
    for m, top in want.items():
        expected.setdefault(top, set()).add(m)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))


def test_a_dense_cluster_gives_no_more_edges_than_leaves(spark):
    marks = [signed(sum(1 << b for b in range(10) if i >> b & 1)) for i in range(1024)]
    edges = simhash.links(spark.createDataFrame([(m,) for m in marks], "fingerprint long"))
    assert edges.count() <= 5 * 1023
    assert simhash.components(edges).select("root").distinct().count() == 1


def test_components_of_a_long_chain(spark):
    order = list(range(200))
    random.Random(1).shuffle(order)
    edges = spark.createDataFrame([(order[i], order[i + 1]) for i in range(199)] + [(500, 501)], "a long, b long")
    roots = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert set(roots.values()) == {0, 500} and len(roots) == 200


def test_groups_of_documents(spark, odd):
    rows = odd_rows()
    marks = [brute_fingerprint(r[1]) for r in rows]
    top = brute_groups(marks, 4)
    least = {}
    for r, m in zip(rows, marks):
        if r[0] is not None:
            least[top[m]] = min(least.get(top[m], r[0]), r[0])
    want = sorted([(r[0], signed(m), least[top[m]]) for r, m in zip(rows, marks)], key=repr)
    assert sorted(map(tuple, simhash.groups(odd).collect()), key=repr) == want


def test_one_of_each(clashing, nothing):
    rows = [r[:2] for r in odd_rows()]
    groups = brute_near(rows)
    left = near.one_of_each(clashing)
    ids = [r["doc_id"] for r in left.collect()]
    assert left.columns == clashing.columns
    assert sorted(ids) == sorted(min(rows[i][0] for i in g if rows[i][0] is not None) for g in groups)
    unnamed = clashing.withColumn("doc_id", F.lit(None).cast("long"))
    assert near.one_of_each(unnamed).count() == len(groups)
    assert near.one_of_each(nothing).count() == 0 and simhash.groups(nothing).count() == 0


def brute_shingles(text):
    w = words((text or "").translate(LOW))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_near(rows):
    """Numbers of rows, in groups of a similarity of 0.8 or more by comparing all."""
    sets = [brute_shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if (5 * len(a & b) >= 4 * len(a | b)) if a or b else True:
                low, high = sorted((top(i), top(j)))
                up[high] = low
    out = {}
    for i in range(len(rows)):
        out.setdefault(top(i), []).append(i)
    return list(out.values())


def edited_copies(seed=3):
    """Copies with words changed, in chains and stars, many of them close to the border."""
    rng = random.Random(seed)
    rows = []
    for g in range(40):
        base = prose(500 + g, rng.choice([8, 40, 150, 300])).split()
        for _ in range(rng.choice([1, 2, 3, 12])):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(text) // 35))):
                text[rng.randrange(len(text))] = f"x{rng.random()}"
            if rng.random() < 0.3:
                base = text
            rows.append((len(rows), " ".join(text)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("unit", [near.UNIT, 700])
def test_edited_copies_go(spark, unit):
    """Copies at a similarity of 0.8 differ in more than four bits; small units cut the blocks in pairs of parts."""
    rows = edited_copies()
    groups = brute_near(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near.one_of_each(docs, unit=unit)
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(min(rows[i][0] for i in g) for g in groups)
    assert got.count() < simhash.groups(docs).select("component_id").distinct().count()


def test_repeated_ids_of_different_texts_lose_no_group(spark):
    a, b, c = prose(900, 50), prose(901, 50), prose(902, 50)
    rows = [(1, a), (1, b), (2, b), (3, a), (4, c), (4, a), (None, prose(903, 50)), (None, c), (None, prose(903, 50))]
    got = [tuple(r) for r in near.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got, key=repr) == sorted([(1, a), (1, b), (4, c), (None, prose(903, 50))], key=repr)


# --- sketches ---------------------------------------------------------------


def shingles(text):
    w = [x for x in re.split(r"[ \t\n\x0B\f\r]+", text or "") if x]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_likeness_is_that_of_the_shingles(spark):
    a = prose(1, 300)
    texts = [(a, a), (a, a + " " + prose(2, 100)), (a, prose(3, 300)), ("", ""), (None, "  "), ("", a), ("x y", "x y"), ("x y", "x z"), (prose(4, 3000), prose(4, 2000) + prose(5, 900))]
    s, t = sketches.sketch(F.col("a")), sketches.sketch(F.col("b"))
    frame = spark.createDataFrame(texts, "a string, b string").select("a", "b", s.alias("s"), t.alias("t"))
    near, part, n = sketches.resemblance(F.col("s"), F.col("t")), sketches.containment(F.col("s"), F.col("t")), sketches.distinct_count(F.col("s"))
    for r in frame.select("a", "b", near.alias("near"), part.alias("part"), n.alias("n")).collect():
        x, y = shingles(r["a"]), shingles(r["b"])
        assert r["near"] == pytest.approx(len(x & y) / len(x | y) if x | y else 1.0, abs=0.15)
        assert r["part"] == pytest.approx(len(x & y) / len(x) if x else 1.0, abs=0.25)
        assert r["n"] == pytest.approx(len(x), rel=0.3)


def test_parts_merge_into_the_whole(spark):
    a, b = prose(1, 400), prose(2, 400)
    parts = spark.createDataFrame([(1, a), (1, b), (2, b), (3, "")], "doc_id long, text string").select("doc_id", sketches.sketch(F.col("text")).alias("sketch"))
    got = {r["doc_id"]: r["sketch"] for r in sketches.merged(parts, ["doc_id"]).collect()}
    one, two = [r["sketch"] for r in parts.filter("doc_id = 1").collect()]
    assert got[1] == sorted({*one, *two})[: sketches.K] and set(got) == {1, 2}


@pytest.mark.parametrize("bucket", [1, 3, 1000])
def test_every_document_meets_the_next(spark, monkeypatch, bucket):
    rows = [(i * 7 % 101 - 20, f"{i} " * (i % 5) + "é" * i) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    real = sketches.descending
    monkeypatch.setattr(sketches, "descending", lambda d, key: real(d, key=key, bucket_documents=bucket))
    texts = dict(rows)
    ids = sorted(texts, reverse=True)
    got = {r["doc_id"]: r for r in sketches.edited_beside_next(docs).collect()}
    assert len(got) == len(rows)
    for k, i in enumerate(ids):
        t, after = texts[i], texts[ids[(k + 1) % len(ids)]]
        cut = len(t) // 3
        assert got[i]["edited"] == t[: len(t) - cut] + after[:cut] and got[i]["n_chars"] == len(t)


def test_edited_texts_of_odd_rows(odd, nothing, spark):
    rows = sketches.edited_beside_next(odd).collect()
    assert len(rows) == len(odd_rows()) and all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    assert sketches.edited_beside_next(nothing).count() == 0
    alone = sketches.edited_beside_next(spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")).first()
    assert alone["edited"] == "abcdab" and alone["near_next"] == 1.0


# --- repeated passages ------------------------------------------------------


def brute_passages(docs, n=13):
    first = {}
    for i, t in docs:
        w = words(t)
        for j in range(len(w) - n + 1):
            k = tuple(w[j : j + n])
            if i is not None:
                first[k] = min(first.get(k, i), i)
    out = []
    for i, t in docs:
        w = words(t)
        gone = [False] * len(w)
        for j in range(len(w) - n + 1):
            if i is not None and first[tuple(w[j : j + n])] < i:
                gone[j : j + n] = [True] * n
        out.append((i, " ".join(x for x, g in zip(w, gone) if not g), len(w), sum(gone)))
    return out


def passages(seed=9):
    rng = random.Random(seed)
    shared = [prose(100 + i, 60).split() for i in range(4)]
    rows = [(r[0], r[1]) for r in odd_rows()]
    for i in range(30):
        out = prose(200 + i, rng.randint(5, 60)).split()
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randint(0, 40)
            at = rng.randint(0, len(out))
            out[at:at] = s[a : a + rng.randint(5, 40)]
        rows.append((1000 - 7 * i, " ".join(out)))
    rows += [(2000, "loop " * 40), (2001, "loop " * 13), (2002, "loop " * 12), (3000, "same id " * 20), (3000, prose(100, 60))]
    return rows


@pytest.mark.parametrize("bits", [56, 12])
def test_repeated_passages_go(spark, bits):
    """With few bits many hashes name several passages, and the verification has to sort them out."""
    rows = passages()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r["doc"]["doc_id"], r["text"], r["n_words"], r["n_removed"]) for r in substring.remove_repeats(docs, bits=bits).collect()]
    assert sorted(got, key=repr) == sorted(brute_passages(rows), key=repr) and sum(r[3] for r in got) > 300


def test_spans_name_their_source(spark):
    text = prose(7, 50)
    docs = spark.createDataFrame([(1, text), (2, "new words first " + text)], "doc_id long, text string")
    spans = {r["doc"]["doc_id"]: [tuple(s) for s in r["spans"]] for r in substring.remove_repeats(docs).collect()}
    assert spans == {1: [], 2: [(3, 50, 1)]}


def test_passages_of_nothing_and_clashing_names(nothing, clashing):
    assert substring.remove_repeats(nothing).count() == 0
    got = substring.remove_repeats(clashing)
    assert got.count() == len(odd_rows()) and set(got.select("doc.*").columns) == set(clashing.columns) - {"text"}


def test_packed_numbers_round_trip():
    for bits in (12, 32, 56, 64):
        v = np.random.default_rng(bits).integers(0, 2**min(bits, 63), 1000, dtype=np.uint64)
        assert (substring._wide(substring._narrow(v, bits), bits) == v).all()


def test_near_copies_with_unlike_fingerprints(spark):
    """Pairs at exactly 0.8 (4 of 5 shingles) whose 64-bit fingerprints differ in 23 or 24 bits."""
    rows = []
    for seed in (195, 546, 815, 1065, 1987, 2346, 3535, 3793, 6278, 14504, 17092, 19390):
        draw = random.Random(seed)
        words = [f"w{draw.randrange(10**6)}" for _ in range(9)]
        rows += [(seed, " ".join(words[:8])), (100_000 + seed, " ".join(words))]
    kept = near.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == [r[0] for r in rows[::2]]


def test_near_copies_that_share_few_bands(spark):
    """Pairs at exactly 0.8 (4 of 5 shingles) none of whose first 24 bands is the same: 9 of 1,500,000 that were made."""
    rows = []
    for seed in (55684, 66301, 355982, 402394, 535920, 868340, 962793, 1276060, 1289267):
        draw = random.Random(seed)
        words = [f"w{draw.randrange(10**6)}" for _ in range(9)]
        rows += [(seed, " ".join(words[:8])), (2_000_000 + seed, " ".join(words))]
        few, more = (near.bands_of(near.shingle_set(r[1].encode())) for r in rows[-2:])
        assert not (few == more)[:24].any() and (few == more).any()
    kept = near.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == [r[0] for r in rows[::2]]
