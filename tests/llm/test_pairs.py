"""Vectors, filter audits and token alignments beside plain Python versions."""

import hashlib
import math
import random
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hazardlake.llm import alignment, audit, polytope

from .conftest import odd_rows, prose

# --- embeddings ---------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int"


def cosine(a, b):
    dot, p, q = (math.fsum(x * y for x, y in zip(*pair)) for pair in ((a, b), (a, a), (b, b)))
    return dot / math.sqrt(p * q)


def usable(row):
    v = row[1]
    return row[2] is not None and v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute_links(rows, least=0.93):
    links = [0] * len(rows)
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(rows):
        for j in range(i + 1, len(rows)):
            b = rows[j]
            if usable(a) and usable(b) and a[2] == b[2] and len(a[1]) == len(b[1]) and cosine(a[1], b[1]) >= least:
                links[i] += 1
                links[j] += 1
                up[top(i)] = top(j)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[top(i)] = min(low.get(top(i), r[0]), r[0])
    return [(r[0], n, low.get(top(i)), r[0] == low.get(top(i))) for i, (r, n) in enumerate(zip(rows, links))]


def vector_rows(n=60, size=24):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        v = rng.normal(size=size)
        for _ in range(int(rng.integers(1, 5))):
            w = v + rng.normal(size=size) * rng.choice([0.0, 0.1, 0.25, 0.33])
            rows.append((len(rows), np.float32(w).tolist(), int(i % 3)))
    bad = [None, [], [0.0] * size, [None] + [1.0] * (size - 1), [float("nan")] * size, [float("inf")] + [0.0] * (size - 1)]
    rows += [(1000 + i, v, 1) for i, v in enumerate(bad)]
    rows += [(1100, rows[0][1], None), (1101, rows[0][1][:10], 0), (1102, [2 * x for x in rows[0][1]], 0), (None, rows[0][1], 0), (None, [-x for x in rows[0][1]], 0)]
    rows += [(1103, rows[5][1], rows[5][2]), (1103, rows[5][1], rows[5][2]), (1104, [1e30] * size, 2), (1105, [1e-30] * size, 2)]
    return rows


@pytest.mark.parametrize("crowd, unit", [(20_000, 1 << 20), (3, 100)])
def test_vectors_link_as_all_pairs_do(spark, crowd, unit):
    rows = vector_rows()
    docs = spark.createDataFrame(rows, VECTORS).repartition(5)
    for name in ("leaf", "key", "node", "n", "a", "kept"):
        docs = docs.withColumn(name, F.lit(1))
    got = polytope.near_duplicates(docs, crowd=crowd, unit=unit)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute_links(rows), key=repr)


def test_no_vectors(spark):
    assert polytope.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0


def test_a_third_of_equal_vectors_and_a_dense_cluster(spark):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=32)
    rows = [(i, np.float32(centre).tolist(), 0) for i in range(300)]
    rows += [(300 + i, np.float32(centre + rng.normal(size=32) * 0.02).tolist(), 0) for i in range(300)]
    rows += [(600 + i, np.float32(rng.normal(size=32)).tolist(), 0) for i in range(300)]
    docs = spark.createDataFrame(rows, VECTORS).repartition(8)
    edges = polytope.candidates(polytope._usable(docs, "vec_id", "embedding", "label"))
    assert edges.count() <= 15 * 301
    got = {r["vec_id"]: r for r in polytope.near_duplicates(docs, crowd=40, unit=1000).collect()}
    assert {got[i]["n_links"] for i in range(600)} == {599}
    assert {got[i]["component_id"] for i in range(600)} == {0} and sum(r["kept"] for r in got.values()) == 301


@pytest.mark.parametrize("size", [1, 3, 64, 100, 384])
def test_recall_of_the_buckets(size):
    """Pairs at the limit itself share a bucket."""
    rng = np.random.default_rng(size)
    a = rng.normal(size=(2000, size))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=a.shape)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    if size > 1:
        b /= np.linalg.norm(b, axis=1, keepdims=True)
    b = 0.93 * a + math.sqrt(1 - 0.93**2) * b if size > 1 else a * 3
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    p, q = polytope.buckets(a), polytope.buckets(b)
    met = np.array([len(np.intersect1d(x, y)) > 0 for x, y in zip(p, q)])
    near = np.bitwise_count(polytope.sketches(a) ^ polytope.sketches(b)).sum(axis=1) <= polytope.BITS
    assert (met & near).mean() > 0.98


def test_the_fast_transform_is_the_matrix_product():
    m = np.array([[1.0]])
    while len(m) < 16:
        m = np.block([[m, m], [m, -m]])
    x = np.random.default_rng(1).normal(size=(7, 16))
    assert np.allclose(polytope.hadamard(x), x @ m)


# --- filter audit ---------------------------------------------------------------


def test_audit_counts_every_order(spark, odd):
    import re

    rows = odd_rows() + [(20, "WORD " * 5 + prose(6, 130), None, "x", 1), (21, prose(6, 130) + " #", "de", "x", 1), (22, prose(6, 130) + " #", "de", "x", 1)]
    labels = [(1, 1, 0), (2, 0, 1), (7, 1, 1), (7, 0, 0), (11, None, 1), (20, 1, None), (22, 1, 1), (None, 1, 1)]
    got = audit.audit(spark.createDataFrame(rows, odd.schema).withColumn("mask", F.lit(1)).withColumn("digest", F.lit(2)), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    docs = []
    for i, text, lang, *_ in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        copied = i is not None and any(o[0] is not None and o[0] < i and (o[1] or "") == t for o in rows)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": copied}
        docs.append((lang or "", {f for f, yes in fails.items() if yes}, i in good, i in toxic))
    want, shapley = [], Counter()
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                out = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[part, f] += len(out)
                again = sum(f in d[1] for d in own) - len(out)
                want.append((part, order, step, len(left), len(out), again, sum(d[1] == {f} for d in own), sum(d[2] for d in out), sum(d[3] for d in out)))
    want = [(*r, shapley[r[0], r[1][r[2] - 1]]) for r in want]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_audit_of_nothing(spark, nothing):
    assert audit.audit(nothing, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def test_paths_are_counted_both_ways():
    forward, backward = audit.path_counts(5)
    assert forward[31] == backward[0] == 120
    for size in range(6):
        assert sum(forward[s] * backward[s] for s in range(32) if s.bit_count() == size) == 120
    with pytest.raises(ValueError):
        audit.orders(None, "ABCDEFGH")


# --- token alignment ------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(alignment.tokenizer_path(alignment.BYTE_LEVEL))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=alignment.tokenizer_path(alignment.PIECES))


def token_bytes(tokenizers):
    letters = alignment.byte_letters()
    a, b = tokenizers
    name = b.id_to_piece
    return (
        lambda i: bytes(letters[c] for c in a.id_to_token(i)),
        lambda i: bytes([int(name(i)[3:5], 16)]) if b.is_byte(i) else name(i).replace("▁", " ").encode(),
    )


def brute_alignment(tokenizers, texts):
    """Links from the byte ranges of all pairs of tokens."""
    of_a, of_b = token_bytes(tokenizers)
    docs = []
    for text in texts:
        a = tokenizers[0].encode(" " + text, add_special_tokens=False).ids if text else []
        b = tokenizers[1].encode(text) if text else []
        raw = (" " + text).encode() if text else b""
        x, y = [of_a(i) for i in a], [of_b(i) for i in b]
        if b"".join(x) != raw or b"".join(y) != raw:
            a, b, x, y = [], [], [], []
        ends = [np.cumsum([len(t) for t in side], dtype=int).tolist() for side in (x, y)]
        links = []
        for i, p in enumerate(a):
            for j, q in enumerate(b):
                if max(ends[0][i] - len(x[i]), ends[1][j] - len(y[j])) < min(ends[0][i], ends[1][j]):
                    links.append((p, q))
        common = sorted(set(ends[0]) & set(ends[1]))
        groups = [[[], []] for _ in common]
        for side, ids in enumerate((a, b)):
            for i, end in zip(ids, ends[side]):
                groups[next(k for k, c in enumerate(common) if end <= c)][side].append(i)
        written = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        docs.append((a, b, groups, links, hashlib.sha256(written.encode()).hexdigest() if a else ""))
    counts = Counter(pair for d in docs for pair in d[3])
    best = {}
    for (_, q), n in counts.items():
        best[q] = max(best.get(q, 0), n)
    return [
        (len(a), len(b), len(g), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links), sha)
        for a, b, g, links, sha in docs
    ]


ODD_TEXTS = [
    "plain words, plain words", " leading blank", "two  blanks   three", "end ", "tab\tand\nline\n\n next", "\n", "   ", "<|endoftext|> <s> </s> <unk>x",
    "naïve ﬁne Å ½ ①", "日本語 テキスト", "a▁b", "emoji 👩‍👩‍👧 🙂", "x y z \u0085w", "\x00\x01 nul", "don't we'll they're 12345 6.7e-8", "A" * 300, "é combining", " ́x",
]


@pytest.mark.parametrize("links", [alignment.CHUNK_LINKS, 300])
def test_alignment_as_all_token_pairs(spark, tokenizers, links):
    texts = [r[1] if r[1] is None or len(r[1]) < 5000 else r[1][:3000] for r in odd_rows()] + ODD_TEXTS
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3).withColumn("pairs", F.lit(1)).withColumn("chunk", F.lit("x"))
    got = {r["doc_id"]: r for r in alignment.document_links(docs, links=links).collect()}
    for i, want in enumerate(brute_alignment(tokenizers, texts)):
        row = got[i]
        assert (row["n_a"], row["n_b"], row["n_groups"], row["n_links"], row["n_best"], row["count_sum"], row["groups_sha256"]) == want, texts[i]


def test_ranks_give_the_ids_of_the_tokenizer(tokenizers):
    side = alignment.ByteLevel(alignment.tokenizer_path(alignment.BYTE_LEVEL))
    rng = random.Random(4)
    letters = "abst é\n\t  .,'0½▁日 ́Aßжλ–’\u0085\xa0ſǅ"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 40))) for _ in range(4000)] + ["x" * 3000, "<|endoftext|>"]
    assert side.quick and sum(bool(alignment._PLAIN.fullmatch(t)) for t in texts) > 100
    for text in texts:
        assert side.encode(text) == tokenizers[0].encode(text, add_special_tokens=False).ids, repr(text)


def test_groups_cover_the_text(spark, odd, nothing, tokenizers):
    of_a, of_b = token_bytes(tokenizers)
    for row in alignment.groups(odd.filter("length(text) < 5000")).join(odd.select("doc_id", "text").distinct(), "doc_id").collect():
        made = b""
        for g in row["groups"]:
            assert len(made) == g["start"]
            piece = b"".join(map(of_a, g["a"]))
            assert piece == b"".join(map(of_b, g["b"]))
            made += piece
        assert made == ((" " + row["text"]).encode() if row["text"] else b"")
    assert alignment.document_links(nothing).count() == alignment.groups(nothing).count() == 0


def test_links_of_a_group_with_several_on_both_sides():
    # bytes: a = 2 + 3 + 1, b = 1 + 3 + 2, and a second text without tokens, and a third
    made = alignment.Alignment([[0, 1, 2], [], [0]], [[3, 4, 5], [], [3, 3]], np.array([2, 3, 1]), np.array([0, 0, 0, 1, 3, 2]))
    assert [(p >> 32, p & 0xFFFFFFFF) for p in made.pairs.tolist()] == [(0, 3), (0, 4), (1, 4), (1, 5), (2, 5), (0, 3), (0, 3)]
    names = np.array([[f"{i},|"[:2] for i in range(6)], [f"{i}|" for i in range(6)]], dtype=object), np.array([[f"{i}," for i in range(6)], [f"{i};" for i in range(6)]], dtype=object)
    assert made.written(*names) == ["0,1,2|3,4,5", "", "0|3,3"]
    assert made.first_group.tolist() == [0, 1, 1, 2] and made.first_link.tolist() == [0, 5, 5, 7]
