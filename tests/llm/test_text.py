"""Personal data, languages, benchmark passages and repeated lines beside plain Python versions."""

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hazardlake.llm import decontamination, language, lines, pii
from hazardlake.llm.words import NOT_BLANK, SAME, Words, window_hashes, windows

from .conftest import CLASHES, odd_rows, prose

LOW = {i: i + 32 for i in range(65, 91)}
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def test_words_and_windows_are_those_of_the_pattern():
    texts = [r[1] for r in odd_rows()]
    w = Words(pa.array(texts, pa.string()), NOT_BLANK, SAME)
    want = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    assert w.counts().tolist() == [len(x) for x in want]
    assert [w.text(i, i + 1).decode() for i in range(len(w))] == [x for t in want for x in t]
    begin = windows(w.first, 13)
    hashes = window_hashes(w.hashes(), begin, 13)
    by_words = {}
    for b, h in zip(begin, hashes):
        assert by_words.setdefault(w.text(b, b + 13), h) == h
    assert len(set(by_words.values())) == len(by_words)


# --- personal data ----------------------------------------------------------


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def bare(m):
    return re.sub("[^0-9]", "", m)


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(bare(m)) <= 19 and luhn(bare(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(bare(m)) <= 15),
]

PRIVATE = [
    "a@b.com_x@c.org", "x@y..z a@b", "..a@b.c.d-", "1.2.3.4.5.6.7.8 256.1.1.1 000255.1.1.1 1.2.3", "é😀 +1 (555) 123-4567 😀 4111 1111 1111 1111",
    "4111-1111-1111-1111-", "+4 ++49 30 1234567", "a" * 30_000 + "@", "1" * 20_000, "1." * 9_000, "a@" + "b." * 9_000 + "c", "+1" + "(" * 9_000, "0000000000000",
    "1-2-3 4 5-6 7 8 9 0 1 2 3", "a@b.c a@b.c\nq@r.st,", "255.255.255.255.1 1.1.1.1.", "", None,
]


def test_base_spans_are_those_of_the_patterns(spark):
    docs = spark.createDataFrame(list(enumerate(PRIVATE)), "doc_id long, text string")
    for row in pii.find(docs).collect():
        text = PRIVATE[row["doc"]["doc_id"]] or ""
        want = [(k, m.start(), m.end(), m.group()) for k, p, ok in BASE for m in re.finditer(p, text) if ok(m.group())]
        assert [tuple(s)[:4] for s in row["spans"] if s["kind"] in dict((b[0], 0) for b in BASE)] == want


def test_further_kinds_need_checksum_or_context(spark):
    texts = ["iban GB82 WEST 1234 5698 7654 32", "iban GB82 WEST 1234 5698 7654 33", "call 555-123-4567", "part 555-123-4567", 'token = "24be64439e3e49cf46b2"']
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc"]["doc_id"]: [s["kind"] for s in r["spans"]] for r in pii.find(docs).collect()}
    assert found == {0: ["iban"], 1: [], 2: ["local_phone"], 3: [], 4: ["secret"]}
    masked = {r["doc_id"]: r["text"] for r in pii.masked(docs).collect()}
    assert masked[0] == "iban <iban>" and masked[2] == "call <local_phone>" and masked[3] == texts[3]


def test_a_long_secret_is_masked_whole(spark):
    docs = spark.createDataFrame([(0, "before token=" + "aB3/" * 400 + " after")], "doc_id long, text string")
    assert [r["text"] for r in pii.masked(docs).collect()] == ["before <secret> after"]


# --- languages --------------------------------------------------------------


def test_languages_are_told_apart_on_held_out_documents(spark):
    sounds = {"en": ["th", "er", "ing", "and", "wh"], "de": ["sch", "ung", "ein", "ch", "tz"], "fr": ["eau", "oi", "eux", "qu", "é"]}
    rng = np.random.default_rng(3)
    rows = [(i, " ".join("".join(rng.choice(s, 3)) for _ in range(40)), lang) for i, (lang, s) in enumerate(list(sounds.items()) * 40)]
    rows += [(1000, None, "en"), (1001, "123 !?", "en"), (1002, "", None), (None, rows[0][1], "en")]
    got = {r["doc_id"]: r for r in language.learn_and_predict(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[i]["lang_pred"] == lang for i, _, lang in rows[:120])
    assert sum(got[i]["held_out"] for i in range(120)) > 10
    assert [(got[i]["lang_pred"], got[i]["score"]) for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert got[None]["lang_pred"] == "en" and not got[None]["held_out"]
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_ngrams_count_borders_and_rank_by_count_then_code():
    grams, counts = language.ngrams("Ab ab")
    a, b, edge = 97, 98, 1
    want = Counter([(a,), (b,), (a,), (b,), (edge, a), (a, b), (b, edge), (edge, a), (a, b), (b, edge), (edge, a, b), (a, b, edge), (edge, a, b), (a, b, edge)])

    def number(g):
        return sum(c << (21 * (len(g) - 1 - i)) for i, c in enumerate(g))

    assert dict(zip(grams.tolist(), counts.tolist())) == {number(g): n for g, n in want.items()}
    assert language.ranked(np.array([5, 3, 9]), np.array([1, 2, 1]), 2).tolist() == [3, 5]


def test_language_of_nothing(nothing, odd):
    assert language.learn_and_predict(nothing).count() == 0
    assert {r["lang_pred"] for r in language.predict(odd, {}).collect()} == {"und"}


# --- benchmark passages -----------------------------------------------------


def brute_hits(docs, items, n=10):
    known = {}
    for item, text in items:
        w = ALNUM.findall((text or "").translate(LOW))
        if w and len(w) < n:
            known.setdefault(tuple(w), set()).add(item)
        for i in range(len(w) - n + 1):
            known.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for doc_id, text in docs:
        w = ALNUM.findall((text or "").translate(LOW))
        hit, found = set(), set()
        for size in {len(k) for k in known}:
            for i in range(len(w) - size + 1):
                if (k := tuple(w[i : i + size])) in known:
                    hit |= set(range(i, i + size))
                    found |= {str(x) for x in known[k] if x is not None}
        out.append((doc_id, len(w), len(hit), sorted(found), bool(hit)))
    return out


ITEMS = [(1, prose(1, 14)), (2, "One, TWO; three"), (3, None), (4, ""), (5, "é"), (None, prose(4, 12)), (1, prose(1, 14))]


@pytest.mark.parametrize("block", [3, 10_000])
def test_hits_are_those_of_all_windows(spark, odd, block):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = [tuple(r) for r in decontamination.report(odd, items, block_windows=block).collect()]
    want = brute_hits([r[:2] for r in odd_rows()], ITEMS)
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_clean_keeps_columns_and_cuts_passages(spark, clashing):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    left = decontamination.clean(clashing, items)
    assert left.columns == clashing.columns and {r["doc_id"] for r in left.collect()} == {3, 4, 5, 6, 11, 12}
    passage = prose(50, 12)
    docs = spark.createDataFrame([(1, f"Before, {passage.upper()}! After.")], "doc_id long, text string")
    cut = decontamination.clean(docs, spark.createDataFrame([(1, passage)], "item_id long, text string"), remove="spans")
    assert cut.first()["text"] == "Before, ! After."


def test_empty_tables(spark, odd, nothing):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontamination.report(nothing, items).count() == 0
    assert decontamination.report(odd, items.limit(0)).filter("contaminated").count() == 0
    assert pii.find(nothing).count() == 0 and pii.find(odd).count() == len(odd_rows())
    assert lines.drop_repeated_lines(nothing).count() == 0


# --- repeated lines ---------------------------------------------------------

LINES = [(i, "\n".join([" Common LINE\t" if i % 2 else "common line", f"own {i}", "", "twice", "twice"][: 3 + 2 * (i < 4)])) for i in range(12)] + [(50, None), (51, ""), (52, "\n\n")]


def brute_lines(docs, least=10):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOW)

    count = Counter(k for _, t in docs for k in {key(x) for x in (t or "").split("\n")} if k)
    out = []
    for i, t in docs:
        own = (t or "").split("\n")
        kept = [x for x in own if count[key(x)] < least]
        out.append((i, None if t is None else "\n".join(kept), len(own), len(own) - len(kept)))
    return out


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0}, {"shard_keys": 1}])
def test_frequent_lines_go(spark, options):
    docs = spark.createDataFrame(LINES, "doc_id long, text string")
    got = [(r["doc"]["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in lines.drop_repeated_lines(docs, **options).collect()]
    assert sorted(got, key=repr) == sorted(brute_lines(LINES), key=repr) and any(r[3] for r in got)


def test_clean_lines_keep_columns_and_nulls(spark, clashing):
    got = lines.clean(clashing, min_documents=2)
    assert got.columns == clashing.columns
    rows = {r["doc_id"]: r for r in got.collect()}
    assert rows[3]["text"] is None and rows[11]["text"] == "" and rows[11]["n_chars"] == 0


def test_deletion_undoes_insertion(spark):
    docs = spark.createDataFrame(LINES, "doc_id long, text string")
    more = spark.createDataFrame([(100 + i, "common line\nnew line") for i in range(11)], "doc_id long, text string")
    before = lines.line_counts(docs)
    grown = lines.add(before, more)
    back = lines.delete(grown, more)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, before.collect()))

    shards = 2
    first = lines.build_filters(before.filter("refs >= 10"), shards)
    wide = lines.update_filters(first, before, grown, shards)
    new_key = lines.key_of(b"new line")
    common = lines.key_of(b"Common line ")
    assert lines.FilterSet(first.collect()).claims([common, new_key]).tolist() == [True, False]
    assert lines.FilterSet(wide.collect()).claims([common, new_key]).tolist() == [True, True]
    narrow = lines.update_filters(wide, grown, back, shards)
    assert lines.FilterSet(narrow.collect()).claims([common, new_key]).tolist() == [True, False]


def test_cuckoo_filter_never_forgets_and_deletes():
    keys = [hashlib.blake2b(str(i).encode(), digest_size=16).digest() for i in range(3000)]
    small = lines.CuckooFilter(np.zeros((256, 4), dtype=np.uint16), set())
    for k in keys[:1200]:
        small.insert(k)
    assert small.stash  # more than it has room for
    assert lines.FilterSet([small.row(0, 1)]).claims(keys[:1200]).all()
    for k in keys[:600]:
        small.delete(k)
    assert lines.FilterSet([small.row(0, 1)]).claims(keys[600:1200]).all()
    assert lines.FilterSet([small.row(0, 1)]).claims(keys[1200:]).mean() < 0.02
    with pytest.raises(KeyError):
        lines.CuckooFilter.sized(10).delete(keys[0])


def test_false_claims_are_listed(spark):
    class Everything:
        value = type("All", (), {"claims": staticmethod(lambda keys: np.ones(len(keys), dtype=bool))})

    counts = lines.line_counts(spark.createDataFrame(LINES, "doc_id long, text string"))
    wrong = lines.exceptions(counts, Everything, 10)
    assert wrong.count() == counts.filter(F.col("refs") < 10).count()


def test_clashing_names_are_harmless(clashing):
    kept = language.keep_identified(clashing)
    assert kept.columns == clashing.columns and set(CLASHES) <= set(kept.columns)
    assert pii.masked(clashing).columns == clashing.columns


def brute_language(text, profiles):
    """Out-of-place distances in a plain loop."""
    line = re.sub(r"[^a-zäöüß]+", " ", f" {text.lower()} ")
    counts = Counter(line[i : i + n] for n in (1, 2, 3) for i in range(len(line) - n + 1))
    grams = [g for g in counts if g != " " and (len(g) < 3 or g[1] != " ")]
    rank = sorted(grams, key=lambda g: (-counts[g], [ord(c) if c != " " else 1 for c in g] if len(g) == 3 else [0] * (3 - len(g)) + [ord(c) if c != " " else 1 for c in g]))[:300]
    longest = max(map(len, profiles.values()))
    out = {}
    for name, theirs in profiles.items():
        total = 0
        for i, g in enumerate(rank):
            total += min(abs(theirs.index(g) - i), longest) if g in theirs else longest
        out[name] = total / (longest * len(rank))
    return out


def test_distances_are_those_of_a_plain_loop(spark):
    docs = spark.createDataFrame([(i, prose(i, 60, letters), lang) for i in range(8) for letters, lang in (("aeinrst", "x"), ("aeglouü", "y"))], "doc_id long, text string, lang string")
    learned = language.learn(docs)

    def written(gram):
        parts = [gram >> 42, gram >> 21 & 0x1FFFFF, gram & 0x1FFFFF]
        return "".join(" " if c == 1 else chr(c) for c in parts if c)

    profiles = {name: [written(g) for g in grams.tolist()] for name, grams in learned.items()}
    model = language.Profiles(learned)
    for text in (prose(50, 80, "aeinrst"), prose(51, 3, "aeglouü"), "Riese, nass! 12 x", prose(52, 90, "zwvq")):
        want = brute_language(text, profiles)
        name, score, away = model.nearest(text)
        best, second = sorted(want.values())
        assert name == min(want, key=lambda k: (want[k], k)) and away == pytest.approx(best) and score == pytest.approx(1 - best / second)


def test_documents_of_other_languages_go(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    others = [
        (-1, "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.", None),
        (-2, "Все люди рождаются свободными и равными в своем достоинстве и правах.", None),
        (-3, "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。", None),
        (-4, "12 34 !?", None),
    ]
    rows = docs.unionByName(spark.createDataFrame(others, docs.schema))
    kept = language.keep_identified(rows)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in docs.collect() if any(c.isalpha() for c in r["text"] or ""))
    german = {r["doc_id"] for r in language.keep_identified(rows, languages=("de",)).collect()}
    assert german == {r["doc_id"] for r in docs.collect() if r["lang"] == "de"}
