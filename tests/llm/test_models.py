"""Toxicity, licences, packing and the pipeline."""

import random
import zlib
from collections import defaultdict

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hazardlake.llm import decontamination, language, licenses, lines, packing, queries, toxicity

from .conftest import odd_rows, prose
from .test_dedup import brute_near

# --- toxicity ---------------------------------------------------------------


def brute_kernel(s, t):
    """Weighted common subsequences of length 3 and 4, by listing all."""

    def vector(w):
        out = defaultdict(float)
        for gaps in toxicity.PATTERNS:
            steps = np.cumsum([0, *(g + 1 for g in gaps)])
            for i in range(len(w) - steps[-1]):
                out["".join(w[i + k] for k in steps)] += toxicity.DECAY ** sum(gaps)
        return out

    a, b = vector(s), vector(t)
    return sum(v * b[k] for k, v in a.items() if k in b)


def test_kernel_is_that_of_listed_subsequences():
    words = ["idiot", "idixot", "worthless", "ab", "aaaa", "tidiots"]
    t = toxicity.Tokens(pa.array(words, pa.string()))
    for one in words:
        w = toxicity.Weights.zero()
        codes = np.array([toxicity.BORDER, *(ord(c) - 97 for c in one), toxicity.BORDER])
        w.add(codes, 1.0)
        norm = toxicity.norms(np.array([0]), np.array([len(one) + 2]))[0]
        got = w.score(t.code, t.start, t.end) * toxicity.norms(t.start, t.end) * norm
        assert got == pytest.approx([brute_kernel(f"^{one}^", f"^{x}^") for x in words], rel=1e-4, abs=1e-4)


def read_tokens(texts):
    """Words as text: accents and hashed letters by their code, the border as ^."""
    t = toxicity.Tokens(pa.array(texts, pa.string()))
    signs = {toxicity.BORDER: "^", **{26 + k: f"<{k}>" for k in range(toxicity.ACCENTS)}}
    return ["".join(chr(97 + c) if c < 26 else signs.get(c, "?") for c in t.code[a:b]) for a, b in zip(t.start, t.end)], np.diff(t.first).tolist()


def test_tokens_fold_case_marks_and_lone_letters():
    words, counts = read_tokens(["A*b i d i o t!", None, "", "4b5 \u2014\u2019", "日本 x", "a" * 60])
    assert words == ["^ab^", "^idiot^", "^abs^", "^??^", "^x^", "^" + "a" * 23, "a" * 24, "a" * 23 + "^"]
    assert counts == [2, 0, 0, 1, 2, 3]


def test_accents_follow_their_letters_and_other_scripts_are_told_apart():
    words, _ = read_tokens(["réêou", "RÉÊOU", "reeou", "re\u0301e\u0302ou"])
    assert words[0] == words[1] == words[3] and words[2] == "^reeou^"
    assert words[0][:3] == "^re" and words[0].endswith(">ou^") and len(set(words[0].replace("<", ">").split(">")) & set("01234")) == 2
    t = toxicity.Tokens(pa.array(["дурак ДУРАК добро κακός καλός 馬鹿 日本"], pa.string()))
    codes = [tuple(t.code[a:b]) for a, b in zip(t.start, t.end)]
    assert codes[0] == codes[1] and len(set(codes)) == 6


def test_pieces_of_long_words_share_every_subsequence():
    word = "".join(chr(97 + (i * 7 + i // 5) % 26) for i in range(90))
    t = toxicity.Tokens(pa.array([word], pa.string()))
    span = max(sum(g + 1 for g in gaps) + 1 for gaps in toxicity.PATTERNS)
    assert len(t.start) > 3 and (t.end[:-1] - t.start[1:] >= span - 1).all() and t.end[-1] == len(word) + 2 and (t.end - t.start).max() == toxicity.WORD


def insulted(n, seed=3):
    rng = random.Random(seed)
    insults = ["gromble", "vaxidon", "plurkish"]
    rows = []
    for i in range(n):
        text, bad = prose(seed * 10_000 + i, 60).split(), i % 3 == 0
        if bad:
            word = rng.choice(insults)
            at = rng.randrange(1, len(word))
            text.insert(rng.randrange(60), rng.choice([word, word.upper(), word + rng.choice(["ed", "ing", "s"]), word[:at] + "." + word[at:], word[:at] + "x" + word[at:]]))
        rows.append((i, " ".join(text), int(bad)))
    return rows


def test_held_out_insults_are_found(spark):
    rows = insulted(900) + [(5000, None, None), (5001, "", None), (5002, "!!! 日本", None)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if y is not None] + [(None, 1), (7, None)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.train_and_score(docs, labels).collect()}
    held = [(got[i]["predicted"], y) for i, _, y in rows[:900] if got[i]["held_out"]]
    assert len(held) > 100 and np.mean([p == y for p, y in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert all(got[i]["predicted"] == 0 for i in (5000, 5001, 5002))


def of_language(n, letters, seed):
    """Texts of invented words of some letters, a third of them with two of a few words that begin with one stem."""
    rng = random.Random(seed)
    parts = ["".join(rng.choice(letters) for _ in range(rng.choice([2, 3]))) for _ in range(24)]
    stem, rows = "".join(rng.sample(parts, 2)), []
    for i in range(n):
        words, bad = ["".join(rng.choices(parts, k=rng.choice([1, 2, 2, 3]))) for _ in range(rng.randrange(30, 200))], i % 3 == 0
        words = [w for w in words if not w.startswith(stem)]
        for _ in range(3 * bad):
            words.insert(rng.randrange(len(words)), stem + rng.choice(parts[:8]))
        rows.append((" ".join(words), bad))
    return rows


def test_insults_of_rare_languages_are_found(spark):
    """Four languages in unequal shares, one beyond Latin letters, one told apart by accents only."""
    texts = {"common": insulted(900), "accents": of_language(150, "aeéèêlrtu", 5), "stems": of_language(150, "aeichlnkst", 6), "cyrillic": of_language(150, "абвгдежзиклмноп", 7)}
    rows = [(kind, r[-2], int(r[-1])) for kind, some in texts.items() for r in some]
    docs = spark.createDataFrame([(i, t) for i, (_, t, _) in enumerate(rows)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, _, y) in enumerate(rows)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["predicted"] for r in toxicity.train_and_score(docs, labels).collect() if r["held_out"]}
    for kind in texts:
        toxic = [p for i, p in got.items() if rows[i][0] == kind and rows[i][2]]
        assert len(toxic) >= 5 and np.mean(toxic) >= 0.9, kind
    assert np.mean([p for i, p in got.items() if not rows[i][2]]) <= 0.02


def test_copies_among_training_documents_count_once():
    texts = [prose(i, 60) for i in range(6)] + ["a b", "a b", "", None, "é ß"]
    texts += [texts[0] + " more words", texts[1], texts[1]]
    toxic = np.array([i % 2 == 0 for i in range(11)] + [True, False, True])
    assert toxicity.without_copies(texts, toxic).tolist() == [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 13]


def test_labels_of_one_class_or_none(spark, odd, nothing):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.train_and_score(odd, none).filter("predicted = 1").count() == 0
    assert toxicity.train_and_score(odd, spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, toxic int")).filter("predicted = 0").count() == 0
    assert toxicity.train_and_score(nothing, none).count() == 0


# --- licences ---------------------------------------------------------------

NOTICES = {
    "Licensed under CC BY-NC 4.0.": "cc",
    "All rights reserved.": "proprietary",
    "Released under the MIT License.": "mit",
    "Licensed under the Apache License, Version 2.0.": "apache",
    "This work is licensed under the GNU General Public License, version 3.": "gpl",
    "redistribute it and/or modify it under the terms of the GNU General": "gpl",
    "You may not use this file except in compliance with the License": "apache",
}


def test_notices_are_found_and_prose_is_left(spark):
    rows = [(i, prose(i, 40) + "\n" + n + "\n" + prose(900 + i, 40)) for i, n in enumerate(NOTICES)]
    rows += [(100 + i, prose(300 + i, 80)) for i in range(150)] + [(400, None), (401, ""), (402, "She has a license to drive. The public was free to come.")]
    got = {r["doc_id"]: r for r in licenses.train_and_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    confirmed = {i: {f["family"] for f in r["found"] if f["confirmed"]} for i, r in got.items()}
    assert [confirmed[i] for i in range(len(NOTICES))] == [{f} for f in NOTICES.values()]
    assert all(not confirmed[i] for i in confirmed if i >= 100)
    assert got[400]["n_units"] == got[401]["n_units"] == 0 and got[402]["n_units"] == 2


def test_held_out_variants_are_classified():
    model = licenses.train([prose(i, 9) for i in range(2000)])
    texts, classes = licenses.examples(seed=99)
    u = licenses.Units(pa.array([t or "x" for t in texts], pa.large_string()))
    got = model.probabilities(*u.features(), len(u)).argmax(axis=1)
    family = classes < len(licenses.FAMILIES)
    assert (got == classes)[family].mean() > 0.9


def test_licences_of_odd_rows(odd, nothing):
    assert licenses.train_and_scan(odd).count() == len(odd_rows())
    assert licenses.train_and_scan(nothing).count() == 0


# --- packing ----------------------------------------------------------------

TEXTS = ["", None, "It's I'M don't WE'LL x'd 's", "á éclair é", "İstanbul ΣΑΣ ﬁ ½ ²", "<|endoftext|> x<|startoftext|>y", "ab\x1cc\x85d e", "naïve—test… “q”", "123 4.5 a1b2", "日本語", "ÀÉÎ×÷ßÿ", "x" * 5000, "_a_b__ %%%", "\ttab\r\nnl", "ȩ́", "a\ńb"]


def test_ids_are_the_tokenizers():
    path = packing.tokenizer_path()
    tokenizer = Tokenizer.from_file(path)
    texts = [*TEXTS, *[r[1] for r in odd_rows()]]
    want = [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4").tobytes() for t in texts]
    encoder = packing.Encoder(path)
    assert encoder.encode(texts) == want and encoder.encode(texts) == want


def check_packing(rows, ids, capacity=2048):
    """Every id lies in one piece, sequences have no gaps; returns the share of padding."""
    at, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        at[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for key, own in ids.items():
        pieces = sorted(at.pop(key))
        copies = sum(1 for p in pieces if p[0] == 0)
        assert sum(p[1] for p in pieces) == copies * len(own)
        for start, n, crc in pieces:
            assert zlib.crc32(np.array(own[start : start + n], dtype="<u4").tobytes()) == crc
    assert not at
    padded = tokens = 0
    for pieces in sequences.values():
        end = 0
        for offset, n in sorted(pieces):
            assert offset == end
            end += n
        assert end <= capacity
        tokens += end
        padded += 0 if end & (end - 1) == 0 else capacity - end
    return padded / max(1, tokens + padded)


def test_every_id_is_packed_once(spark, odd, nothing):
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    ids = {r[0]: [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1] for r in odd_rows()}
    check_packing(queries.packed(odd).collect(), ids)
    assert queries.packed(nothing).count() == 0
    many = [(i, prose(i, random.Random(i).randint(1, 600))) for i in range(600)]
    ids = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for i, t in many}
    assert check_packing(queries.packed(spark.createDataFrame(many, "doc_id long, text string")).collect(), ids) < 0.05


def test_sum_of_squares_choice_is_the_best_of_all():
    rng = random.Random(4)
    levels = packing.Levels(64)
    for _ in range(500):
        size = rng.randint(1, 64)
        before = levels.count.copy()

        def cost(level):
            after = before.copy()
            if level:
                after[level] -= 1
            if level + size < 64:
                after[level + size] += 1
            return int((after[1:64] ** 2).sum())

        best = min(cost(h) for h in range(65 - size) if h == 0 or before[h])
        levels.place(size)
        assert int((levels.count[1:64] ** 2).sum()) == best


def test_sequences_hold_their_pieces(spark):
    docs = spark.createDataFrame([(i, prose(i, 300)) for i in range(12)], "doc_id long, text string")
    placed = packing.place_pieces(packing.cut_pieces(docs), 1)
    ids = {r["doc_id"]: r["ids"] for r in packing.cut_pieces(docs).collect() if r["length"] == r["doc_tokens"]}
    for r in packing.sequences(placed).collect():
        total = r["tokens"]
        assert len(r["ids"]) == 4 * (total if total & (total - 1) == 0 else 2048)
        for d in r["docs"]:
            if d["doc"] in ids:
                assert r["ids"][4 * d["offset"] : 4 * (d["offset"] + d["length"])] == ids[d["doc"]]


# --- pipeline ---------------------------------------------------------------


def test_pieces_are_placed_online(spark):
    """What comes later does not move a piece, and few windows are left open."""
    rng = np.random.default_rng(12)
    rows = [(i, 0, int(n)) for i, n in enumerate(rng.integers(1, 701, 3000))]
    pieces = spark.createDataFrame(rows, "doc_id long, start long, length long")
    whole = {r.doc_id: (r.sequence_id, r.offset) for r in packing.place_pieces(pieces, 1).collect()}
    early = packing.place_pieces(pieces.filter("doc_id < 1000").repartition(5), 1).collect()
    assert len(early) == 1000 and all(whole[r.doc_id] == (r.sequence_id, r.offset) for r in early)
    windows = len({w for w, _ in whole.values()})
    assert sum(n for *_, n in rows) / (windows * 2048) > 0.98


def test_stages_are_the_five_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontaminate", "pack"]


def test_stages_keep_columns_and_act(spark, clashing, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(1, prose(3, 12))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = clashing
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = f"{folder}/{name}"
        stage(spark, docs, folder).write.parquet(out)
        docs = spark.read.parquet(out)
        if name != "pack":
            assert docs.columns == clashing.columns
        seen.append({r["doc_id"] for r in docs.select("doc_id").collect()})
    assert seen[0] == {1, 2, 6, None, 8, 9, 10, 11, 12}  # no letters, or (7) far from the one learned language: gone
    assert 8 not in seen[2] and 1 in seen[2] and 12 not in seen[2]  # copies: gone
    assert 6 not in seen[3] and seen[3] == seen[4]  # benchmark passage: gone


def test_stages_of_nothing(spark, nothing, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, folder).count() == 0


def test_run_is_its_stages_one_after_the_other(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = corpus_pipeline.run(spark, folder)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = {i for i, t in texts.items() if any(c.isalpha() for c in t or "")}
    assert {r["doc_id"] for r in got.collect()} <= kept
    a = language.keep_identified(docs)
    b = lines.clean(a)
    rows = [(r["doc_id"], r["text"]) for r in b.collect()]
    groups = brute_near(rows)
    assert len(groups) < len(rows)
    c = b.filter(F.col("doc_id").isin([min(rows[i][0] for i in g) for g in groups]))
    d = decontamination.clean(c, spark.read.parquet(f"{folder}/benchmark.parquet"))
    want = queries.packed(d)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert {r["doc_id"] for r in a.collect()} == kept
    assert d.filter(F.col("text").isNull()).count() == 0
