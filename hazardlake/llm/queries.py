"""One query for each operator, over whole tables, and the SQL where it can say the same."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlake.llm import alignment, audit, decontamination, language, licenses, lines, packing, pii, polytope, simhash, sketches, substring, toxicity
from hazardlake.plans.registry import Job
from hazardlake.session import ship_package
from hazardlake.sources.tables import read_table

QUERIES: dict[str, Job] = {}
SQL: dict[str, str] = {}


def query(fn: Job) -> Job:
    @wraps(fn)
    def shipped(spark: SparkSession, folder: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, folder)

    QUERIES[fn.__name__] = shipped
    return shipped


# The folding of A-Z and the blanks of the texts, as DuckDB writes them.
_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_ALNUM_WORDS = f"regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_BARE_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"

SQL["op7_substring_dedup"] = f"""
WITH d AS (SELECT doc_id, {_BARE_WORDS} AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
sources AS (SELECT win, min(doc_id) AS source FROM windows GROUP BY 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS pos FROM windows JOIN sources USING (win) WHERE source < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d),
left_over AS (SELECT words.doc_id, count(*) AS n_words, count(gone.pos) AS n_removed,
coalesce(string_agg(word, ' ' ORDER BY words.pos) FILTER (WHERE gone.pos IS NULL), '') AS kept
FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.pos = gone.pos GROUP BY 1)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN left_over USING (doc_id)"""

SQL["op9_decontamination"] = f"""
WITH d AS (SELECT doc_id, {_ALNUM_WORDS} AS w FROM documents), b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_ALNUM_WORDS} AS w FROM benchmark),
known AS (SELECT item, len(w) AS n, array_to_string(w, ' ') AS win FROM b WHERE len(w) BETWEEN 1 AND 9
UNION SELECT item, 10 AS n, array_to_string(w[i:i + 9], ' ') FROM (SELECT item, w, unnest(range(1, len(w) - 8)) AS i FROM b WHERE len(w) >= 10)),
sizes AS (SELECT DISTINCT n FROM known),
windows AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes)),
hits AS (SELECT doc_id, i, windows.n, item FROM windows JOIN known ON windows.win = known.win AND windows.n = known.n),
positions AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM hits) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY 1)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN positions USING (doc_id) LEFT JOIN items USING (doc_id)"""

SQL["op10_line_dedup"] = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS w FROM documents),
l AS (SELECT doc_id, unnest(w) AS line, unnest(range(len(w))) AS i FROM d),
k AS (SELECT *, {_FOLD.format(f"trim(line, {_BLANKS})")} AS bare FROM l),
frequent AS (SELECT bare FROM k WHERE bare <> '' GROUP BY 1 HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(frequent.bare) AS n_dropped,
sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE frequent.bare IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN frequent ON k.bare = frequent.bare GROUP BY 1"""


SQL["op11_embedding_near_dedup"] = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS size FROM v
WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
pairs AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u AS a JOIN u AS b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
WHERE list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.93),
reached AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reached.a, pairs.b FROM reached JOIN pairs ON reached.b = pairs.a),
links AS (SELECT a, count(*) AS n FROM pairs GROUP BY 1),
least AS (SELECT a, min(b) AS component_id FROM reached GROUP BY 1)
SELECT v.vec_id, coalesce(n, 0) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN least ON v.vec_id = least.a LEFT JOIN links ON v.vec_id = links.a"""

SQL["op12_filter_audit"] = f"""
WITH w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, {_BARE_WORDS} AS words FROM documents),
marked AS (SELECT doc_id, part, CASE WHEN len(words) < 100 THEN 1 ELSE 0 END
+ CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END
+ CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 4 ELSE 0 END
+ CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
+ CASE WHEN min(doc_id) OVER (PARTITION BY t) < doc_id THEN 16 ELSE 0 END AS mask FROM w),
known AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY 1),
cells AS (SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic FROM marked LEFT JOIN known USING (doc_id) GROUP BY 1, 2),
f(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
FROM f AS a, f AS b, f AS c, f AS d, f AS e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (SELECT filter_order, step, bits[step] AS bit, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INTEGER) AS state FROM orders, (SELECT unnest(range(1, 6)) AS step)),
counted AS (SELECT part, filter_order, step, bit,
sum(CASE WHEN mask & (state | bit) = 0 THEN n ELSE 0 END) AS kept, sum(CASE WHEN mask & bit <> 0 AND mask & state = 0 THEN n ELSE 0 END) AS removed,
sum(CASE WHEN mask & bit <> 0 AND mask & state <> 0 THEN n ELSE 0 END) AS redundant, sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
sum(CASE WHEN mask & bit <> 0 AND mask & state = 0 THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN mask & bit <> 0 AND mask & state = 0 THEN toxic ELSE 0 END) AS toxic_lost
FROM cells, steps GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM counted"""


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "documents")


def sha256(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


@query
def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    rows = decontamination.report(documents(spark, folder), read_table(spark, folder, "benchmark"))
    return rows.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        sha256(F.array_join("items", ",")).alias("items_sha256"),
        "contaminated",
    )


@query
def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = lines.drop_repeated_lines(documents(spark, folder).select("doc_id", "text"))
    return rows.select(F.col("doc.doc_id").alias("doc_id"), "n_lines", "n_dropped", sha256(F.coalesce("text", F.lit(""))).alias("kept_sha256"))


@query
def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed(documents(spark, folder))


def packed(docs: DataFrame) -> DataFrame:
    """Placement of every piece, with the digest of its ids instead of the ids."""
    pieces = packing.cut_pieces(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.place_pieces(pieces, packing.shards_for(docs.count()), order=("ids_crc32", "doc_tokens"))


@query
def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.learn_and_predict(documents(spark, folder))


@query
def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    rows = simhash.groups(documents(spark, folder))
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


@query
def op6_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    rows = sketches.edited_beside_next(documents(spark, folder))
    return rows.select(
        "doc_id",
        "n_chars",
        sha256(F.col("edited")).alias("edited_sha256"),
        sketches.as_text(F.col("sketch")).alias("fingerprint"),
        sketches.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


@query
def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    rows = substring.remove_repeats(docs, project=lambda made: made.withColumn("text", sha256(F.col("text"))).drop("spans"))
    return rows.select(F.col("doc.doc_id").alias("doc_id"), "n_words", "n_removed", F.col("text").alias("kept_sha256"))


@query
def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    rows = pii.find(documents(spark, folder).select("doc_id", "text"))
    base = [k.name for k in pii.KINDS if k.base]
    of_base = F.filter("spans", lambda s: s["kind"].isin(*base))
    return rows.select(
        F.col("doc.doc_id").alias("doc_id"),
        *[pii.count_of(F.col("spans"), k).alias(f"n_{k}") for k in base],
        sha256(pii.as_text(of_base)).alias("base_sha256"),
        pii.as_text(F.col("spans")).alias("spans"),
    )


@query
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.train_and_score(documents(spark, folder), read_table(spark, folder, "labels"))


@query
def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    rows = licenses.train_and_scan(documents(spark, folder))
    confirmed = F.filter("found", lambda f: f["confirmed"])
    return rows.select(
        "doc_id",
        "n_units",
        F.size(confirmed).cast("long").alias("n_notices"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(confirmed, lambda f: f["family"]))), ",").alias("families"),
        F.coalesce(F.array_max(F.transform(confirmed, lambda f: f["probability"])), F.lit(0.0)).alias("probability"),
        (F.size("found") - F.size(confirmed)).cast("long").alias("n_unconfirmed"),
    )


@query
def op11_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return polytope.near_duplicates(read_table(spark, folder, "embeddings"))


@query
def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit.audit(documents(spark, folder), read_table(spark, folder, "labels"))


@query
def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    rows = alignment.document_links(documents(spark, folder))
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
