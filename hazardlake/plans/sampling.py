"""Splits, samples, folds and rebalancing."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazardlake.operators import sampling
from hazardlake.operators.rollup import label_rollup
from hazardlake.sources.tables import read_table

from . import roles
from .registry import job
from .roles import FEATURES, draw_sql, r, rounded, with_parts


def _orders(spark, folder):
    return roles.labelled_orders(spark, folder).select("o_orderkey", "label")


_RANKED = f"SELECT o_orderkey, label, row_number() OVER ({{0}}ORDER BY {draw_sql(42, 'o_orderkey')}, o_orderkey) AS rk FROM ord"


@job(with_parts("ord", f"SELECT o_orderkey, rk > ceil((SELECT count(*) FROM ord) * CAST(0.2 AS DOUBLE)) AS is_train FROM ({_RANKED.format('')})"))
def random_split(spark, folder):
    return sampling.random_split(_orders(spark, folder), ["o_orderkey"], 0.2, 42).select("o_orderkey", "is_train")


@job(with_parts("ord", f"SELECT o_orderkey, label FROM ({_RANKED.format('')}) WHERE rk <= round((SELECT count(*) FROM ord) * CAST(0.6 AS DOUBLE))"))
def random_sample(spark, folder):
    return sampling.random_sample(_orders(spark, folder), ["o_orderkey"], 0.6, 42)


@job(with_parts("ord", f"SELECT o_orderkey, label, CAST((rk - 1) % 5 AS INTEGER) AS fold FROM ({_RANKED.format('PARTITION BY label ')})"))
def stratified_folds(spark, folder):
    return sampling.stratified_folds(_orders(spark, folder), ["o_orderkey"], "label", 5, 42)


@job(with_parts("ord", f"SELECT o_orderkey, CAST((rk - 1) % 2 AS INTEGER) AS fold FROM ({_RANKED.format('')})"))
def plain_folds(spark, folder):
    return sampling.plain_folds(_orders(spark, folder), ["o_orderkey"], 2, 42).select("o_orderkey", "fold")


@job(with_parts("ord", f"""SELECT o_orderkey, label FROM ({_RANKED.format('PARTITION BY label ')})
WHERE rk <= (SELECT min(n) FROM (SELECT count(*) AS n FROM ord GROUP BY label))"""))
def undersample(spark, folder):
    return sampling.undersample(_orders(spark, folder), ["o_orderkey"], "label", 42)


def _labelled_telemetry(spark, folder):
    """Telemetry with the emergency label and a row number as key."""
    labels = label_rollup(roles.event_log(spark, folder))
    table = roles.scored_telemetry(spark, folder).join(labels, "batch_time")
    return table.select("batch_time", F.col("is_emergency").cast("int").alias("label"), "features")


_TRAIN = f"""train AS (SELECT t.batch_time, l.label, {', '.join(f'CAST(coalesce(t.{n}, 0) AS DOUBLE) AS {n}' for n in FEATURES)}
FROM tel t JOIN (SELECT batch_time, max(CAST(is_emergency AS INTEGER)) AS label FROM elog GROUP BY 1) l ON t.batch_time = l.batch_time)"""

_RARE = "(SELECT label FROM (SELECT label, count(*) AS n FROM train GROUP BY 1 ORDER BY n, label LIMIT 1))"
_DISTANCE = " + ".join(f"(a.{n} - b.{n}) * (a.{n} - b.{n})" for n in FEATURES)
_PAIRS = f"""minority AS (SELECT *, row_number() OVER (ORDER BY batch_time) - 1 AS nth FROM train WHERE label = {_RARE}),
rep AS (SELECT *, min(nth) OVER (PARTITION BY {', '.join(FEATURES)}) AS rep FROM minority),
pairs AS (SELECT a.nth AS base, b.nth AS other, b.rep AS other_rep, {', '.join(f'b.{n} AS y_{n}' for n in FEATURES)}, {_DISTANCE} AS d
FROM rep a JOIN rep b ON a.nth <> b.nth)"""


@job(with_parts("tel elog", f""", {_TRAIN}, {_PAIRS},
near AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY d, other_rep, other) AS place FROM pairs),
size AS (SELECT count(*) FILTER (WHERE label = {_RARE}) AS n_min, count(*) FILTER (WHERE label <> {_RARE}) AS n_maj FROM train),
goal AS (SELECT n_min, CAST(floor(n_maj * 0.5) - n_min AS BIGINT) AS n_new FROM size),
turns AS (SELECT nth, row_number() OVER (ORDER BY {draw_sql('42/base', 'nth')}, nth) - 1 AS turn FROM minority),
drawn AS (SELECT nth, turn + k * n_min AS new_id FROM turns, goal, unnest(range(0, n_new // n_min + 1)) AS s(k) WHERE turn + k * n_min < n_new),
slots AS (SELECT nth, new_id, CAST(floor({draw_sql('42/slot', 'new_id')} * least(5, n_min - 1)) AS BIGINT) + 1 AS place,
{draw_sql('42/gap', 'new_id')} AS g FROM drawn, goal)
SELECT s.new_id, m.batch_time AS base_key, n.other_rep AS neighbour_row, m.label,
{', '.join(r(f'm.{f} + s.g * (n.y_{f} - m.{f})', f) for f in FEATURES)}
FROM slots s JOIN minority m ON m.nth = s.nth JOIN near n ON n.base = s.nth AND n.place = s.place"""))
def smote(spark, folder):
    rows = sampling.smote(_labelled_telemetry(spark, folder), "batch_time", "label", ratio=0.5, strict=False)
    return roles.telemetry_columns(rows)


@job(f"""WITH v AS (SELECT vec_id, embedding FROM embeddings), pairs AS (SELECT a.vec_id AS key, b.vec_id AS neighbour,
list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda p: (CAST(p[1] AS DOUBLE) - CAST(p[2] AS DOUBLE)) * (CAST(p[1] AS DOUBLE) - CAST(p[2] AS DOUBLE)))) AS d
FROM v a JOIN v b ON a.vec_id <> b.vec_id)
SELECT key, CAST(rank AS INTEGER) AS rank, neighbour, {r('d', 'distance2')} FROM
(SELECT *, row_number() OVER (PARTITION BY key ORDER BY d, neighbour) AS rank FROM pairs) WHERE rank <= 5""")
def nearest_neighbours(spark, folder):
    vectors = read_table(spark, folder, "embeddings").select(F.col("vec_id").alias("key"), F.col("embedding").alias("x"))
    near = sampling.nearest_neighbours(vectors, 5)
    return near.withColumn("distance2", rounded("distance2"))
