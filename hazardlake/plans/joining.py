"""Joins of telemetry with the event log."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazardlake.operators import joins, rollup, sampling

from . import roles
from .registry import job
from .roles import FEATURES, cells_sql, r, telemetry_columns, telemetry_score_sql, with_parts

_COUNTS = """context AS (SELECT date_trunc('second', batch_time) AS batch_time, count(*) AS n_ops,
CAST(sum(CAST(is_emergency AS INTEGER)) AS BIGINT) AS n_emergency_ops FROM elog GROUP BY 1)"""


@job(with_parts("teluser elog", f""", {_COUNTS},
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY batch_time ORDER BY user_id) AS rn FROM teluser) WHERE rn = 1)
SELECT t.batch_time, t.user_id, {cells_sql('t.')}, CAST(l.label AS INTEGER) AS label, coalesce(c.n_ops, 0) AS n_ops,
coalesce(c.n_emergency_ops, 0) AS n_emergency_ops, CAST(coalesce(c.n_emergency_ops, 0) > 0 AS BIGINT) AS ground_truth
FROM firsts t JOIN (SELECT batch_time, max(CAST(is_emergency AS INTEGER)) AS label FROM elog GROUP BY 1) l ON t.batch_time = l.batch_time
LEFT JOIN context c ON c.batch_time = date_trunc('second', t.batch_time)"""))
def hourly_training_table(spark, folder):
    """Flagship: first telemetry row per hour, the hour's label and its event counts."""
    log = roles.event_log(spark, folder)
    table = joins.training_table(roles.telemetry_by_user(spark, folder), log, ["user_id"])
    return telemetry_columns(joins.attach_context(table, log)).select(
        "batch_time", "user_id", *FEATURES, F.col("is_emergency").cast("int").alias("label"), *joins.CONTEXT_COLUMNS
    )


@job(with_parts("tel elog", f"""SELECT t.batch_time, {cells_sql('t.')}, CAST(l.label AS INTEGER) AS label
FROM tel t JOIN (SELECT batch_time, max(CAST(is_emergency AS INTEGER)) AS label FROM elog GROUP BY 1) l ON t.batch_time = l.batch_time"""))
def label_join(spark, folder):
    table = joins.training_table(roles.telemetry(spark, folder), roles.event_log(spark, folder), ["batch_time"])
    return telemetry_columns(table).select("batch_time", *FEATURES, F.col("is_emergency").cast("int").alias("label"))


@job(with_parts("tel elog", f""", hits AS (SELECT date_trunc('second', batch_time) AS batch_time, count(*) AS n_ops,
CAST(sum(CAST(is_emergency AS INTEGER)) AS BIGINT) AS n_emergency_ops FROM elog WHERE is_emergency GROUP BY 1)
SELECT t.batch_time, {r(telemetry_score_sql('t.'), 'probability')}, coalesce(n_ops, 0) AS n_ops,
coalesce(n_emergency_ops, 0) AS n_emergency_ops, CAST(coalesce(n_emergency_ops, 0) > 0 AS BIGINT) AS ground_truth
FROM tel t LEFT JOIN hits ON hits.batch_time = date_trunc('second', t.batch_time)"""))
def context_join(spark, folder):
    scored = roles.scored_telemetry(spark, folder).select("batch_time", roles.rounded("probability").alias("probability"))
    return joins.attach_context(scored, roles.event_log(spark, folder).filter("is_emergency"))


_MINUTE = """telminute t JOIN (SELECT date_trunc('minute', date) AS slot, is_emergency, count(*) AS n_copies FROM elog GROUP BY 1, 2) c
ON c.slot = t.batch_time"""


@job(with_parts("telminute elog", f"SELECT t.batch_time, c.is_emergency, c.n_copies, {cells_sql('t.')} FROM {_MINUTE}"))
def label_copies_by_minute(spark, folder):
    return telemetry_columns(
        joins.label_copies(roles.telemetry_by_minute(spark, folder), roles.event_log(spark, folder))
    )


@job(with_parts("tel elog", f"""SELECT t.batch_time, {cells_sql('t.')},
CAST(EXISTS (SELECT 1 FROM elog e WHERE e.is_emergency AND e.batch_time = t.batch_time + INTERVAL 3 HOUR) AS INTEGER) AS label FROM tel t"""))
def horizon_label_exact(spark, folder):
    table = joins.horizon_label(
        roles.telemetry(spark, folder), roles.event_log(spark, folder), 3, log_time="batch_time"
    )
    return telemetry_columns(table).select("batch_time", *FEATURES, "label")


@job(with_parts("telminute elog", """, hits AS (SELECT DISTINCT date FROM elog WHERE is_emergency)
SELECT t.batch_time, CAST(coalesce(h.date <= t.batch_time + INTERVAL 1 HOUR, false) AS INTEGER) AS label
FROM (SELECT batch_time, batch_time + INTERVAL 1 MICROSECOND AS after FROM telminute) t ASOF LEFT JOIN hits h ON t.after <= h.date"""))
def horizon_label_within(spark, folder):
    table = joins.horizon_label(
        roles.telemetry_by_minute(spark, folder), roles.event_log(spark, folder), 1, within=True
    )
    return table.select("batch_time", "label")


@job(with_parts("teluser elog", f"SELECT batch_time, user_id, {cells_sql()} FROM teluser WHERE batch_time IN (SELECT batch_time FROM elog WHERE is_emergency)"))
def telemetry_at_emergencies(spark, folder):
    log = roles.event_log(spark, folder)
    return telemetry_columns(joins.at_emergency_times(roles.telemetry_by_user(spark, folder), log, log_time="batch_time"))


@job(with_parts("telminute elog", f"SELECT e.event_id, e.date, e.is_emergency, {cells_sql('t.')} FROM elog e LEFT JOIN telminute t ON t.batch_time = date_trunc('minute', e.date)"))
def log_with_telemetry(spark, folder):
    log = roles.event_log(spark, folder).select("event_id", "date", "is_emergency")
    keyed = log.withColumn("slot", F.date_trunc("minute", "date").cast("timestamp_ntz"))
    return telemetry_columns(joins.log_with_telemetry(keyed, roles.telemetry_by_minute(spark, folder), "slot").drop("slot"))


@job(with_parts("elog tel", f""", a AS (SELECT event_id, row_number() OVER (ORDER BY date, event_id) - 1 AS row_idx FROM elog),
b AS (SELECT *, row_number() OVER (ORDER BY batch_time) - 1 AS row_idx FROM tel)
SELECT a.row_idx, a.event_id, b.batch_time, {cells_sql('b.')} FROM a JOIN b ON a.row_idx = b.row_idx"""))
def positional_join(spark, folder):
    log = roles.event_log(spark, folder).select("event_id", "date")
    telemetry = roles.telemetry(spark, folder)
    joined = joins.positional_join(
        log, telemetry, ["date", "event_id"], ["batch_time"], left_key=["event_id"], right_key=["batch_time"]
    )
    return telemetry_columns(joined.drop("date"))


@job(with_parts("elog rep", """SELECT e.event_id, e.r_id, d.b_id FROM elog e LEFT JOIN (SELECT r_id, b_id FROM
(SELECT *, row_number() OVER (PARTITION BY r_id ORDER BY c_acctbal, b_id) AS rn FROM rep) WHERE rn = 1) d ON d.r_id = e.r_id"""))
def dimension_lookup(spark, folder):
    log = roles.event_log(spark, folder).select("event_id", "r_id")
    return joins.lookup_first(log, roles.repairs(spark, folder), "r_id", ["c_acctbal", "b_id"]).select(
        "event_id", "r_id", "b_id"
    )


@job(with_parts("elog teluser", f""", a AS (SELECT batch_time, count(*) AS n1 FROM elog GROUP BY 1),
b AS (SELECT batch_time, count(*) AS n2 FROM teluser GROUP BY 1), j AS (SELECT n1, n2 FROM a JOIN b ON a.batch_time = b.batch_time)
SELECT count(*) AS shared_keys, CAST(sum(least(n1, n2)) AS BIGINT) AS estimated_rows, CAST(sum(n1 * n2) AS DOUBLE) AS true_join_rows,
(SELECT max(n1) FROM a) AS max_log_rows, (SELECT max(n2) FROM b) AS max_telemetry_rows,
{r('sum(least(n1, n2)) / CAST(greatest(count(*), 1) AS DOUBLE)', 'multiplicity')} FROM j"""))
def join_multiplicity(spark, folder):
    found = joins.join_multiplicity(roles.event_log(spark, folder), roles.telemetry_by_user(spark, folder))
    return found.withColumn("multiplicity", roles.rounded("multiplicity"))


@job(with_parts("elog", """SELECT 'emergency' AS part, event_id, r_id FROM elog WHERE is_emergency
UNION ALL SELECT 'other', event_id, r_id FROM elog WHERE NOT is_emergency"""))
def concat_rows(spark, folder):
    log = roles.event_log(spark, folder)
    parts = [
        log.filter(F.col("is_emergency") == F.lit(flag)).select("r_id", "event_id", F.lit(name).alias("part"))
        for name, flag in (("emergency", True), ("other", False))
    ]
    return sampling.concat_rows(*parts)


@job(with_parts("tel elog", f"SELECT batch_time, {cells_sql()} FROM tel WHERE batch_time NOT IN (SELECT batch_time FROM elog WHERE is_emergency)"))
def telemetry_without_emergency(spark, folder):
    labels = rollup.label_rollup(roles.event_log(spark, folder)).filter(~F.col("is_emergency"))
    table = roles.telemetry(spark, folder).join(labels.select("batch_time"), "batch_time", "inner")
    return telemetry_columns(table)
