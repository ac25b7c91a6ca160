"""Metrics, curves and thresholds of scored line items and telemetry."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazardlake.functions.arrays import zero_filled
from hazardlake.functions.scalars import linear_score, sigmoid
from hazardlake.operators import evaluation, scoring
from hazardlake.operators.evaluation import Costs
from hazardlake.session import scratch_path
from hazardlake.sources import delimited, tables

from . import roles
from .registry import job
from .roles import r, rounded, telemetry_score_sql, with_parts

_MATRIX = """m AS (SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp, count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn, count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn FROM scored)"""
_D = {c: f"CAST({c} AS DOUBLE)" for c in ("tp", "fp", "fn", "tn")}


def _ratio(top: str, bottom: str) -> str:
    return f"CASE WHEN {bottom} <> 0 THEN ({top}) / CAST({bottom} AS DOUBLE) ELSE 0 END"


def _round_all(df, *keep):
    return df.select(*[c if c in keep else rounded(c).alias(c) for c in df.columns])


@job(with_parts("scored", f""", {_MATRIX} SELECT tp, fp, fn, tn, {r(_ratio('tp + tn', '(tp + fp + fn + tn)'), 'accuracy')},
{r(_ratio('tp', '(tp + fp)'), 'precision')}, {r(_ratio('tp', '(tp + fn)'), 'recall')}, {r(_ratio('2 * tp', '(2 * tp + fp + fn)'), 'f1')},
{r(_ratio('tn', '(tn + fp)'), 'specificity')},
{r('CASE WHEN least(tp + fp, tp + fn, tn + fp, tn + fn) > 0 THEN ({tp} * {tn} - {fp} * {fn}) / (sqrt({tp} + {fp}) * sqrt({tp} + {fn}) * sqrt({tn} + {fp}) * sqrt({tn} + {fn})) ELSE 0 END'.format(**_D), 'mcc')},
{r('990.0 * tp - 1000.0 * fn - 10.0 * fp', 'benefit')} FROM m"""))
def class_metrics(spark, folder):
    metrics = evaluation.class_metrics(evaluation.confusion(roles.scored_items(spark, folder)))
    return _round_all(metrics.withColumn("benefit", evaluation.benefit()), "tp", "fp", "fn", "tn")


@job(with_parts("scored", f""", {_MATRIX} SELECT tp, fp, fn, tn,
{r('(CAST(tp AS DOUBLE) / (tp + fn) + CAST(tn AS DOUBLE) / (tn + fp)) / 2', 'hard_roc_auc')},
{r('-((fp + fn) * ln(CAST(2.220446049250313e-16 AS DOUBLE)) + (tp + tn) * ln(1 - CAST(2.220446049250313e-16 AS DOUBLE))) / (tp + fp + fn + tn)', 'hard_log_loss')} FROM m"""))
def hard_prediction_metrics(spark, folder):
    return _round_all(evaluation.hard_metrics(evaluation.confusion(roles.scored_items(spark, folder))), "tp", "fp", "fn", "tn")


@job(with_parts("scored", f""", p AS (SELECT label, greatest(least(score, 1 - CAST(2.220446049250313e-16 AS DOUBLE)), CAST(2.220446049250313e-16 AS DOUBLE)) AS p FROM scored)
SELECT {r('avg(-(label * ln(p) + (1 - label) * ln(1 - p)))', 'log_loss')} FROM p"""))
def log_loss(spark, folder):
    return _round_all(evaluation.log_loss(roles.scored_items(spark, folder)))


_ROC_AUC = "sum(CAST(neg AS DOUBLE) * (tp - pos + pos / 2.0)) / (CAST(max(n_pos) AS DOUBLE) * max(n_neg))"
_PR_AUC = "sum(CAST(pos AS DOUBLE) / n_pos * (CAST(tp AS DOUBLE) / (tp + fp)))"


def _table(spark, folder):
    return evaluation.threshold_table(roles.scored_items(spark, folder))


@job(with_parts("scored curve", f"SELECT {r(_ROC_AUC, 'roc_auc')}, {r(_PR_AUC, 'pr_auc')} FROM curve"))
def areas_under_curves(spark, folder):
    return _round_all(evaluation.auc(_table(spark, folder)))


@job(with_parts("scored curve", f"SELECT score AS threshold, {r('CAST(fp AS DOUBLE) / n_neg', 'fpr')}, {r('CAST(tp AS DOUBLE) / n_pos', 'tpr')} FROM curve UNION ALL SELECT CAST('infinity' AS DOUBLE), 0.0, 0.0"))
def roc_curve(spark, folder):
    return _round_all(evaluation.roc_curve(_table(spark, folder)), "threshold")


_P, _R = "CAST(tp AS DOUBLE) / (tp + fp)", "CAST(tp AS DOUBLE) / n_pos"


@job(with_parts("scored curve", f"SELECT score AS threshold, {r(_P, 'precision')}, {r(_R, 'recall')} FROM curve UNION ALL SELECT NULL, 1.0, 0.0"))
def pr_curve(spark, folder):
    return _round_all(evaluation.pr_curve(_table(spark, folder)), "threshold")


@job(with_parts("scored curve", f"SELECT score AS threshold, {r(_P, 'precision')}, {r(_R, 'recall')} FROM curve ORDER BY abs(score - CAST(0.4 AS DOUBLE)), score DESC LIMIT 1"))
def nearest_curve_point(spark, folder):
    point = evaluation.nearest_point(evaluation.pr_curve(_table(spark, folder)), 0.4)
    return _round_all(point, "threshold")


_F1 = f"2.0 * ({_P} * ({_R})) / ({_P} + {_R} + CAST(1e-9 AS DOUBLE))"


@job(with_parts("scored curve", f"SELECT score AS threshold FROM curve ORDER BY {_F1} DESC, score LIMIT 1"))
def threshold_f1(spark, folder):
    return evaluation.find_threshold(roles.scored_items(spark, folder), "f1")


@job(with_parts("scored curve", f"""SELECT coalesce((SELECT score FROM curve WHERE {_P} >= CAST(0.335 AS DOUBLE)
ORDER BY {_R} DESC, score LIMIT 1), CAST(0.5 AS DOUBLE)) AS threshold"""))
def threshold_recall_at_precision(spark, folder):
    return evaluation.find_threshold(roles.scored_items(spark, folder), "recall_at_precision", 0.335)


@job(with_parts("scored curve", """SELECT t AS threshold FROM (SELECT score AS t, CAST(tp AS DOUBLE) / n_pos - CAST(fp AS DOUBLE) / n_neg AS j FROM curve
UNION ALL SELECT CAST('infinity' AS DOUBLE), 0.0) ORDER BY j DESC, t DESC LIMIT 1"""))
def threshold_youden(spark, folder):
    return evaluation.find_threshold(roles.scored_items(spark, folder), "youden")


_GRID = ", ".join(f"(CAST({t!r} AS DOUBLE))" for t in evaluation.Grid().values())
_COST = f"""grid(t) AS (VALUES {_GRID}), cells AS (SELECT t, count(*) FILTER (WHERE label = 1 AND score >= t) AS tp,
count(*) FILTER (WHERE label = 0 AND score >= t) AS fp, count(*) FILTER (WHERE label = 1 AND score < t) AS fn,
count(*) FILTER (WHERE label = 0 AND score < t) AS tn FROM grid, (SELECT label, score FROM scored) GROUP BY t),
costs AS (SELECT *, tp * {{0}} - fn * {{1}} - fp * {{2}} AS benefit FROM cells)"""


@job(with_parts("scored", f", {_COST.format('990.0', '1000.0', '10.0')} SELECT t AS threshold, tp, fp, fn, tn, {r('benefit', 'benefit')} FROM costs"))
def cost_curve(spark, folder):
    return _round_all(evaluation.cost_table(roles.scored_items(spark, folder)), "threshold", "tp", "fp", "fn", "tn")


@job(with_parts("scored", f", {_COST.format('30.0', '20.0', '15.0')} SELECT t AS threshold FROM costs ORDER BY benefit DESC, t LIMIT 1"))
def threshold_cost(spark, folder):
    costs = Costs(fn=20.0, fp=15.0, tp=30.0, tn=0.0)
    return evaluation.find_threshold(roles.scored_items(spark, folder), "cost", costs=costs)


@job(with_parts("scored curve", f""", best AS (SELECT score, tp, fp, n_pos FROM curve ORDER BY {_F1} DESC, score LIMIT 1)
SELECT score AS threshold, {r('2.0 * tp / (tp + fp + n_pos)', 'f1')}, {r('CAST(tp AS DOUBLE) / (tp + fp)', 'precision')},
{r('CAST(tp AS DOUBLE) / n_pos', 'recall')}, (SELECT {_ROC_AUC} FROM curve) AS roc_auc, (SELECT {_PR_AUC} FROM curve) AS pr_auc FROM best"""
    .replace(f"(SELECT {_ROC_AUC} FROM curve) AS roc_auc", r(f"(SELECT {_ROC_AUC} FROM curve)", "roc_auc"))
    .replace(f"(SELECT {_PR_AUC} FROM curve) AS pr_auc", r(f"(SELECT {_PR_AUC} FROM curve)", "pr_auc"))))
def threshold_report(spark, folder):
    return _round_all(evaluation.threshold_report(roles.scored_items(spark, folder)), "threshold")


_SIDE = """SELECT '0' AS class, tn AS hit, fn AS false_hit, fp AS miss FROM m UNION ALL SELECT '1', tp, fp, fn FROM m"""


@job(with_parts("scored", f""", {_MATRIX}, side AS ({_SIDE}),
per AS (SELECT class, {_ratio('hit', '(hit + false_hit)')} AS precision, {_ratio('hit', '(hit + miss)')} AS recall,
{_ratio('2 * hit', '(2 * hit + false_hit + miss)')} AS f1, hit + miss AS support FROM side),
acc AS (SELECT CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn) AS a FROM m)
SELECT class, {r('precision', 'precision')}, {r('recall', 'recall')}, {r('f1', 'f1')}, CAST(support AS BIGINT) AS support FROM per
UNION ALL SELECT 'accuracy', {r('max(a)', 'a')}, {r('max(a)', 'b')}, {r('max(a)', 'c')}, CAST(sum(support) AS BIGINT) FROM per, acc
UNION ALL SELECT 'macro avg', {r('avg(precision)', 'a')}, {r('avg(recall)', 'b')}, {r('avg(f1)', 'c')}, CAST(sum(support) AS BIGINT) FROM per
UNION ALL SELECT 'weighted avg', {r('sum(precision * support) / sum(support)', 'a')}, {r('sum(recall * support) / sum(support)', 'b')}, {r('sum(f1 * support) / sum(support)', 'c')}, CAST(sum(support) AS BIGINT) FROM per"""))
def class_report(spark, folder):
    return _round_all(evaluation.class_report(roles.scored_items(spark, folder)), "class", "support")


# -- scoring ------------------------------------------------------------------------------

THRESHOLD = 0.42
_PREDICTED = f"""pred AS (SELECT batch_time, probability, CAST(probability >= CAST({THRESHOLD} AS DOUBLE) AS INTEGER) AS prediction, CAST({THRESHOLD} AS DOUBLE) AS threshold
FROM (SELECT batch_time, {telemetry_score_sql()} AS probability FROM tel))"""
_CONTEXT = """ctx AS (SELECT batch_time, count(*) AS n_ops, CAST(sum(CAST(is_emergency AS INTEGER)) AS BIGINT) AS n_emergency_ops FROM elog GROUP BY 1),
full_pred AS (SELECT p.*, coalesce(c.n_ops, 0) AS n_ops, coalesce(c.n_emergency_ops, 0) AS n_emergency_ops,
CAST(coalesce(c.n_emergency_ops, 0) > 0 AS BIGINT) AS ground_truth FROM pred p LEFT JOIN ctx c ON c.batch_time = p.batch_time)"""


def predictions(spark, folder, context=True):
    table = roles.telemetry(spark, folder).withColumn("features", zero_filled("features"))
    log = roles.event_log(spark, folder) if context else None
    return scoring.score(table, THRESHOLD, weights=roles.TELEMETRY_WEIGHTS, bias=roles.TELEMETRY_BIAS, log=log)


_EXACT = ("batch_time", "prediction", "threshold", "n_ops", "n_emergency_ops", "ground_truth")


@job(with_parts("tel elog", f", {_PREDICTED}, {_CONTEXT} SELECT batch_time, {r('probability', 'probability')}, prediction, threshold, n_ops, n_emergency_ops, ground_truth FROM full_pred"))
def batch_scores(spark, folder):
    return _round_all(predictions(spark, folder), *_EXACT)


@job(with_parts("tel", f", {_PREDICTED} SELECT batch_time, {r('probability', 'probability')}, prediction, threshold FROM pred ORDER BY probability DESC, batch_time"))
def predictions_by_risk(spark, folder):
    return _round_all(scoring.by_risk(predictions(spark, folder, context=False)), *_EXACT)


@job(with_parts("tel", f""", {_PREDICTED} SELECT batch_time, {r('probability', 'probability')}, prediction FROM
(SELECT * FROM pred WHERE prediction = 1 ORDER BY probability DESC, batch_time LIMIT 10)"""))
def risk_report(spark, folder):
    report = scoring.risk_report(predictions(spark, folder, context=False))
    return _round_all(report, *_EXACT).drop("threshold")


@job(with_parts("tel", f", {_PREDICTED} SELECT batch_time, {r('probability', 'probability')}, CAST(prediction AS INTEGER) AS prediction FROM pred"))
def prediction_sink(spark, folder):
    path = tables.write_predictions(predictions(spark, folder, context=False), scratch_path(spark, "predictions"))
    stored = delimited.scan(spark, path)
    return stored.select(
        F.col("batch_time").try_cast("timestamp_ntz").alias("batch_time"),
        rounded(F.col("probability").try_cast("double")).alias("probability"),
        F.col("prediction").try_cast("int").alias("prediction"),
    )


@job(with_parts("tel elog", f""", {_PREDICTED}, {_CONTEXT}, s AS (SELECT count(*) AS total, count(*) FILTER (WHERE prediction = 1) AS predicted,
max(threshold) AS threshold, count(*) FILTER (WHERE ground_truth = 1 AND prediction = 1) AS tp, count(*) FILTER (WHERE ground_truth = 0 AND prediction = 1) AS fp,
count(*) FILTER (WHERE ground_truth = 1 AND prediction = 0) AS fn, count(*) FILTER (WHERE ground_truth = 0 AND prediction = 0) AS tn FROM full_pred)
SELECT total, predicted, threshold, tp, fp, fn, tn, {r('100.0 * predicted / greatest(total, 1)', 'predicted_percent')},
{r('CAST(tp AS DOUBLE) / greatest(tp + fp, 1)', 'precision')}, {r('CAST(tp AS DOUBLE) / greatest(tp + fn, 1)', 'recall')} FROM s"""))
def scoring_summary(spark, folder):
    summary = evaluation.scoring_summary(predictions(spark, folder), "ground_truth")
    return _round_all(summary, "total", "predicted", "threshold", "tp", "fp", "fn", "tn")


@job(f"SELECT l_orderkey, l_linenumber, count(*) AS n, {r('sum(z)', 'score')}, {r('sum(1.0 / (1.0 + exp(-z)))', 'probability')} FROM (SELECT l_orderkey, l_linenumber, "
     f"CAST({roles.LINEITEM_BIAS} AS DOUBLE) + l_quantity * {roles.LINEITEM_WEIGHTS[0]} + l_discount * CAST({roles.LINEITEM_WEIGHTS[1]} AS DOUBLE) + l_tax * {roles.LINEITEM_WEIGHTS[2]} AS z FROM lineitem) GROUP BY 1, 2")
def linear_scores(spark, folder):
    z = linear_score(F.array("l_quantity", "l_discount", "l_tax"), roles.LINEITEM_WEIGHTS[:3], roles.LINEITEM_BIAS)
    items = tables.read_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", z.alias("z"))
    return items.groupBy("l_orderkey", "l_linenumber").agg(
        F.count(F.lit(1)).alias("n"), rounded(F.sum("z")).alias("score"), rounded(F.sum(sigmoid("z"))).alias("probability")
    )

