"""Metrics and thresholds from labels and scores.

Rows are grouped by distinct score first; running totals over those, highest
score first, give true and false positives at every threshold. Scores that pile
up in a narrow range only make the sorted blocks narrower.
"""

from __future__ import annotations

import sys
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hazardlake.functions.scalars import at_least

from .ordering import add_prefix_sums

EPSILON = sys.float_info.epsilon


@dataclass(frozen=True)
class Costs:
    """What each cell of the confusion matrix costs or earns."""

    fn: float = 1000.0
    fp: float = 10.0
    tp: float = 990.0
    tn: float = 0.0

    def class_weights(self) -> dict[int, float]:
        """What a missed positive weighs against a false alarm."""
        if self.fp <= 0:
            raise ValueError("class weights need a false alarm to cost something")
        return {0: 1.0, 1: self.fn / self.fp}


def benefit(costs: Costs = Costs(), tp="tp", fp="fp", fn="fn", tn="tn") -> Column:
    """Total benefit of a confusion matrix; larger is better."""
    return (
        F.col(tp) * F.lit(costs.tp)
        + F.col(tn) * F.lit(costs.tn)
        - F.col(fn) * F.lit(costs.fn)
        - F.col(fp) * F.lit(costs.fp)
    )


def _ratio(top: Column, bottom: Column) -> Column:
    """0 where the ratio is undefined."""
    return F.when(bottom != 0, top.cast("double") / bottom).otherwise(F.lit(0.0))


# -- confusion matrix --------------------------------------------------------


def confusion(
    df: DataFrame, label: str = "label", prediction: str = "prediction", group: Sequence[str] = ()
) -> DataFrame:
    """One row, or one per group: tp, fp, fn, tn. Label and prediction come from the same row."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    return df.groupBy(*group).agg(
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(~y & ~p).alias("tn"),
    )


def class_metrics(matrix: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1, specificity and MCC of confusion counts."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    margin = F.sqrt(tp + fp) * F.sqrt(tp + fn) * F.sqrt(tn + fp) * F.sqrt(tn + fn)
    return matrix.select(
        *matrix.columns,
        _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2.0 * tp, 2.0 * tp + fp + fn).alias("f1"),
        _ratio(tn, tn + fp).alias("specificity"),
        _ratio(tp * tn - fp * fn, margin).alias("mcc"),
    )


def hard_metrics(matrix: DataFrame, eps: float = EPSILON) -> DataFrame:
    """ROC-AUC and log loss of the 0/1 predictions themselves, from confusion counts."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    wrong, right = fp + fn, tp + tn
    loss = -(wrong * F.ln(F.lit(eps)) + right * F.ln(F.lit(1.0 - eps)))
    return matrix.select(
        *matrix.columns,
        ((_ratio(tp, tp + fn) + _ratio(tn, tn + fp)) / 2.0).alias("hard_roc_auc"),
        _ratio(loss, wrong + right).alias("hard_log_loss"),
    )


def log_loss(df: DataFrame, label: str = "label", score: str = "score", eps: float = EPSILON) -> DataFrame:
    p = F.greatest(F.least(F.col(score), F.lit(1.0 - eps)), F.lit(eps))
    y = F.col(label).cast("double")
    return df.agg(F.avg(-(y * F.ln(p) + (1.0 - y) * F.ln(1.0 - p))).alias("log_loss"))


def class_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages."""
    counts = confusion(df, label, prediction)

    def side(name: str, tp: str, fp: str, fn: str) -> Column:
        t, p, n = (F.col(c).cast("double") for c in (tp, fp, fn))
        return F.struct(
            F.lit(name).alias("class"),
            _ratio(t, t + p).alias("precision"),
            _ratio(t, t + n).alias("recall"),
            _ratio(2.0 * t, 2.0 * t + p + n).alias("f1"),
            (F.col(tp) + F.col(fn)).alias("support"),
        )

    both = counts.select(side("0", "tn", "fn", "fp").alias("a"), side("1", "tp", "fp", "fn").alias("b"), "tp", "tn")
    total = F.col("a.support") + F.col("b.support")

    def average(name: str, mean) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            *[mean(F.col(f"a.{m}"), F.col(f"b.{m}")).alias(m) for m in ("precision", "recall", "f1")],
            total.alias("support"),
        )

    accuracy = _ratio(F.col("tp") + F.col("tn"), total)
    rows = F.array(
        F.col("a"),
        F.col("b"),
        average("accuracy", lambda x, y: accuracy),
        average("macro avg", lambda x, y: (x + y) / 2.0),
        average("weighted avg", lambda x, y: _ratio(x * F.col("a.support") + y * F.col("b.support"), total)),
    )
    return both.select(F.explode(rows).alias("r")).select("r.*")


# -- curves ------------------------------------------------------------------


def threshold_table(
    df: DataFrame, label: str = "label", score: str = "score", group: Sequence[str] = ()
) -> DataFrame:
    """One row per distinct score (of a group): rows at it (pos, neg), counts at or
    above it (tp, fp), and the class totals (n_pos, n_neg)."""
    y = F.col(label)
    per_score = df.groupBy(*group, F.col(score).cast("double").alias("score")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")
    )
    return add_prefix_sums(
        per_score, [F.desc("score")], {"tp": "pos", "fp": "neg"}, {"n_pos": "tp", "n_neg": "fp"}, group
    )


def _auc_columns() -> list[Column]:
    pairs = F.max("n_pos").cast("double") * F.max("n_neg")
    steps = F.sum(F.try_divide(F.col("pos").cast("double"), F.col("n_pos")) * _precision())
    ranked = F.sum(
        F.col("neg").cast("double") * (F.col("tp") - F.col("pos") + F.col("pos").cast("double") / 2.0)
    )
    return [F.try_divide(ranked, pairs).alias("roc_auc"), steps.alias("pr_auc")]


def auc(table: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """ROC-AUC (ties count one half) and average precision (step sum) of a threshold table.

    Without positives both are null, without negatives the first is.
    """
    return table.groupBy(*group).agg(*_auc_columns())


def _precision() -> Column:
    return F.col("tp").cast("double") / (F.col("tp") + F.col("fp"))


def _recall() -> Column:
    return F.when(F.col("n_pos") > 0, F.col("tp").cast("double") / F.col("n_pos")).otherwise(F.lit(1.0))


def roc_curve(table: DataFrame) -> DataFrame:
    """False and true positive rate per threshold, starting at (0, 0) with an infinite one.

    The rate of a class that has no rows is null.
    """
    points = table.select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("fp").cast("double"), F.col("n_neg")).alias("fpr"),
        F.try_divide(F.col("tp").cast("double"), F.col("n_pos")).alias("tpr"),
    )
    start = table.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(start)


def pr_curve(table: DataFrame) -> DataFrame:
    """Precision and recall per threshold, ending at (1, 0) without one."""
    points = table.select(F.col("score").alias("threshold"), _precision().alias("precision"), _recall().alias("recall"))
    end = table.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(end)


def nearest_point(curve: DataFrame, threshold: Column | float) -> DataFrame:
    """The curve's point whose threshold is closest to the chosen one (highest wins a tie)."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    gap = F.abs(F.col("threshold") - t)
    row = F.struct(*curve.columns)
    best = curve.filter(F.col("threshold").isNotNull()).agg(
        F.min_by(row, F.struct(gap, -F.col("threshold"))).alias("p")
    )
    return best.select("p.*")


# -- thresholds --------------------------------------------------------------


def threshold_f1(table: DataFrame) -> DataFrame:
    """Score with the best F1; the lowest wins a tie."""
    p, r = _precision(), _recall()
    f1 = 2.0 * (p * r) / (p + r + F.lit(1e-9))
    best = F.min_by("score", F.struct(-f1, F.col("score")))
    return table.agg(F.coalesce(best, F.lit(0.5)).alias("threshold"))


def threshold_recall(table: DataFrame, min_precision: float) -> DataFrame:
    """Score with the best recall among those precise enough; lowest on a tie, 0.5 if none is."""
    best = F.min_by("score", F.struct(-_recall(), F.col("score")))
    return table.filter(_precision() >= F.lit(float(min_precision))).agg(
        F.coalesce(best, F.lit(0.5)).alias("threshold")
    )


def threshold_youden(table: DataFrame) -> DataFrame:
    """Threshold with the best ``tpr - fpr``; the highest wins a tie, so 0 gives infinity.

    With one class only there is nothing to tell apart, which is a tie at 0.
    """
    j = F.coalesce(F.col("tpr") - F.col("fpr"), F.lit(0.0))
    best = F.min_by("threshold", F.struct(-j, -F.col("threshold")))
    return roc_curve(table).agg(best.alias("threshold"))


@dataclass(frozen=True)
class Grid:
    """Evenly spaced thresholds, end points included."""

    low: float = 0.01
    high: float = 0.99
    steps: int = 99

    def values(self) -> list[float]:
        return [float(t) for t in np.linspace(self.low, self.high, self.steps)]

    def cell(self, score: Column) -> Column:
        """How many grid values are at or below a score.

        Arithmetic finds the place to within one, and the grid's own values
        decide, so a score equal to a threshold falls on the right side.
        """
        edges = F.array(*[F.lit(t) for t in self.values()])
        width = (self.high - self.low) / (self.steps - 1)
        near = F.floor((score - F.lit(self.low)) / F.lit(width)).cast("int") + 1
        near = F.greatest(F.least(near, F.lit(self.steps)), F.lit(0))
        return (
            F.when(F.get(edges, near) <= score, near + 1)
            .when(F.get(edges, near - 1) > score, near - 1)
            .otherwise(near)
        )


def cost_table(
    df: DataFrame, costs: Costs = Costs(), label: str = "label", score: str = "score", grid: Grid = Grid()
) -> DataFrame:
    """Confusion counts and benefit at each grid threshold.

    Every row falls into one of the cells between grid values, so one grouped
    count gives a table as long as the grid, and running totals over that small
    table give the counts at or above each threshold.
    """
    y = F.col(label)
    cells = df.groupBy(grid.cell(F.col(score)).alias("cell")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")
    )
    # From here on there is one row per grid value; the windows below see only those.
    spark = df.sparkSession
    edges = F.array(*[F.lit(t) for t in grid.values()])
    axis = spark.range(grid.steps + 1).select(
        F.col("id").cast("int").alias("cell"), F.get(edges, F.col("id").cast("int") - 1).alias("threshold")
    )
    full = axis.join(cells, "cell", "left").na.fill(0, ["pos", "neg"])
    above = W.orderBy(F.desc("cell")).rowsBetween(W.unboundedPreceding, 0)
    everything = W.partitionBy()
    counts = full.select(
        "threshold",
        F.sum("pos").over(above).alias("tp"),
        F.sum("neg").over(above).alias("fp"),
        F.sum("pos").over(everything).alias("n_pos"),
        F.sum("neg").over(everything).alias("n_neg"),
    )
    return (
        counts.filter(F.col("threshold").isNotNull())
        .select(
            "threshold",
            "tp",
            "fp",
            (F.col("n_pos") - F.col("tp")).alias("fn"),
            (F.col("n_neg") - F.col("fp")).alias("tn"),
        )
        .withColumn("benefit", benefit(costs))
    )


def threshold_cost(
    df: DataFrame, costs: Costs = Costs(), label: str = "label", score: str = "score", grid: Grid = Grid()
) -> DataFrame:
    """Grid threshold with the largest benefit; the lowest wins a tie."""
    best = F.min_by("threshold", F.struct(-F.col("benefit"), F.col("threshold")))
    return cost_table(df, costs, label, score, grid).agg(best.alias("threshold"))


def find_threshold(
    df: DataFrame,
    metric: str = "f1",
    min_precision: float = 0.5,
    costs: Costs = Costs(),
    optimize: bool = True,
    label: str = "label",
    score: str = "score",
    table: DataFrame | None = None,
) -> DataFrame:
    """One row with the threshold for a metric; 0.5 when switched off or unknown."""
    if optimize and metric == "cost":
        return threshold_cost(df, costs, label, score)
    if optimize and metric in ("f1", "recall_at_precision", "youden"):
        table = threshold_table(df, label, score) if table is None else table
        if metric == "f1":
            return threshold_f1(table)
        if metric == "youden":
            return threshold_youden(table)
        return threshold_recall(table, min_precision)
    return df.sparkSession.range(1).select(F.lit(0.5).alias("threshold"))


def metrics_at(table: DataFrame, threshold: DataFrame) -> DataFrame:
    """F1, precision and recall at a threshold, with ROC-AUC and average precision."""
    t = threshold.scalar()
    kept = F.col("score") >= t
    counts = table.agg(
        F.coalesce(F.max(F.when(kept, F.col("tp"))), F.lit(0)).alias("tp"),
        F.coalesce(F.max(F.when(kept, F.col("fp"))), F.lit(0)).alias("fp"),
        F.max("n_pos").alias("n_pos"),
        *_auc_columns(),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("n_pos") - F.col("tp")
    return counts.select(
        t.alias("threshold"),
        _ratio(2.0 * tp, 2.0 * tp + fp + fn).alias("f1"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        "roc_auc",
        "pr_auc",
    )


def threshold_report(
    df: DataFrame,
    metric: str = "f1",
    min_precision: float = 0.5,
    costs: Costs = Costs(),
    optimize: bool = True,
    label: str = "label",
    score: str = "score",
    calibrate_on: DataFrame | None = None,
    method: str = "isotonic",
) -> DataFrame:
    """Choose a threshold and evaluate at it; the threshold table is built once.

    With ``calibrate_on`` (labels and scores of other rows) the scores are
    calibrated first, and the threshold is one of calibrated scores.
    """
    if calibrate_on is not None:
        from .models import calibrate  # models are compared by the metrics of this module

        df = calibrate(calibrate_on, df, method, label, score, "_calibrated").withColumn(score, F.col("_calibrated"))
    table = threshold_table(df, label, score)
    chosen = find_threshold(df, metric, min_precision, costs, optimize, label, score, table)
    return metrics_at(table, chosen)


def scoring_summary(predictions: DataFrame, truth: str | None = None) -> DataFrame:
    """Totals of a prediction table, with confusion counts when the truth is known."""
    p = F.col("prediction") == 1
    totals: Mapping[str, Column] = {
        "total": F.count(F.lit(1)),
        "predicted": F.count_if(p),
        "threshold": F.max("threshold"),
    }
    if truth:
        y = F.col(truth) == 1
        totals = {
            **totals,
            "tp": F.count_if(y & p),
            "fp": F.count_if(~y & p),
            "fn": F.count_if(y & ~p),
            "tn": F.count_if(~y & ~p),
        }
    summary = predictions.agg(*[e.alias(n) for n, e in totals.items()])
    share = F.lit(100.0) * F.col("predicted") / F.greatest(F.col("total"), F.lit(1))
    summary = summary.withColumn("predicted_percent", share)
    if not truth:
        return summary
    hits = F.col("tp").cast("double")
    return summary.withColumn("precision", hits / F.greatest(F.col("tp") + F.col("fp"), F.lit(1))).withColumn(
        "recall", hits / F.greatest(F.col("tp") + F.col("fn"), F.lit(1))
    )


def apply_threshold(df: DataFrame, threshold: Column | float, score: str = "probability") -> DataFrame:
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return df.withColumn("prediction", at_least(score, t)).withColumn("threshold", t)
