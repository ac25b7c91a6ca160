"""Classifiers by name, comparison, cross-validation and calibration (Spark ML)."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from hazardlake.session import checkpoint_dir, stored

from .evaluation import Costs, auc, benefit, class_metrics, confusion, hard_metrics, threshold_table
from .rollup import with_class_weight
from .sampling import stratified_folds
from .scaling import as_vector

# What else is measured per fold, on the 0/1 predictions.
FOLD_METRICS = ("accuracy", "mcc", "hard_roc_auc", "hard_log_loss")

# Output columns of the models, out of the way of a table's own columns.
OUTPUTS = {"predictionCol": "_prediction", "probabilityCol": "_probability", "rawPredictionCol": "_raw"}

# Models that work long on each row, and the rows a task gets: fewer are not worth a task, and no task should hold more.
ROW_HEAVY = ("mlp",)
ROWS_PER_TASK = (1024, 65_536)
# Spark's perceptron stacks so many consecutive rows (its default block size), and all stacks weigh alike, full or not.
STACKED_ROWS = 128

Builder = Callable[..., Estimator]
_BUILDERS: dict[str, Builder] = {}

# Metrics of a comparison; larger is better for each.
METRICS = ("pr_auc", "roc_auc", "f1", "precision", "recall", "cost")


def register(name: str) -> Callable[[Builder], Builder]:
    """Make an estimator available by name; it is called with keyword arguments
    ``features, label, weight, width, weight_sum, seed`` and model options."""

    def add(builder: Builder) -> Builder:
        _BUILDERS[name] = builder
        return builder

    return add


def available() -> list[str]:
    return sorted(_BUILDERS)


def build(name: str, **context: Any) -> Estimator:
    if name not in _BUILDERS:
        raise ValueError(f"unknown model: {name!r}; available: {', '.join(available())}")
    return _outputs_aside(_BUILDERS[name](**context))


def _outputs_aside(estimator: Estimator) -> Estimator:
    for name, column in OUTPUTS.items():
        estimator.set(estimator.getParam(name), column)
    return estimator


@register("logreg")
def _logreg(*, features, label, weight, weight_sum, width, seed, max_iter=1000, c=1.0) -> Estimator:
    # Spark averages the loss over the weights, so an L2 strength of 1 on the
    # summed loss is 1 / (sum of weights) here.
    return LogisticRegression(
        featuresCol=features,
        labelCol=label,
        weightCol=weight,
        maxIter=max_iter,
        regParam=1.0 / (c * weight_sum),
        elasticNetParam=0.0,
        standardization=False,
    )


@register("random_forest")
def _random_forest(*, features, label, weight, weight_sum, width, seed, trees=100, depth=16) -> Estimator:
    return RandomForestClassifier(
        featuresCol=features, labelCol=label, weightCol=weight, numTrees=trees, maxDepth=depth, seed=seed
    )


@register("gbt")
def _gbt(*, features, label, weight, weight_sum, width, seed, rounds=200, depth=6, step=0.1) -> Estimator:
    return GBTClassifier(
        featuresCol=features,
        labelCol=label,
        weightCol=weight,
        maxIter=rounds,
        maxDepth=depth,
        stepSize=step,
        seed=seed,
        cacheNodeIds=True,
        checkpointInterval=10,
    )


@register("mlp")
def _mlp(*, features, label, weight, weight_sum, width, seed, hidden=(256, 128, 64, 32), max_iter=100) -> Estimator:
    # No row weights here: balance the training rows instead.
    return MultilayerPerceptronClassifier(
        featuresCol=features, labelCol=label, layers=[width, *hidden, 2], maxIter=max_iter, seed=seed
    )


@register("gaussian")
def _gaussian(*, features, label, weight, weight_sum, width, seed) -> Estimator:
    """Normal densities per class and feature: fitted in closed form, a baseline for the others."""
    return NaiveBayes(featuresCol=features, labelCol=label, weightCol=weight, modelType="gaussian")


def _dealt(table: DataFrame, rows: int) -> DataFrame:
    """The rows spread over the cores. A narrow table comes in few partitions, and so few tasks would do all the work.

    Stacks are dealt whole and in order, so that each row keeps its weight.
    """
    least, most = ROWS_PER_TASK
    cores = table.sparkSession.sparkContext.defaultParallelism
    parts = max(min(math.ceil(rows / least), 4 * cores), math.ceil(rows / most))
    if parts < 2:
        return table
    # monotonically_increasing_id: partition number above bit 33, row number below.
    stacks = table.withColumn("_at", F.monotonically_increasing_id()).withColumn("_stack", F.floor(F.col("_at") / STACKED_ROWS))
    return stacks.repartition(parts, "_stack").sortWithinPartitions("_at").drop("_at", "_stack")


def fit(
    name: str,
    train: DataFrame,
    label: str = "label",
    features: str = "features",
    weights: dict[int, float] | None = None,
    seed: int = 42,
    **options: Any,
) -> Model:
    """Fit a model by name on an array column; ``weights`` are per class."""
    checkpoint_dir(train.sparkSession)  # boosting cuts its lineage there every few rounds
    table = as_vector(train, features, "_vector").select("_vector", F.col(label).cast("double").alias("_label"))
    w = weights or {0: 1.0, 1: 1.0}
    table = with_class_weight(table, "_label", w[1], "_weight")
    width = F.first(F.size(vector_to_array("_vector")))
    stats = table.agg(F.sum("_weight").alias("s"), width.alias("f"), F.count(F.lit(1)).alias("n")).head()
    if not stats["s"]:
        raise ValueError("no training rows")
    estimator = build(
        name,
        features="_vector",
        label="_label",
        weight="_weight",
        width=int(stats["f"]),
        weight_sum=float(stats["s"]),
        seed=seed,
        **options,
    )
    return estimator.fit(_dealt(table, stats["n"]) if name in ROW_HEAVY else table)


def with_probability(model: Model, df: DataFrame, features: str = "features", out: str = "probability") -> DataFrame:
    """Add the probability of class 1; null where the model has seen one class only and has nothing to tell apart."""
    scored = model.transform(as_vector(df, features, "_vector"))
    return scored.withColumn("_p", F.get(vector_to_array("_probability"), F.lit(1))).select(*df.columns, F.col("_p").alias(out))


def model_metrics(
    scored: DataFrame, label: str, score: str, costs: Costs, threshold: float = 0.5, group: Sequence[str] = ()
) -> DataFrame:
    """One row, or one per group (not null), with all metrics at a fixed threshold.

    All groups share one sort of their distinct scores. Rows without a score count for nothing.
    """
    rows = scored.filter(F.col(score).isNotNull()).select(
        *group,
        F.col(label).alias("label"),
        F.col(score).alias("score"),
        (F.col(score) >= threshold).cast("int").alias("prediction"),
    )
    areas = auc(threshold_table(rows, group=group), group)
    at = hard_metrics(class_metrics(confusion(rows, group=group))).withColumn("cost", benefit(costs))
    both = at.join(areas, list(group)) if group else at.crossJoin(areas)  # without groups one row each
    return both.select(*group, "pr_auc", "roc_auc", *METRICS[2:], *FOLD_METRICS)


def compare(
    train: DataFrame,
    validation: DataFrame,
    names: Sequence[str],
    label: str = "label",
    features: str = "features",
    costs: Costs = Costs(),
    seed: int = 42,
    options: dict[str, dict[str, Any]] | None = None,
    parallelism: int = 1,
) -> DataFrame:
    """One row per model; a model that cannot be fitted gets its error and no metrics, one that scores no row no metrics.

    ``parallelism`` models are fitted at a time. Each stores its scores, and one
    pass over all of them gives every model's curves.
    """
    spark = train.sparkSession
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    validation = validation.persist(StorageLevel.MEMORY_AND_DISK)

    def scores(position: int) -> DataFrame | str:
        name = names[position]
        try:
            weights = None if name == "mlp" else costs.class_weights()
            model = fit(name, train, label, features, weights, seed, **(options or {}).get(name, {}))
            scored = with_probability(model, validation, features, "score")
            return stored(scored.select(F.lit(position).alias("position"), label, "score"), "scores")
        except Exception as e:  # one model's failure must not lose the others
            return str(e)

    try:
        found = _side_by_side(spark, scores, range(len(names)), parallelism)
        metrics = _grouped_metrics([f for f in found if isinstance(f, DataFrame)], "position", label, costs)
    finally:
        train.unpersist()
        validation.unpersist()
    rows = []
    for position, (name, outcome) in enumerate(zip(names, found)):
        error = outcome if isinstance(outcome, str) else None
        m = metrics.get(position, {})
        rows.append((position, name, *[_number(m.get(c)) for c in METRICS], error))
    numbers = ", ".join(f"{c} double" for c in METRICS)
    return spark.createDataFrame(rows, f"position int, model string, {numbers}, error string")


def _side_by_side(spark: SparkSession, work: Callable[[int], Any], items: Sequence[int], parallelism: int) -> list[Any]:
    """What ``work`` gives for each item, in order; Spark runs the jobs of several items at once."""
    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(work), i) for i in items]]


def _grouped_metrics(scored: Sequence[DataFrame], group: str, label: str, costs: Costs) -> dict[int, dict[str, Any]]:
    """Metrics of stored scores by the number in ``group``, from one pass; one small row per model or fold."""
    if not scored:
        return {}
    table = reduce(DataFrame.unionByName, scored)
    return {r[group]: r.asDict() for r in model_metrics(table, label, "score", costs, group=[group]).collect()}


def _number(value: Any) -> float | None:
    """A metric, or null where one class alone leaves it undefined."""
    return None if value is None else float(value)


def select_best(results: DataFrame, metric: str = "pr_auc") -> DataFrame:
    """One row with the best model's name: first on a tie, empty if none has the metric."""
    score = F.col(metric) if metric in results.columns else F.lit(None).cast("double")
    usable = results.filter(F.col("error").isNull() & score.isNotNull() & (score > float("-inf")))
    best = F.min_by("model", F.struct(-score, F.col("position")))
    return usable.agg(F.coalesce(best, F.lit("")).alias("best_model"))


def cross_validate(
    df: DataFrame,
    name: str,
    key: str,
    label: str = "label",
    features: str = "features",
    k: int = 5,
    costs: Costs = Costs(),
    seed: int = 42,
    parallelism: int = 1,
    **options: Any,
) -> DataFrame:
    """Stratified folds: one row per fold with its metrics at 0.5.

    Only key, label and features are stored; each fold is fitted on the others,
    ``parallelism`` folds at a time, and one pass over the held-out scores of all
    folds gives their curves. A fold without rows, or whose model has seen one
    class only and gives no score, has no metrics.
    """
    spark = df.sparkSession
    folds = stored(stratified_folds(df.select(key, label, features), [key], label, k, seed))
    names = ("pr_auc", "roc_auc", "f1", "precision", "recall", *FOLD_METRICS)

    def scores(fold: int) -> DataFrame:
        train, held = folds.filter(F.col("fold") != fold), folds.filter(F.col("fold") == fold)
        model = fit(name, train, label, features, costs.class_weights(), seed, **options)
        return stored(with_probability(model, held, features, "score").select("fold", label, "score"), "scores")

    metrics = _grouped_metrics(_side_by_side(spark, scores, range(k), parallelism), "fold", label, costs)
    rows = [(fold, *[_number(metrics.get(fold, {}).get(c)) for c in names]) for fold in range(k)]
    return spark.createDataFrame(rows, "fold int, " + ", ".join(f"{c} double" for c in names))


def fold_summary(folds: DataFrame) -> DataFrame:
    """Mean and population deviation of each metric over the folds."""
    names = [c for c in folds.columns if c != "fold"]
    return folds.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in names], *[F.stddev_pop(c).alias(f"{c}_std") for c in names]
    )


def best_fold(folds: DataFrame, metric: str = "f1") -> DataFrame:
    """One row with the fold that has the largest metric; the first wins a tie."""
    return folds.agg(F.min_by("fold", F.struct(-F.col(metric), F.col("fold"))).alias("best_fold"))


# -- calibration --------------------------------------------------------------


def calibrate(
    train: DataFrame,
    df: DataFrame,
    method: str = "isotonic",
    label: str = "label",
    score: str = "score",
    out: str = "calibrated",
) -> DataFrame:
    """Fit a calibration on training scores and apply it to ``df``.

    ``isotonic`` clips outside the fitted range; ``sigmoid`` is a logistic
    curve over the score; anything else leaves the score as it is.
    """
    if method == "isotonic":
        # One row per distinct score, weighted by its rows: a hot score is one row, and the fit is the same.
        fitted = train.groupBy(F.col(score).cast("double").alias("_score")).agg(
            F.avg(F.col(label).cast("double")).alias("_label"), F.count(F.lit(1)).cast("double").alias("_n")
        )
        model = IsotonicRegression(featuresCol="_score", labelCol="_label", weightCol="_n", predictionCol="_fit").fit(fitted)
        return (
            model.transform(df.withColumn("_score", F.col(score).cast("double")))
            .withColumn(out, F.col("_fit"))
            .drop("_score", "_fit")
        )
    if method == "sigmoid":
        one = F.array(F.col(score).cast("double"))
        fitted = train.select(array_to_vector(one).alias("_vector"), F.col(label).cast("double").alias("_label"))
        n = fitted.count()
        if not n:
            raise ValueError("no training rows")
        curve = LogisticRegression(
            featuresCol="_vector", labelCol="_label", maxIter=200, tol=1e-12, regParam=1.0 / n, standardization=False
        )
        model = _outputs_aside(curve).fit(fitted)
        scored = model.transform(df.withColumn("_vector", array_to_vector(one)))
        return scored.withColumn("_p", vector_to_array("_probability")[1]).select(*df.columns, F.col("_p").alias(out))
    return df.withColumn(out, F.col(score))
