"""Preprocessing and scoring as Spark ML stages, so that a training run is one saved pipeline.

Each stage wraps an operator of this package; fitted values are parameters of
the stage (one or two numbers per feature position) or a model of Spark's own.
``PipelineModel.save`` and ``load`` keep them all in one folder.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass
from typing import Any

from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlake.session import stored
from hazardlake.sources import artifacts

from . import models, scaling
from .engineer import Features, Prepared, engineer, prepare
from .evaluation import Costs, find_threshold
from .ordering import Order

# Columns between the stages; the last stage drops them.
ENGINEERED, SCALED, VECTOR, PROJECTED = "_engineered", "_scaled", "_vector", "_pca"


def _param(name: str, doc: str, convert: Any) -> Param:
    return Param(Params._dummy(), name, doc, convert)


class _Stage(HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """One array or vector column in, one out; parameters are given by name."""

    defaults: dict[str, Any] = {}

    def __init__(self, **given: Any) -> None:
        super().__init__()
        self._setDefault(**self.defaults)
        self._set(**given)


class EngineeredFeatures(Transformer, _Stage):
    """Calendar, lag and rolling features of an ordered table (:func:`engineer.engineer`).

    It has nothing to fit and can be applied to any table: lags and statistics
    look at the rows of that table, so new rows are given together with the
    ``reach`` rows before them, whose results are then dropped.
    """

    spec = _param("spec", "fields of Features", TypeConverters.identity)
    orderBy = _param("orderBy", "columns of the order", TypeConverters.toListString)
    key = _param("key", "columns that identify a row", TypeConverters.toListString)
    time = _param("time", "time column of the calendar features", TypeConverters.toString)

    defaults = {"time": "batch_time", "inputCol": "features", "outputCol": ENGINEERED}

    @classmethod
    def of(cls, spec: Features, order_by: Sequence[str], key: Sequence[str], **names: str) -> EngineeredFeatures:
        plain = {k: v if isinstance(v, (bool, int)) else list(v) for k, v in asdict(spec).items()}
        return cls(spec=plain, orderBy=list(order_by), key=list(key), **names)

    def features(self) -> Features:
        return Features(**self.getOrDefault(self.spec))

    @property
    def reach(self) -> int:
        """How many rows before a row its features depend on."""
        spec = self.features()
        return max([0, *spec.lags, *(w + spec.gap - 1 for w in spec.windows)])

    def _transform(self, df: DataFrame) -> DataFrame:
        return engineer(
            df,
            self.features(),
            self.getOrDefault(self.orderBy),
            self.getOrDefault(self.time),
            self.getInputCol(),
            self.getOutputCol(),
            key=self.getOrDefault(self.key),
        )[0]


class FeatureScaler(Estimator, _Stage):
    """Fits ``standard`` or ``minmax`` scaling of an array column."""

    kind = _param("kind", "standard or minmax", TypeConverters.toString)

    defaults = {"kind": "standard", "inputCol": "features", "outputCol": SCALED}

    def _fit(self, df: DataFrame) -> FeatureScalerModel:
        params = scaling.fit_scaler(scaling.require_rows(df), self.getOrDefault(self.kind), self.getInputCol())
        return FeatureScalerModel.of(params, inputCol=self.getInputCol(), outputCol=self.getOutputCol())


class FeatureScalerModel(Model, _Stage):
    """``(x - center) / scale`` per position."""

    center = _param("center", "what is subtracted, per position", TypeConverters.toListFloat)
    scale = _param("scale", "what is divided by, per position", TypeConverters.toListFloat)

    defaults = {"inputCol": "features", "outputCol": SCALED}

    @classmethod
    def of(cls, params: DataFrame, **names: str) -> FeatureScalerModel:
        """From a parameter table: one row per feature position."""
        rows = params.orderBy("feature_idx").select("center", "scale").collect()
        return cls(center=[float(r["center"] or 0.0) for r in rows], scale=[float(r["scale"]) for r in rows], **names)

    def _transform(self, df: DataFrame) -> DataFrame:
        pairs = zip(self.getOrDefault(self.center), self.getOrDefault(self.scale))
        params = df.sparkSession.createDataFrame(
            [(i, c, s) for i, (c, s) in enumerate(pairs)], "feature_idx int, center double, scale double"
        )
        return scaling.apply_scaler(df, params, self.getInputCol(), self.getOutputCol())


class ArrayToVector(Transformer, _Stage):
    """An array as a Spark ML vector; missing cells count as 0."""

    defaults = {"inputCol": SCALED, "outputCol": VECTOR}

    def _transform(self, df: DataFrame) -> DataFrame:
        return scaling.as_vector(df, self.getInputCol(), self.getOutputCol())


class VectorToArray(Transformer, _Stage):
    """The first ``keep`` cells of a vector as an array."""

    keep = _param("keep", "number of cells", TypeConverters.toInt)

    defaults = {"inputCol": PROJECTED, "outputCol": SCALED}

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getOutputCol(), F.slice(vector_to_array(self.getInputCol()), 1, self.getOrDefault(self.keep)))


class Decision(Transformer, _Stage):
    """``probability`` of class 1 and ``prediction`` at the tuned threshold, null of a model of one class; the columns between the stages go."""

    threshold = _param("threshold", "smallest probability of a positive", TypeConverters.toFloat)

    defaults = {"threshold": 0.5, "inputCol": models.OUTPUTS["probabilityCol"], "outputCol": "probability"}

    def _transform(self, df: DataFrame) -> DataFrame:
        p = self.getOutputCol()
        decided = df.withColumn(p, F.get(vector_to_array(self.getInputCol()), F.lit(1)))
        decided = decided.withColumn("prediction", (F.col(p) >= self.getOrDefault(self.threshold)).cast("int"))
        return decided.drop(ENGINEERED, SCALED, VECTOR, PROJECTED, *models.OUTPUTS.values())


# -- a training run ------------------------------------------------------------


@dataclass
class TrainingRun:
    """What a run leaves: the fitted pipeline, its threshold, one row of validation metrics, validation scores."""

    pipeline: PipelineModel
    threshold: float
    metrics: DataFrame
    scored: DataFrame


def fitted_pipeline(
    ready: Prepared, engineering: EngineeredFeatures, model: Model, threshold: float
) -> PipelineModel:
    """The steps of :func:`engineer.prepare` with what they fitted, then the model and the decision."""
    stages: list[Transformer] = [engineering]
    last = engineering.getOutputCol()
    if ready.components is not None:
        fitted = ready.components
        stages += [
            FeatureScalerModel.of(fitted.params, inputCol=last, outputCol=SCALED),
            ArrayToVector(inputCol=SCALED, outputCol=VECTOR),
            fitted.model,
            VectorToArray(keep=fitted.keep, inputCol=PROJECTED, outputCol=SCALED),
        ]
        last = SCALED
    if ready.params is not None:
        stages.append(FeatureScalerModel.of(ready.params, inputCol=last, outputCol=SCALED))
        last = SCALED
    return PipelineModel([*stages, ArrayToVector(inputCol=last, outputCol=VECTOR), model, Decision(threshold=threshold)])


def train(
    df: DataFrame,
    spec: Features,
    key: str,
    label: str,
    order_by: Order,
    name: str = "logreg",
    objective: str = "f1",
    costs: Costs = Costs(),
    weights: dict[int, float] | None = None,
    seed: int = 42,
    time: str = "batch_time",
    options: dict[str, Any] | None = None,
    **preparation: Any,
) -> TrainingRun:
    """Features, split, scaling, rebalancing, fit, threshold and metrics in one call.

    ``preparation`` goes to :func:`engineer.prepare`. The threshold is tuned for
    ``objective`` on the validation rows, and the metrics are those at it.
    """
    ready = prepare(df, spec, key, label, order_by, time, seed=seed, **preparation)
    model = models.fit(name, ready.train, label, "features", weights, seed, **(options or {}))
    scored = stored(models.with_probability(model, ready.validation).select(key, label, "probability"), "scored")
    known = scored.filter(F.col("probability").isNotNull())  # a model of one class gives none
    threshold = float(find_threshold(known, objective, label=label, score="probability").head()["threshold"])
    metrics = models.model_metrics(scored, label, "probability", costs, threshold)
    engineering = EngineeredFeatures.of(spec, list(order_by), [key], time=time)
    return TrainingRun(fitted_pipeline(ready, engineering, model, threshold), threshold, metrics, scored)


def save_run(run: TrainingRun, path: str, columns: Sequence[str], parameters: dict[str, Any] | None = None) -> str:
    """The pipeline, the raw feature columns it needs and the settings of the run, in one folder."""
    spark = run.metrics.sparkSession
    metrics = {c: v for c, v in run.metrics.head().asDict().items() if v is not None}
    artifacts.save_model(spark, run.pipeline, path, columns, run.threshold, {"metrics": metrics})
    artifacts.save_parameters(spark, path, parameters or {})
    return path
