"""Scaling, sampling, evaluation, models, scoring and streaming on small inputs."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazardlake.functions import scalars
from hazardlake.operators import engineer, evaluation, models, sampling, scaling, scoring, stages
from hazardlake.operators.evaluation import Costs
from hazardlake.sources import artifacts
from hazardlake.streaming import live

START = dt.datetime(2023, 1, 1)


def matrix(spark, rows):
    data = [(i, [None if c is None else float(c) for c in r]) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, "id bigint, features array<double>").repartition(3)


def params_of(df):
    return {r.feature_idx: r for r in df.collect()}


def cells(df, name="features"):
    return [list(r[name]) for r in df.orderBy("id").collect()]


def scored(spark, labels, scores):
    return spark.createDataFrame(list(zip(labels, map(float, scores))), "label int, score double").repartition(2)


# -- scaling --------------------------------------------------------------------


def test_scalers(spark):
    df = matrix(spark, [[1, 10], [2, 20], [3, 30], [4, 40], [5, 50]])
    standard, minmax = params_of(scaling.fit_standard(df)), params_of(scaling.fit_minmax(df))
    assert standard[0].center == 3.0 and standard[0].scale == pytest.approx(math.sqrt(2))
    assert (minmax[1].low, minmax[1].high) == (10.0, 50.0)
    new = matrix(spark, [[2.5, 25], [100, 5]])
    assert cells(scaling.apply_scaler(new, scaling.fit_minmax(df))) == [[0.375, 0.375], [24.75, -0.125]]
    got = cells(scaling.apply_scaler(new, scaling.fit_standard(df)))
    assert got[0] == pytest.approx([-0.5 / math.sqrt(2), -5 / (10 * math.sqrt(2))])


def test_scaler_edges(spark):
    constant = matrix(spark, [[5], [5], [5]])
    assert params_of(scaling.fit_standard(constant))[0].scale == 1.0
    assert cells(scaling.apply_scaler(constant, scaling.fit_minmax(constant))) == [[0.0]] * 3
    gaps = matrix(spark, [[1], [None], [float("nan")], [3]])
    as_zero = params_of(scaling.fit_standard(gaps))[0]
    assert (as_zero.center, as_zero.n) == (1.0, 4) and as_zero.var == pytest.approx(1.5)
    present = params_of(scaling.fit_standard(gaps, missing_as_zero=False, ddof=1))[0]
    assert (present.center, present.n) == (2.0, 2) and present.var == pytest.approx(2.0)
    low = params_of(scaling.fit_minmax(gaps))[0]
    assert (low.low, low.high) == (1.0, 3.0)
    assert scaling.fit_scaler(gaps, "none") is None
    with pytest.raises(ValueError):
        scaling.fit_scaler(gaps, "robust")
    with pytest.raises(ValueError):
        scaling.require_rows(gaps.limit(0))


def test_standard_scaler_against_numpy(spark):
    x = np.random.default_rng(0).random((1000, 10)) * 100
    got = params_of(scaling.fit_standard(matrix(spark, x.tolist())))
    assert [got[i].center for i in range(10)] == pytest.approx(list(x.mean(axis=0)), abs=1e-5)
    assert [got[i].scale for i in range(10)] == pytest.approx(list(x.std(axis=0)), abs=1e-5)


def test_scaler_on_disk(spark, tmp_path):
    df = matrix(spark, [[1, 10], [2, 20], [3, 30], [4, 40]])
    for kind in ("standard", "minmax"):
        path = artifacts.save_scaler(scaling.fit_scaler(df, kind), str(tmp_path / kind))
        assert artifacts.load_scaler(spark, path).orderBy("feature_idx").collect() == scaling.fit_scaler(df, kind).orderBy("feature_idx").collect()
    untagged = scaling.fit_minmax(df).drop("kind")
    path = artifacts.save_scaler(untagged, str(tmp_path / "untagged"))
    assert artifacts.load_scaler(spark, path).head().kind == "minmax"
    path = artifacts.save_scaler(untagged.withColumn("kind", F.lit("odd")), str(tmp_path / "odd"))
    with pytest.raises(ValueError):
        artifacts.load_scaler(spark, path)
    with pytest.raises(FileNotFoundError):
        artifacts.load_scaler(spark, str(tmp_path / "none"))


def test_components_against_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 2)) @ rng.normal(size=(2, 5)) + 0.05 * rng.normal(size=(200, 5)) + 3.0
    df = matrix(spark, x.tolist())
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    values, vectors = np.linalg.eigh(np.cov(z.T))
    ratio = values[::-1] / values.sum()
    fitted = scaling.fit_components(df, 0.95)
    assert fitted.keep == int(np.searchsorted(np.cumsum(ratio), 0.95, side="right") + 1)
    assert fitted.variance_ratio == pytest.approx(list(ratio[: fitted.keep]), abs=1e-8)
    got = np.array(cells(fitted.transform(df), "components"))
    want = z @ vectors[:, ::-1][:, : fitted.keep]
    assert np.allclose(np.abs(got), np.abs(want), atol=1e-6)
    assert fitted.names == [f"pca_{i}" for i in range(fitted.keep)]
    assert scaling.fit_components(df, 2).keep == 2


def test_engineered_shape(spark):
    rows = [(START + dt.timedelta(hours=i), [float(i * j) for j in range(5)]) for i in range(10)]
    df = spark.createDataFrame(rows, "batch_time timestamp_ntz, features array<float>")
    spec = engineer.Features(calendar=False, lags=(1,), windows=(3,), n_features=2)
    out, names = engineer.engineer(df, spec, ["batch_time"])
    assert len(names) == 11 and {len(r.engineered) for r in out.collect()} == {11}
    full, names = engineer.engineer(df, engineer.Features(lags=(1,), windows=()), ["batch_time"], bucket_rows=3)
    assert len(names) == 5 + 10 + 5 and names[5] == "hour_sin"
    assert {len(r.engineered) for r in full.collect()} == {20}


def test_prepare_keeps_validation_untouched(spark):
    rows = [(START + dt.timedelta(hours=i), int(i % 5 == 0), [float(i % 7), float(i)]) for i in range(60)]
    df = spark.createDataFrame(rows, "batch_time timestamp_ntz, label int, features array<float>")
    spec = engineer.Features(lags=(1,), windows=(2,))
    ready = engineer.prepare(df, spec, "batch_time", "label", ["batch_time"], smote_ratio=0.5)
    counts = {r.label: r["count"] for r in ready.train.groupBy("label").count().collect()}
    assert ready.validation.count() == 12 and counts == {0: 38, 1: 19}
    pca = engineer.prepare(df, spec, "batch_time", "label", ["batch_time"], components=2, scaler="none", split="random")
    assert pca.names == ["pca_0", "pca_1"] and len(pca.train.head().features) == 2
    with pytest.raises(ValueError):
        engineer.prepare(df, spec, "batch_time", "label", ["batch_time"], split="other")


# -- sampling ----------------------------------------------------------------------


def test_random_operators_ignore_partitioning(spark):
    rows = [(i, int(i % 9 == 0)) for i in range(300)]
    one = spark.createDataFrame(rows, "id int, label int").coalesce(1)
    many = one.repartition(8)
    for fn in (
        lambda d: sampling.random_split(d, ["id"], 0.25),
        lambda d: sampling.stratified_folds(d, ["id"], "label", 4),
        lambda d: sampling.plain_folds(d, ["id"], 2),
        lambda d: sampling.random_sample(d, ["id"], 0.6),
        lambda d: sampling.undersample(d, ["id"], "label"),
    ):
        assert sorted(fn(one).collect()) == sorted(fn(many).collect())
    split = sampling.random_split(many, ["id"], 0.25)
    assert split.filter("NOT is_train").count() == 75
    assert sampling.random_sample(many, ["id"], 0.6).count() == 180
    folds = sampling.stratified_folds(many, ["id"], "label", 4).groupBy("label", "fold").count().collect()
    for label in (0, 1):
        sizes = [r["count"] for r in folds if r.label == label]
        assert len(sizes) == 4 and max(sizes) - min(sizes) <= 1
    under = {r.label: r["count"] for r in sampling.undersample(many, ["id"], "label").groupBy("label").count().collect()}
    assert under == {0: 34, 1: 34}


@pytest.mark.parametrize("kind, block_members", [("cloud", 2048), ("clusters", 16), ("grid", 16)])
def test_nearest_neighbours_against_brute_force(spark, kind, block_members):
    rng = np.random.default_rng(3)
    if kind == "cloud":
        x = rng.normal(size=(150, 3))
    elif kind == "clusters":
        x = np.vstack([rng.normal(size=(50, 3)) * 0.01 + c for c in ([0, 0, 0], [5, 5, 5], [100, 0, 0])])
    else:
        x = np.array([[i % 10, i // 10, 0.0] for i in range(120)])
    df = spark.createDataFrame([(i, [float(c) for c in r]) for i, r in enumerate(x)], "key bigint, x array<double>")
    got = {}
    for r in sampling.nearest_neighbours(df.repartition(3), 5, block_members=block_members).collect():
        got.setdefault(r.key, {})[r["rank"]] = r.neighbour
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2)
    np.fill_diagonal(d, np.inf)
    for i in range(len(x)):
        want = sorted(range(len(x)), key=lambda j: (d[i, j], j))[:5]
        assert [got[i][k] for k in range(1, 6)] == want


def test_smote(spark):
    rng = random.Random(2)
    rows = [(i, 0, [rng.random(), rng.random()]) for i in range(60)]
    rows += [(100 + i, 1, [2 + rng.random(), 2 + rng.random()]) for i in range(8)]
    rows += [(200 + i, 1, [9.0, 9.0]) for i in range(7)]
    df = spark.createDataFrame(rows, "id bigint, label int, features array<double>").repartition(4)
    new = sampling.smote(df, "id", "label", ratio=0.9).collect()
    assert len(new) == int(60 * 0.9 - 15) and {r.label for r in new} == {1}
    vectors = {r[0]: r[2] for r in rows}
    minority = sorted(r[0] for r in rows if r[1] == 1)
    for r in new:
        a, b = vectors[r.base_key], vectors[minority[r.neighbour_row]]
        for x, p, q in zip(r.features, a, b):
            assert min(p, q) - 1e-9 <= x <= max(p, q) + 1e-9
        if r.base_key >= 200:
            # Six other copies fill all five neighbour places.
            assert list(r.features) == [9.0, 9.0]
    assert len({r.base_key for r in new}) == 15
    assert sorted(map(repr, new)) == sorted(map(repr, sampling.smote(df.coalesce(1), "id", "label", ratio=0.9).collect()))
    with pytest.raises(ValueError):
        sampling.smote(df, "id", "label", ratio=0.1)


# -- evaluation ------------------------------------------------------------------------


def test_cost_and_weights(spark):
    costs = Costs(fn=100, fp=10, tp=90, tn=0)
    df = spark.createDataFrame([(10, 5, 2, 100)], "tp int, fp int, fn int, tn int")
    assert df.select(evaluation.benefit(costs).alias("b")).head().b == 650
    assert costs.class_weights() == {0: 1.0, 1: 10.0}


@pytest.mark.parametrize(
    "labels, scores, metric, costs, expected",
    [
        ((0, 0, 0, 1, 1, 1), (0.1, 0.4, 0.45, 0.55, 0.8, 0.9), "f1", Costs(), 0.55),
        ((0, 0, 0, 1, 1, 1), (0.1, 0.2, 0.3, 0.7, 0.8, 0.9), "youden", Costs(), 0.7),
        ((0, 0, 0, 0, 1, 1), (0.1, 0.2, 0.3, 0.4, 0.7, 0.9), "cost", Costs(fn=100, fp=10), 0.41),
        ((1, 0), (0.2, 0.8), "youden", Costs(), math.inf),
        ((0, 1), (0.3, 0.6), "nothing", Costs(), 0.5),
    ],
)
def test_thresholds(spark, labels, scores, metric, costs, expected):
    got = evaluation.find_threshold(scored(spark, labels, scores), metric, costs=costs).head().threshold
    assert got == pytest.approx(expected)


def test_thresholds_against_brute_force(spark):
    rng = random.Random(4)
    labels = [int(rng.random() < 0.3) for _ in range(400)]
    scores = [round(min(max(rng.gauss(0.4 + 0.2 * y, 0.2), 0), 1), 2) for y in labels]
    df, table = scored(spark, labels, scores), None
    table = evaluation.threshold_table(df)

    def at(t):
        tp = sum(y and s >= t for y, s in zip(labels, scores))
        fp = sum((not y) and s >= t for y, s in zip(labels, scores))
        return tp, fp

    n_pos, n_neg = sum(labels), len(labels) - sum(labels)
    candidates = sorted(set(scores))
    p = {t: at(t)[0] / sum(at(t)) for t in candidates}
    r = {t: at(t)[0] / n_pos for t in candidates}
    f1 = {t: 2 * (p[t] * r[t]) / (p[t] + r[t] + 1e-9) for t in candidates}
    assert evaluation.threshold_f1(table).head().threshold == max(candidates, key=lambda t: (f1[t], -t))
    good = [t for t in candidates if p[t] >= 0.5]
    assert evaluation.threshold_recall(table, 0.5).head().threshold == max(good, key=lambda t: (r[t], -t))
    assert evaluation.threshold_recall(table, 1.1).head().threshold == 0.5
    j = {t: at(t)[0] / n_pos - at(t)[1] / n_neg for t in candidates}
    assert evaluation.threshold_youden(table).head().threshold == max(candidates, key=lambda t: (j[t], t))
    grid = evaluation.Grid().values()
    costs = Costs(fn=7, fp=3, tp=5, tn=1)

    def value(t):
        tp, fp = at(t)
        return tp * 5 + (n_neg - fp) * 1 - (n_pos - tp) * 7 - fp * 3

    best = max(grid, key=lambda t: (value(t), -t))
    assert evaluation.threshold_cost(df, costs).head().threshold == best
    got = {row.threshold: row.benefit for row in evaluation.cost_table(df, costs).collect()}
    assert got == {t: value(t) for t in grid}
    pairs = [(a, b) for a, y in zip(scores, labels) if y for b, z in zip(scores, labels) if not z]
    area = sum((a > b) + 0.5 * (a == b) for a, b in pairs) / len(pairs)
    assert evaluation.auc(table).head().roc_auc == pytest.approx(area)
    report = evaluation.threshold_report(df).head()
    t = report.threshold
    assert report.precision == pytest.approx(p[t]) and report.recall == pytest.approx(r[t])


def test_curves(spark):
    table = evaluation.threshold_table(scored(spark, (0, 0, 1, 1, 0, 1), (0.1, 0.4, 0.35, 0.8, 0.8, 0.7)))
    row = evaluation.auc(table).head()
    assert row.pr_auc == pytest.approx(0.588889, abs=1e-6) and row.roc_auc == pytest.approx(0.611111, abs=1e-6)
    roc = evaluation.roc_curve(table).orderBy(F.desc("threshold")).collect()
    assert (roc[0].threshold, roc[0].fpr, roc[0].tpr) == (math.inf, 0.0, 0.0) and (roc[-1].fpr, roc[-1].tpr) == (1.0, 1.0)
    pr = evaluation.pr_curve(table).filter("threshold IS NULL").head()
    assert (pr.precision, pr.recall) == (1.0, 0.0)
    assert evaluation.nearest_point(evaluation.roc_curve(table), 0.71).head().threshold == 0.7


def test_cost_grid_cells_at_exact_thresholds(spark):
    grid = evaluation.Grid()
    scores = [s for t in grid.values() for s in (t, math.nextafter(t, 2), math.nextafter(t, -1))] + [-1.0, 0.0, 1.0, 2.0]
    df = spark.createDataFrame([(s,) for s in scores], "s double").select("s", grid.cell(F.col("s")).alias("c"))
    assert all(r.c == sum(t <= r.s for t in grid.values()) for r in df.collect())


def test_metrics_without_positives(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "label int, prediction int")
    row = evaluation.class_metrics(evaluation.confusion(df)).head()
    assert (row.accuracy, row.precision, row.recall, row.f1, row.specificity, row.mcc) == (1.0, 0, 0, 0, 1.0, 0)


def test_hard_metrics(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0)], "label int, prediction int")
    row = evaluation.hard_metrics(evaluation.confusion(df)).head()
    assert row.hard_roc_auc == 0.75
    assert row.hard_log_loss == pytest.approx(-math.log(np.finfo(float).eps) / 4)


@pytest.mark.parametrize("width", [3, 150])
def test_linear_score(spark, width):
    weights = [0.5 * i - 1 for i in range(width)]
    rows = [(0, [float(i % 4) for i in range(width)]), (1, [1.0] * (width + 1)), (2, [None] + [1.0] * (width - 1))]
    df = spark.createDataFrame(rows, "id int, x array<float>")
    got = [r.z for r in df.select("id", scalars.linear_score("x", weights, 0.25).alias("z")).orderBy("id").collect()]
    assert got[0] == pytest.approx(0.25 + sum(w * (i % 4) for i, w in enumerate(weights))) and got[1:] == [None, None]


def test_risk_report(spark):
    rows = [(i / 20, int(i >= 18), 0.9, f"t{i:02d}") for i in range(20)]
    df = spark.createDataFrame(rows, "probability double, prediction int, threshold double, batch_time string")
    assert [r.batch_time for r in scoring.risk_report(df).collect()] == ["t19", "t18"]
    none = df.withColumn("prediction", F.lit(0))
    assert sorted(r.batch_time for r in scoring.risk_report(none).collect()) == ["t15", "t16", "t17", "t18", "t19"]
    assert scoring.effective_threshold(0.03, 0.78) == 0.03 and scoring.effective_threshold(0.03, 0.78, False) == 0.78
    assert scoring.effective_threshold(None, 0.78) == 0.78


# -- models ------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(7)
    x = rng.random((100, 5))
    rows = [(i, int(v[0] > 0.5), [float(c) for c in v]) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "id bigint, label int, features array<double>").cache()


def test_registry():
    assert models.available() == ["gaussian", "gbt", "logreg", "mlp", "random_forest"]
    with pytest.raises(ValueError, match="unknown model"):
        models.build("none")


def test_logistic_regression_matches_a_newton_solve(spark, points):
    weights = {0: 1.0, 1: 3.0}
    model = models.fit("logreg", points, weights=weights)
    rows = points.orderBy("id").collect()
    x = np.array([[*r.features, 1.0] for r in rows])
    y = np.array([r.label for r in rows], dtype=float)
    w = np.where(y == 1, 3.0, 1.0)
    ridge = np.diag([1.0] * 5 + [0.0])
    beta = np.zeros(6)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        gradient = x.T @ (w * (p - y)) + ridge @ beta
        beta -= np.linalg.solve(x.T @ (x * (w * p * (1 - p))[:, None]) + ridge, gradient)
    assert list(model.coefficients) == pytest.approx(list(beta[:5]), abs=1e-4)
    assert model.intercept == pytest.approx(beta[5], abs=1e-4)
    p = [r.probability for r in models.with_probability(model, points).collect()]
    assert len(p) == 100 and all(0 <= v <= 1 for v in p)


def test_a_perceptron_works_on_all_cores(spark, monkeypatch):
    """Rows that come in one partition are dealt to several tasks, where a model works long on each row."""

    class Recorder:
        def fit(self, table):
            parts = [[r["_vector"][0] for r in rows] for rows in table.rdd.glom().collect()]
            stacks = [rows[i : i + 128] for rows in parts for i in range(0, len(rows), 128)]
            assert sorted(map(len, stacks))[1:] == [128] * (len(stacks) - 1)  # one is not full, as in one partition
            assert all(s == [s[0] + i for i in range(len(s))] for s in stacks)
            return len(parts), sum(map(len, parts))

    monkeypatch.setattr(models, "build", lambda name, **context: Recorder())
    rows = spark.range(5000).coalesce(1).select((F.col("id") % 2).cast("int").alias("label"), F.array(F.col("id") * 1.0).alias("features"))
    assert models.fit("mlp", rows) == (5, 5000)
    assert models.fit("mlp", rows.limit(1000)) == (1, 1000)
    assert models.fit("random_forest", rows) == (1, 5000)  # its draws belong to the partitions


def test_compare_isolates_failures(spark, points):
    found = models.compare(points, points, ["logreg", "none", "random_forest"], options={"random_forest": {"trees": 5}})
    rows = {r.model: r for r in found.collect()}
    assert "unknown model" in rows["none"].error and rows["none"].f1 is None
    assert rows["logreg"].error is None and rows["logreg"].roc_auc > 0.9
    assert models.select_best(found, "roc_auc").head().best_model in ("logreg", "random_forest")


def test_select_best(spark):
    schema = "position int, model string, pr_auc double, error string"
    found = spark.createDataFrame([(0, "logreg", 0.7, None), (1, "rf", 0.85, None), (2, "gbt", 0.85, None)], schema)
    assert models.select_best(found).head().best_model == "rf"
    assert models.select_best(found, "no_metric").head().best_model == ""
    broken = spark.createDataFrame([(0, "logreg", None, "no")], schema)
    assert models.select_best(broken).head().best_model == ""


def test_other_models(spark, points):
    for name, options in (("gbt", {"rounds": 3, "depth": 3}), ("mlp", {"hidden": (8,), "max_iter": 20})):
        model = models.fit(name, points, **options)
        p = [r.probability for r in models.with_probability(model, points).collect()]
        assert len(p) == 100 and all(0 <= v <= 1 for v in p)


def test_cross_validation(spark, points):
    folds = models.cross_validate(points, "logreg", "id", k=4)
    assert folds.count() == 4 and folds.filter("roc_auc < 0.8").count() == 0
    best = models.best_fold(folds).head().best_fold
    assert {r.fold: r.f1 for r in folds.collect()}[best] == max(r.f1 for r in folds.collect())
    summary = models.fold_summary(folds).head()
    values = [r.f1 for r in folds.collect()]
    assert summary.f1_mean == pytest.approx(np.mean(values)) and summary.f1_std == pytest.approx(np.std(values))


def test_calibration(spark):
    train = scored(spark, (0, 0, 1, 0, 1, 1), (0.1, 0.2, 0.3, 0.4, 0.6, 0.9))
    new = scored(spark, (0, 0, 0), (0.0, 0.35, 1.0))
    iso = [r.calibrated for r in models.calibrate(train, new, "isotonic").orderBy("score").collect()]
    assert iso == pytest.approx([0.0, 0.5, 1.0])
    platt = [r.calibrated for r in models.calibrate(train, new, "sigmoid").orderBy("score").collect()]
    assert platt == sorted(platt) and 0 < platt[0] < platt[2] < 1
    same = models.calibrate(train, new, "none").collect()
    assert all(r.calibrated == r.score for r in same)


def test_model_on_disk(spark, points, tmp_path):
    from pyspark.ml.classification import LogisticRegressionModel

    model = models.fit("logreg", points)
    path = artifacts.save_model(spark, model, str(tmp_path / "m"), [f"v_{i}" for i in range(5)], 0.37, {"note": "x"})
    metadata = artifacts.load_metadata(spark, path)
    assert metadata["n_features"] == 5 and metadata["extra"] == {"note": "x", "optimal_threshold": 0.37}
    again = LogisticRegressionModel.load(f"{path}/model")
    a = [r.probability for r in models.with_probability(model, points).orderBy("id").collect()]
    b = [r.probability for r in models.with_probability(again, points).orderBy("id").collect()]
    assert a == b


# -- streaming -----------------------------------------------------------------------------


def test_live_outcomes(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 1.0]), (3, [0.2, 0.0])], "id int, values array<double>")
    got = {r.id: r.outcome for r in live.judge(df, (2.0, 2.0), -1.0).collect()}
    assert got == {1: live.NO_INFORMATION, 2: live.ALERT, 3: live.NO_ALERT}


def test_streams_equal_batch_and_resume(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = [(START + dt.timedelta(minutes=7 * i), i % 11 == 0, i % 5) for i in range(200)]
    schema = "ts timestamp, is_emergency boolean, user bigint"
    spark.createDataFrame(rows[:120], schema).coalesce(1).write.parquet(source)
    stream = lambda: live.follow(spark, source, spark.createDataFrame([], schema).schema, files_per_batch=1)
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    live.run_upserts(live.hourly_rollup(stream()), out, progress, once=True).awaitTermination()
    spark.createDataFrame(rows[120:], schema).coalesce(1).write.mode("append").parquet(source)
    live.run_upserts(live.hourly_rollup(stream()), out, progress, once=True).awaitTermination()
    got = {(r.batch_time, r.is_emergency, r.n_ops) for r in live.latest_versions(spark, out, ["batch_time"]).collect()}
    batch = spark.createDataFrame(rows, schema).groupBy(F.date_trunc("hour", "ts").alias("h")).agg(
        F.max(F.col("is_emergency").cast("int")).alias("e"), F.count(F.lit(1)).alias("n")
    )
    assert got == {(r.h, r.e, r.n) for r in batch.collect()}
    firsts = live.first_arrivals(stream().select("user", "ts"), ["user"], "ts", "30 days")
    path = str(tmp_path / "firsts")
    live.run_to_table(firsts, path, str(tmp_path / "firsts-progress"), once=True).awaitTermination()
    assert sorted(r.user for r in spark.read.parquet(path).collect()) == [0, 1, 2, 3, 4]


# -- versions of a streaming table --------------------------------------------


def test_merged_versions_hold_the_state_and_stay_few(spark, tmp_path):
    path, rng, state = str(tmp_path / "state"), np.random.default_rng(5), {}
    for number in range(11):
        changed = {int(k): float(v) for k, v in zip(rng.integers(0, 20, 6), rng.normal(size=6))}
        batch = spark.createDataFrame(list(changed.items()), "k int, v double")
        live.write_version(batch, path, number)
        live.write_version(batch, path, number)  # a repeated batch
        state |= changed
        if number % 3 == 2:
            live.merge_versions(spark, path, ["k"])
            live.merge_versions(spark, path, ["k"])  # nothing new
        assert {r.k: r.v for r in live.latest_versions(spark, path, ["k"]).collect()} == state
    folders = sorted(p.name for p in (tmp_path / "state").iterdir())
    assert folders == ["batch=10", "batch=6", "batch=7", "batch=8", "batch=9", "merged=5", "merged=8"]


def test_a_killed_merge_loses_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "state")
    for number in range(4):
        live.write_version(spark.createDataFrame([(number % 2, float(number)), (9, float(-number))], "k int, v double"), path, number)
        if number == 1:
            live.merge_versions(spark, path, ["k"])
    want = {0: 2.0, 1: 3.0, 9: -3.0}
    # killed while writing: files, but no mark that they are whole
    spark.createDataFrame([(0, 99.0, 3)], "k int, v double, _version bigint").write.parquet(f"{path}/merged=3")
    (tmp_path / "state" / "merged=3" / "_SUCCESS").unlink()
    assert {r.k: r.v for r in live.latest_versions(spark, path, ["k"]).collect()} == want
    # killed before it deletes
    real = live._file_system
    calls = []

    def dies(spark, path):
        calls.append(path)
        if len(calls) == 2:
            raise KeyboardInterrupt
        return real(spark, path)

    monkeypatch.setattr(live, "_file_system", dies)
    with pytest.raises(KeyboardInterrupt):
        live.merge_versions(spark, path, ["k"])
    monkeypatch.setattr(live, "_file_system", real)
    assert {r.k: r.v for r in live.latest_versions(spark, path, ["k"]).collect()} == want
    live.write_version(spark.createDataFrame([(0, 7.0)], "k int, v double"), path, 4)
    live.merge_versions(spark, path, ["k"])
    assert {r.k: r.v for r in live.latest_versions(spark, path, ["k"]).collect()} == want | {0: 7.0}
    assert sorted(p.name for p in (tmp_path / "state").iterdir()) == ["batch=4", "merged=3", "merged=4"]


def test_first_rows_of_a_shuffled_stream_are_the_first_in_order(spark, tmp_path):
    rng = random.Random(4)
    start = dt.datetime(2023, 1, 1)
    rows = [(i % 5, start + dt.timedelta(hours=i % 3), rng.random(), i, f"t{i}") for i in range(240)]
    rng.shuffle(rows)
    schema = "user int, hour timestamp, at double, id int, what string"
    for n in range(6):
        spark.createDataFrame(rows[n * 40 : n * 40 + 40], schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"part{n}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    path = str(tmp_path / "firsts")
    firsts = live.first_in_order(stream, ["user"], "hour", ["at", "id"], "1 day")
    live.run_upserts(firsts, path, str(tmp_path / "progress"), once=True, keys=["user", "hour"], merge_every=2).awaitTermination()
    got = {(r.user, r.hour): tuple(r) for r in live.latest_versions(spark, path, ["user", "hour"]).select("user", "hour", "at", "id", "what").collect()}
    want = {}
    for r in sorted(rows, key=lambda r: (r[2], r[3])):
        want.setdefault(r[:2], r)
    assert got == want
    with pytest.raises(ValueError):
        live.run_upserts(firsts, path, str(tmp_path / "other"), merge_every=2)


@pytest.mark.parametrize("components", [None, 3])
def test_a_saved_run_scores_as_the_fitted_one(spark, tmp_path, components):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(120, 3))
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), int(x[i, 0] + 0.3 * x[i, 1] > 0.2), x[i].tolist()) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, batch_time timestamp_ntz, label int, features array<double>")
    spec = engineer.Features(lags=(1, 2), windows=(3,), n_features=2)
    run = stages.train(df, spec, "id", "label", ["batch_time"], "gaussian", components=components)
    path = stages.save_run(run, str(tmp_path / "run"), ["a", "b", "c"], {"model": "gaussian"})
    again = artifacts.load_model(spark, path)
    # shuffled rows without the label, and a column that the stages know nothing of
    fresh = df.drop("label").withColumn("note", F.lit("x")).repartition(5)
    got = {r.id: r for r in again.transform(fresh).collect()}
    assert set(got) == set(range(120)) and set(got[0].asDict()) == {"id", "batch_time", "features", "note", "probability", "prediction"}
    held = {r.id: r.probability for r in run.scored.collect()}
    assert len(held) == 24 and all(got[i].probability == pytest.approx(p, abs=1e-9) for i, p in held.items())
    assert all(r.prediction == int(r.probability >= run.threshold) for r in got.values())
    saved = artifacts.load_metadata(spark, path)
    assert saved["extra"]["optimal_threshold"] == run.threshold and saved["feature_columns"] == ["a", "b", "c"]
    assert saved["extra"]["metrics"]["f1"] == pytest.approx(run.metrics.head().f1)


def test_new_rows_need_the_rows_within_reach_only(spark):
    rows = [(i, [float(i * i % 7), float(i % 5)]) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, features array<double>")
    spec = engineer.Features(calendar=False, lags=(1, 4), windows=(3,))
    stage = stages.EngineeredFeatures.of(spec, ["id"], ["id"])
    assert stage.reach == 4
    whole = {r.id: r["_engineered"] for r in stage.transform(df).collect()}
    late = {r.id: r["_engineered"] for r in stage.transform(df.filter(F.col("id") >= 30 - stage.reach)).collect()}
    assert all(late[i] == pytest.approx(whole[i]) for i in range(30, 40))


def test_a_scaler_stage_keeps_what_it_fitted(spark, tmp_path):
    df = spark.createDataFrame([([1.0, 5.0],), ([3.0, 5.0],)], "features array<double>")
    for kind, first in (("standard", [-1.0, 0.0]), ("minmax", [0.0, 0.0])):
        model = stages.FeatureScaler(kind=kind, outputCol="out").fit(df)
        model.write().overwrite().save(str(tmp_path / kind))
        assert stages.FeatureScalerModel.load(str(tmp_path / kind)).transform(df).orderBy("features").head().out == first
    with pytest.raises(ValueError):
        stages.FeatureScaler().fit(df.limit(0))
