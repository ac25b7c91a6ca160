"""Per-position statistics, curves of one class, zones, scratch, folders and registered jobs."""

import contextlib
import datetime as dt
import io
import math
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from hazardlake import session
from hazardlake.functions import scalars
from hazardlake.operators import evaluation, joins, models, moments, ordering, sampling, scaling, scoring
from hazardlake.sources import artifacts, delimited

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module", params=["float", "double"])
def wide(request, spark):
    rng = np.random.default_rng(1)
    x = (rng.normal(size=(301, 5)) * 10.0 ** rng.integers(-8, 8, (301, 5))).astype("f4" if request.param == "float" else "f8")
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 3] = np.nan
    x[:200, 1] = -0.0
    rows = [([None if np.isnan(v) else float(v) for v in r],) for r in x]
    return x.astype("f8"), spark.createDataFrame(rows, f"features array<{request.param}>").repartition(3)


def test_moments_are_numpys(wide):
    x, df = wide
    for r in moments.feature_moments(df).collect():
        column = x[:, r["feature_idx"]]
        known = column[~np.isnan(column)]
        assert (r["n"], r["rows"], r["missing"]) == (len(known), len(x), len(x) - len(known))
        if len(known):
            assert r["mean"] == pytest.approx(known.mean()) and r["squares"] == pytest.approx(known.var() * len(known))
            assert (r["low"], r["high"]) == (known.min(), known.max())


@pytest.mark.parametrize("points, exact", [(128, 2048), (4, 8)])
def test_medians_of_many_cells_take_rounds(spark, points, exact):
    """Ties, two far middles, signs, infinities, missing cells and short rows; few points need several passes."""
    rng = np.random.default_rng(11)
    n = 3001
    x = np.column_stack(
        [
            rng.normal(size=n).astype(np.float32),
            np.where(rng.random(n) < 0.95, 0.0, rng.normal(size=n)),
            np.arange(n) % 2,
            np.where(rng.random(n) < 0.4, np.nan, rng.lognormal(0, 3, n)).astype(np.float32),
            np.where(rng.random(n) < 0.6, -np.inf, 1.0),
            np.full(n, np.nan),
        ]
    )
    rows = [(v[: 5 if i % 7 == 0 else 6].tolist(),) for i, v in enumerate(x)] + [(x[0, :2].tolist(),), (None,), ([],)]
    x = np.vstack([x, np.append(x[0, :2], [np.nan] * 4)])
    for kind in ("float", "double"):
        df = spark.createDataFrame(rows, f"features array<{kind}>").repartition(7)
        got = {r["feature_idx"]: r["fill"] for r in moments.exact_medians(df, points=points, exact=exact).collect()}
        cells = x.astype(np.float32).astype(float) if kind == "float" else x
        want = {i: 0.0 if np.isnan(cells[:, i]).all() else float(np.nanmedian(cells[:, i])) for i in range(6)}
        assert got == want


def test_medians_of_3600_positions(spark):
    x = np.random.default_rng(2).normal(size=(400, 3600)).astype(np.float32)
    df = spark.createDataFrame([(v.tolist(),) for v in x], "features array<float>").repartition(3)
    got = {r["feature_idx"]: r["fill"] for r in moments.exact_medians(df).collect()}
    assert got == {i: float(m) for i, m in enumerate(np.median(x.astype(float), axis=0))}


def test_medians_are_numpys(wide):
    x, df = wide
    want = {i: 0.0 if np.isnan(x[:, i]).all() else float(np.nanmedian(x[:, i])) for i in range(5)}
    assert {r["feature_idx"]: r["fill"] for r in moments.exact_medians(df).collect()} == want


def test_statistics_of_nothing(spark):
    none = spark.createDataFrame([([],), (None,)], "features array<float>")
    assert moments.exact_medians(none).count() == moments.feature_moments(none).count() == 0


def test_a_small_spread_around_a_large_mean_is_kept(spark):
    df = spark.createDataFrame([([1e8],), ([1e8 + 1],)], "features array<double>").repartition(2)
    row = scaling.fit_standard(df).head()
    assert row["var"] == 0.25 and row["scale"] == 0.5


def test_zones_change_no_wall_clock(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    texts = ["2023-03-12 02:30:15.5", "2023-11-05 01:30:00", "1965-01-01 00:00:01.25"]
    seen = []
    try:
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            rows = spark.createDataFrame([(t,) for t in texts], "t string").select(scalars.parse_time("t").alias("t"))
            columns = [scalars.floor_time(u, "t").cast("string") for u in ("day", "hour", "minute", "second")]
            seen.append([tuple(r) for r in rows.select(*columns, scalars.time_text("t"), scalars.micros("t")).collect()])
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert seen[0] == seen[1] == seen[2]
    assert seen[0][0] == ("2023-03-12 00:00:00", "2023-03-12 02:00:00", "2023-03-12 02:30:00", "2023-03-12 02:30:15", "2023-03-12 02:30:15", 1678588215500000)


@pytest.mark.parametrize("label", [0, 1])
def test_curves_of_one_class(spark, label):
    df = spark.createDataFrame([(label, s / 10) for s in range(10)], "label int, score double")
    table = evaluation.threshold_table(df)
    areas = evaluation.auc(table).head()
    assert areas["roc_auc"] is None and (areas["pr_auc"] == pytest.approx(1.0) if label else areas["pr_auc"] is None)
    assert evaluation.roc_curve(table).count() == 11 and evaluation.threshold_youden(table).head()["threshold"] == math.inf
    report = evaluation.threshold_report(df).head()
    assert report["roc_auc"] is None and report["f1"] == (1.0 if label else 0.0)
    assert models.model_metrics(df, "label", "score", evaluation.Costs()).head()["roc_auc"] is None


def test_threshold_of_calibrated_scores(spark):
    df = spark.createDataFrame([(int(s > 60), s / 100) for s in range(100)], "label int, score double")
    report = evaluation.threshold_report(df, calibrate_on=df).head()
    assert report["f1"] == 1.0 and report["threshold"] == 1.0


def test_a_false_alarm_must_cost_something():
    with pytest.raises(ValueError):
        evaluation.Costs(fp=0.0).class_weights()


def test_pairs_by_position_through_keys(spark):
    a = spark.createDataFrame([(i, 100 - i, "a" * i) for i in range(10)], "k long, o long, x string")
    b = spark.createDataFrame([(i, -i) for i in range(7)], "j long, p long")
    keyed = joins.positional_join(a, b, ["o"], ["p"], left_key=["k"], right_key=["j"])
    plain = joins.positional_join(a, b, ["o"], ["p"])
    columns = ["row_idx", "k", "o", "x", "j", "p"]
    assert sorted(map(tuple, keyed.select(*columns).collect())) == sorted(map(tuple, plain.select(*columns).collect()))


def test_outlines_in_several_rounds_find_the_same_neighbours(spark):
    rng = np.random.default_rng(2)
    vectors = spark.createDataFrame([(i, rng.normal(size=3).tolist()) for i in range(400)], "key long, x array<double>")
    find = lambda **o: sorted(map(tuple, sampling.nearest_neighbours(vectors, 3, block_members=20, **o).collect()))
    assert find() == find(outlines_at_once=7)


def test_limits_that_shrink_spare_visits_and_lose_no_neighbour(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 64)) * 3
    x = np.vstack([c + rng.normal(size=(30, 64)) * 0.3 for c in centres])
    vectors = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "key long, x array<double>")
    stepwise, at_once = [], []
    rows = sampling.nearest_neighbours(vectors, 3, block_members=20, tighten_after=(4,), visits=stepwise).collect()
    plain = sampling.nearest_neighbours(vectors, 3, block_members=20, tighten_after=(), visits=at_once).collect()
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2)
    np.fill_diagonal(d, np.inf)
    want = {(i, int(j)) for i in range(len(x)) for j in np.argsort(d[i], kind="stable")[:3]}
    assert {(r.key, r.neighbour) for r in rows} == {(r.key, r.neighbour) for r in plain} == want
    assert len(stepwise) == 2 and sum(stepwise) < sum(at_once) < len(x) * len(x) // 20 / 4


def test_blocks_hold_a_fixed_number_of_bytes(spark, monkeypatch):
    """The members of a block depend on the width of a vector, never on the number of vectors."""
    sizes = []
    real = sampling._pivots
    monkeypatch.setattr(sampling, "_pivots", lambda v, key, seed, wanted: sizes.append(wanted) or real(v, key, seed, wanted))
    monkeypatch.setattr(sampling, "BLOCK_BYTES", 8 * 2 * 10)
    for n in (100, 200):
        rows = [(i, [float(i), 1.0]) for i in range(n)]
        sampling.nearest_neighbours(spark.createDataFrame(rows, "key long, x array<double>"), 1).count()
    assert sizes == [10, 20]


def broadcast_columns(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return [re.sub(r"#\d+L?", "", c) for c in re.findall(r"BroadcastExchange\nInput \[\d+\]: \[(.*)\]", text.getvalue())]


def test_vectors_are_not_broadcast(spark):
    """An array counts as one number in the optimizer's sizes, so a large table of vectors looks small to it."""
    rng = np.random.default_rng(6)
    rows = [(i, int(i % 4 == 0), rng.normal(size=8).tolist()) for i in range(400)]
    table = spark.createDataFrame(rows, "key long, label int, x array<double>")
    near = broadcast_columns(sampling.nearest_neighbours(table, 3, block_members=20))
    assert near and not any("x" in c.split(", ") for c in near)
    new = broadcast_columns(sampling.smote(table, "key", "label", "x"))
    assert not any({"x", "y", "near"} & set(c.split(", ")) for c in new)


def test_visits_move_no_vectors_through_a_shuffle(spark):
    """Vectors that are all nearly equally far apart visit every block; what is kept for that does not grow with the visits."""
    rng = np.random.default_rng(8)
    vectors = spark.createDataFrame([(i, rng.normal(size=32).tolist()) for i in range(300)], "key long, x array<double>")
    visits = []
    kept = set(Path(session.checkpoint_dir(spark).removeprefix("file:")).iterdir())
    near = sampling.nearest_neighbours(vectors, 3, block_members=10, tighten_after=(4,), visits=visits)
    kept = {p.name.rsplit("-", 1)[0] for p in set(Path(session.checkpoint_dir(spark).removeprefix("file:")).iterdir()) - kept}
    assert sum(visits) > 20 * 300 and kept <= {"packed", "asking"}
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        near.explain("formatted")
    moved = [re.sub(r"#\d+L?", "", c).split(", ") for c in re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", text.getvalue())]
    assert moved and not any({"x", "host_x", "m_x"} & set(c) for c in moved)


def test_hosts_in_several_groups_find_the_same_neighbours(spark, monkeypatch):
    monkeypatch.setattr(sampling, "HOST_BYTES", 8 * 3 * 20 * 5)
    x = np.random.default_rng(9).normal(size=(240, 3))
    vectors = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "key long, x array<double>")
    rows = sampling.nearest_neighbours(vectors, 3, block_members=20, tighten_after=()).collect()
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2)
    np.fill_diagonal(d, np.inf)
    assert {(r.key, r["rank"], r.neighbour) for r in rows} == {(i, n + 1, int(j)) for i in range(240) for n, j in enumerate(np.argsort(d[i])[:3])}


def test_scratch_of_a_block_goes_with_it(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("kept"))
    with session.owned_scratch(spark):
        table = session.stored(spark.range(10))
        path = table.inputFiles()[0].rsplit("/", 1)[0]
        table.write.mode("overwrite").parquet(out)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    assert spark.read.parquet(out).count() == 10


def test_score_folder_uses_what_was_saved(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("models"))
    rng = np.random.default_rng(3)
    rows = [([float(v) for v in rng.normal(i % 2 * 3, 1, 2)], i % 2) for i in range(200)]
    train = spark.createDataFrame(rows, "features array<double>, label int")
    model = models.fit("gaussian", train)
    artifacts.save_model(spark, model, f"{folder}/m", ["v_0", "v_1"], 0.7)
    text = spark.createDataFrame([("2023-01-01 00:00:00", "3", "3"), ("2023-01-01 01:00:00", "0", None)], "batch_time string, v_0 string, v_1 string")
    delimited.write_delimited(text, f"{folder}/t", ";")
    got = scoring.score_folder(spark, f"{folder}/m", f"{folder}/t", sink=f"{folder}/out").orderBy("batch_time").collect()
    assert [(r["prediction"], r["threshold"]) for r in got] == [(1, 0.7), (0, 0.7)]
    assert spark.read.option("header", True).csv(f"{folder}/out").count() == 2
    with pytest.raises(FileNotFoundError):
        artifacts.load_model(spark, f"{folder}/none")
    artifacts.save_parameters(spark, f"{folder}/m", {"seed": 1})
    assert artifacts.load_parameters(spark, f"{folder}/m") == {"seed": 1}


def test_undersampling_keeps_as_many_of_each_label(spark):
    df = spark.createDataFrame([(i, i % 7 == 0) for i in range(700)], "k long, y boolean")
    kept = sampling.undersample(df, ["k"], "y")
    assert {r["y"]: r["count"] for r in kept.groupBy("y").count().collect()} == {True: 100, False: 100}
    assert kept.select(F.countDistinct("k")).head()[0] == 200


def test_running_totals_of_groups_of_any_size(spark):
    """One group holds most rows and spans several sorted blocks; one is null, some have a single row."""
    rng = np.random.default_rng(6)
    rows = [(None if i % 50 == 0 else "hot" if i % 3 else f"g{i % 40}", i, int(v)) for i, v in enumerate(rng.integers(0, 9, 600))]
    df = spark.createDataFrame(rows, "g string, i int, v int").repartition(7)
    got = ordering.add_prefix_sums(df, ["i"], {"run": "v"}, {"all": "run"}, group=["g"]).collect()
    assert len(got) == len(rows)
    for r in got:
        own = [v for g, i, v in rows if g == r.g and i <= r.i]
        assert r.run == sum(own) and r["all"] == sum(v for g, _, v in rows if g == r.g)


def test_groups_have_the_metrics_they_have_alone(spark):
    rng = np.random.default_rng(8)
    rows = [(int(i % 3), int(rng.random() < 0.3), float(np.round(rng.random(), 2))) for i in range(300)] + [(7, 1, 0.25)]
    df = spark.createDataFrame(rows, "part int, label int, score double")
    together = {r.part: r for r in models.model_metrics(df, "label", "score", evaluation.Costs(), group=["part"]).collect()}
    assert set(together) == {0, 1, 2, 7} and together[7].roc_auc is None
    for part, row in together.items():
        alone = models.model_metrics(df.filter(F.col("part") == part), "label", "score", evaluation.Costs()).head()
        assert {c: alone[c] for c in alone.asDict()} == pytest.approx({c: row[c] for c in alone.asDict()})


def test_more_folds_than_rows_of_a_label(spark):
    rows = [(i, i % 2, [float(i % 2) + i / 10]) for i in range(6)]
    df = spark.createDataFrame(rows, "id int, label int, features array<double>")
    folds = models.cross_validate(df, "gaussian", "id", k=5, parallelism=3).orderBy("fold").collect()
    assert [r.fold for r in folds] == [0, 1, 2, 3, 4]
    assert [r.pr_auc is None for r in folds] == [False, False, False, True, True]


@pytest.fixture
def one_class(spark):
    rows = [(START + dt.timedelta(hours=i), i, 1, [float(i % 7), float(i % 3)]) for i in range(40)]
    return spark.createDataFrame(rows, "batch_time timestamp_ntz, id long, label int, features array<double>")


def dense_folder(tmp_path):
    """Events of which every hour holds an emergency, as any long enough log has them."""
    kinds = ["error", "click", "purchase", "signup", "view"]
    rows = [(START + dt.timedelta(hours=h, minutes=7 * k), h, kind, 150.0 + h % 7 + k) for h in range(40) for k, kind in enumerate(kinds)]
    names = ("ts", "user_id", "event_type", "value")
    table = pa.table({"event_id": list(range(len(rows))), **dict(zip(names, zip(*rows)))})
    pq.write_table(table.set_column(1, "ts", table["ts"].cast(pa.timestamp("us"))), tmp_path / "events.parquet")
    return str(tmp_path)


def test_a_model_of_one_class_gives_no_probability(spark, one_class, tmp_path):
    scored = models.with_probability(models.fit("gaussian", one_class), one_class)
    assert scored.count() == 40 and scored.filter("probability IS NOT NULL").count() == 0
    assert entry.queries()["folder_scores"](spark, dense_folder(tmp_path)).count() == 0


def test_folds_of_one_class_have_no_metrics(spark, one_class, tmp_path):
    folds = models.cross_validate(one_class, "gaussian", "id", k=3).collect()
    assert [r.fold for r in folds] == [0, 1, 2]
    assert all(v is None for r in folds for c, v in r.asDict().items() if c != "fold")
    assert entry.queries()["gaussian_cross_validation"](spark, dense_folder(tmp_path)).count() == 0


def test_one_class_needs_no_synthetic_rows(spark, one_class, tmp_path):
    new = sampling.smote(one_class, "id", "label")
    assert new.columns == ["new_id", "base_key", "neighbour_row", "label", "features"] and new.count() == 0
    with pytest.raises(ValueError):
        sampling.smote(one_class.withColumn("label", F.col("id") % 3), "id", "label")
    assert entry.queries()["smote"](spark, dense_folder(tmp_path)).count() == 0


def test_preparing_one_class_keeps_every_row(spark, tmp_path):
    """There is no minority to lift, and no row may go for a ratio."""
    rows = entry.queries()["prepared_training_rows"](spark, dense_folder(tmp_path)).collect()
    assert {(r.part, r.label, r.n, r.width, r.named) for r in rows} == {("train", 1, 32, 30, 30), ("validation", 1, 8, 30, 30)}


def test_a_minority_above_the_ratio_gets_no_rows_and_loses_none(spark, tmp_path):
    """Emergencies in 16 of 40 hours: two thirds of the other class, more than either job asks for."""
    folder = dense_folder(tmp_path)
    calm = pq.read_table(f"{folder}/events.parquet").to_pandas()
    calm.loc[(calm["event_type"] == "error") & (calm["user_id"] % 5 > 1), "value"] = 1.0
    calm.to_parquet(f"{folder}/events.parquet", coerce_timestamps="us")
    rows = entry.queries()["prepared_training_rows"](spark, folder).collect()
    assert {(r.part, r.label, r.n) for r in rows} == {("train", 0, 18), ("train", 1, 14), ("validation", 0, 6), ("validation", 1, 2)}
    assert entry.queries()["smote"](spark, folder).count() == 0


def test_a_run_on_one_class_is_saved_and_scores_nothing(spark, tmp_path):
    assert entry.queries()["saved_pipeline_scores"](spark, dense_folder(tmp_path)).count() == 0


def test_comparison_on_one_class(spark, one_class, tmp_path):
    found = models.compare(one_class, one_class, ["gaussian", "none"]).collect()
    assert [(r.model, r.error is None, r.f1) for r in found] == [("gaussian", True, None), ("none", False, None)]
    rows = entry.queries()["gaussian_comparison"](spark, dense_folder(tmp_path)).collect()
    assert [(r.position, r.model, r.error) for r in rows] == [(2, "no_such_model", "failed")]
