"""Sources, casts, cleaning, validation and roll-ups on small inputs."""

import datetime as dt
import json
import math

import pytest
from pyspark.sql import functions as F

from hazardlake.functions import arrays, scalars
from hazardlake.operators import cleaning, joins, partitions, rollup, scoring, validation
from hazardlake.operators.validation import Findings, Rules
from hazardlake.sources import artifacts, delimited, tables

N = None
NAN, INF = float("nan"), float("inf")


def matrix(spark, rows, dtype="float"):
    data = [(i, [None if c is None else float(c) for c in r]) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, f"id int, features array<{dtype}>").repartition(2)


def cells(df, name="features"):
    return [list(r[name]) for r in df.orderBy("id").collect()]


def log(spark, rows):
    return spark.createDataFrame(rows, "batch_time string, is_emergency int")


# -- sources ------------------------------------------------------------------


@pytest.fixture
def files(tmp_path):
    times = [f"2023-01-01 {h:02d}:00:00" for h in (0, 3, 6, 9, 12)]
    events = "date,is_emergency\n" + "".join(f"{t},{f}\n" for t, f in zip(times, (0, 0, 1, 0, 1)))
    (tmp_path / "log.csv").write_text(events)
    header = ";batch_time;" + ";".join(f"v_{i}" for i in range(5))
    lines = [f"x;{t};" + ";".join(str(float(r + i)) for i in range(5)) for r, t in enumerate(times)]
    (tmp_path / "telemetry.csv").write_text("\n".join([header, *lines]) + "\n")
    return tmp_path


def test_merge_from_text(spark, files):
    events = delimited.read_event_log(spark, str(files / "log.csv"))
    raw = delimited.read_telemetry(spark, str(files / "telemetry.csv"))
    names = arrays.feature_names(raw.columns)
    assert names == [f"v_{i}" for i in range(5)]
    table = joins.training_table(arrays.to_array(raw, names), events, ["batch_time"]).orderBy("batch_time").collect()
    assert len(table) == 5 and sum(r.is_emergency for r in table) == 2
    assert {r.batch_time.date() for r in table} == {dt.date(2023, 1, 1)}
    assert [list(r.features) for r in table] == [[float(r + i) for i in range(5)] for r in range(5)]


def test_unnamed_columns_and_bad_bytes(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b";batch_time;v_0;Unnamed: 3;column_9\n1;2023-01-01 00:00:00;a\xffb;2;3\n")
    raw = delimited.scan(spark, str(tmp_path / "a.csv"), ";", skip_unnamed=True)
    assert raw.columns == ["batch_time", "v_0"]
    assert raw.head()["v_0"] == "a�b"


def test_missing_inputs(spark, files):
    with pytest.raises(FileNotFoundError):
        delimited.scan(spark, str(files / "none.csv"))
    with pytest.raises(ValueError, match="not found"):
        delimited.read_event_log(spark, str(files / "telemetry.csv"), ";", flag="is_emergency")
    with pytest.raises(ValueError, match="batch_time"):
        delimited.read_telemetry(spark, str(files / "log.csv"), ",")


def test_configured_or_default_time_column(spark, tmp_path):
    (tmp_path / "a.csv").write_text("batch_time,is_emergency\n2023-01-01 00:00:00,true\n")
    row = delimited.read_event_log(spark, str(tmp_path / "a.csv")).head()
    assert row.batch_time == dt.datetime(2023, 1, 1) and row.is_emergency == 1.0


def test_feature_discovery():
    assert arrays.feature_names(["batch_time", "v_2", "v_0", "v_1", "is_emergency"]) == ["v_0", "v_1", "v_2"]
    assert arrays.feature_names(["v_10", "v_2"]) == ["v_2", "v_10"]
    assert arrays.feature_names(["batch_time"]) == []
    with pytest.raises(ValueError):
        arrays.feature_names(["v_x"])


def test_contract(spark, tmp_path):
    names = ["v_100", "v_0", "v_50", "v_25"]
    path = artifacts.save_contract(spark, str(tmp_path / "contract"), names)
    assert artifacts.load_contract(spark, path) == names
    (tmp_path / "plain.json").write_text(json.dumps({"feature_columns": names, "n_features": 4}))
    assert artifacts.load_contract(spark, str(tmp_path / "plain.json")) == names
    assert artifacts.contract_for(spark, str(tmp_path / "none"), 2) == ["v_0", "v_1"]
    with pytest.raises(FileNotFoundError):
        artifacts.load_contract(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError):
        artifacts.contract_for(spark, path, 3)


def test_table_sink_is_reused_only_when_complete(spark, tmp_path):
    path, built = str(tmp_path / "t"), []

    def build():
        built.append(1)
        if len(built) == 1:
            raise RuntimeError("lost")
        return spark.range(3)

    with pytest.raises(RuntimeError):
        tables.reuse_or_write(spark, path, build)
    assert not tables.is_complete(spark, path)
    for _ in range(2):
        assert tables.reuse_or_write(spark, path, build).count() == 3
    assert len(built) == 2
    tables.append_table(spark.range(3), path)
    assert spark.read.parquet(path).count() == 6


def test_prediction_sink_order(spark, tmp_path):
    rows = [(0.1, "b"), (0.9, "a"), (0.5, "c")]
    path = tables.write_predictions(spark.createDataFrame(rows, "probability double, batch_time string"), str(tmp_path / "p"))
    lines = [line for f in sorted((tmp_path / "p").glob("part-*.csv")) for line in f.read_text().splitlines()]
    assert [x for x in lines if x != "probability,batch_time"] == ["0.9,a", "0.5,c", "0.1,b"]
    assert delimited.scan(spark, path).count() == 3


# -- casts ---------------------------------------------------------------------


def test_time_text(spark):
    texts = ["2023-09-26 07:00:00.000000", "2023-09-26 07:00:00", "2023-09-26T07:00:00", "not-a-date"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    got = [r.t for r in df.select("id", scalars.time_text("t").alias("t")).orderBy("id").collect()]
    assert got == ["2023-09-26 07:00:00"] * 3 + [None]


def test_flags(spark):
    for values, kind in ((["true", "0", "1.0", "False", "x"], "string"), ([True, False], "boolean"), ([1, 0, 5], "int")):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id int, f {kind}")
        got = [r.f for r in df.select("id", scalars.flag_to_float("f").alias("f")).orderBy("id").collect()]
        assert got == {"string": [1, 0, 1, 0, None], "boolean": [1, 0], "int": [1, 0, 5]}[kind]


def test_number_casts(spark):
    df = spark.createDataFrame([(1, "1.0"), (2, "abc"), (3, ""), (4, "NaN"), (5, "inf")], "id int, v string")
    zero = [r.v for r in df.select("id", scalars.number_or_zero("v").alias("v")).orderBy("id").collect()]
    assert zero == [1.0, 0.0, 0.0, 0.0, INF]
    kept = [r.v for r in df.select("id", scalars.number_or_null("v", nan_is_null=False).alias("v")).orderBy("id").collect()]
    assert kept[1] is None and math.isnan(kept[3])


def test_contract_projection(spark):
    df = spark.createDataFrame([("t", "1.0", "abc", "")], "batch_time string, v_0 string, v_1 string, v_2 string")
    assert list(scoring.project_contract(df, ["v_2", "v_0", "v_1"]).head().features) == [0.0, 1.0, 0.0]
    with pytest.raises(ValueError, match="missing 1 feature columns"):
        scoring.project_contract(df.drop("v_1"), ["v_0", "v_1"])
    with pytest.raises(ValueError, match="expects 4"):
        scoring.project_contract(df, None, 4)
    assert scoring.pick_time(["x", "date"]) == "date"
    assert scoring.pick_time(["when", "date", "batch_time"], "when") == "batch_time"
    assert scoring.pick_time(["x"]) is None


def test_calendar_features(spark):
    df = spark.createDataFrame([(dt.datetime(2023, 1, 1),), (dt.datetime(2023, 6, 15, 6),)], "t timestamp_ntz")
    a, b = df.select("t", *scalars.calendar_columns("t")).orderBy("t").drop("t").collect()
    assert len(a) == 10 and tuple(a.asDict()) == scalars.CALENDAR_NAMES
    assert a.dayofweek_sin == 0.0 and a.season_winter == 1.0 and a.season_summer == 0.0
    assert b.dayofweek_sin == pytest.approx(math.sin(2 * math.pi * 4 / 7)) and b.season_summer == 1.0
    assert b.hour_sin == pytest.approx(1.0)


def test_rescaled_record(spark):
    df = spark.createDataFrame([([1.0, 0.1],), ([0.0],)], "v array<double>")
    rows = df.select(scalars.col("v"), arrays.rescaled_record("v", 3).alias("x"), arrays.all_zero("v").alias("z")).collect()
    assert rows[0].x == pytest.approx([1.0, 0.0, -1 / 9]) and not rows[0].z
    assert rows[1].x == pytest.approx([-1 / 9] * 3) and rows[1].z


def test_draws_do_not_depend_on_partitions(spark):
    df = spark.range(50).select("id", scalars.uniform_draw(42, "id").alias("u"))
    a = {r.id: r.u for r in df.collect()}
    b = {r.id: r.u for r in spark.range(50).repartition(7).select("id", scalars.uniform_draw(42, "id").alias("u")).collect()}
    assert a == b and all(0 <= u < 1 for u in a.values()) and len(set(a.values())) == 50


# -- cleaning ------------------------------------------------------------------


def test_row_filters(spark):
    df = matrix(spark, [[0, 0], [0, N], [1, 0], [1, 2]])
    assert [r.id for r in cleaning.drop_zero_rows(df).orderBy("id").collect()] == [1, 2, 3]
    assert [r.id for r in cleaning.drop_zero_rows(df, every=True).orderBy("id").collect()] == [3]


def test_infinite_cells(spark):
    df = matrix(spark, [[1, INF], [-INF, 2], [3, N]])
    counts = {r.feature_idx: r.n_inf for r in cleaning.infinite_counts(df).collect()}
    assert counts == {0: 1, 1: 1}
    assert cells(cleaning.replace_infinite(df)) == [[1, N], [N, 2], [3, N]]


def test_sparse_rows_use_a_strict_limit(spark):
    df = matrix(spark, [[N, N], [1, N], [1, 2]])
    assert [r.id for r in cleaning.drop_sparse_rows(df, 0.5).orderBy("id").collect()] == [1, 2]
    assert cleaning.drop_sparse_rows(df, 1.0).count() == 3


@pytest.mark.parametrize(
    "policy, expected",
    [
        ("fill_zero", [[1, 0, 0], [3, 4, 0], [8, 6, 0]]),
        ("fill_mean", [[1, 5, 0], [3, 4, 0], [8, 6, 0]]),
        ("fill_median", [[1, 5, 0], [3, 4, 0], [8, 6, 0]]),
        ("drop", []),
    ],
)
def test_fill_policies(spark, policy, expected):
    assert cells(cleaning.fill_missing(matrix(spark, [[1, N, N], [3, 4, NAN], [8, 6, N]]), policy)) == expected


def test_unknown_fill_policy(spark):
    with pytest.raises(ValueError):
        cleaning.fill_missing(matrix(spark, [[1]]), "guess")


def test_median_is_exact_on_skewed_cells(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    columns = [rng.normal(size=3001), np.where(rng.random(3001) < 0.4, 7.0, rng.random(3001) * 20), rng.integers(0, 3, 3001)]
    rows = [[float(np.float32(c[i])) for c in columns] for i in range(3001)]
    for n in (3001, 3000, 2, 1):
        got = {r.feature_idx: r.fill for r in cleaning.feature_medians(matrix(spark, rows[:n])).collect()}
        want = np.median(np.array(rows[:n]), axis=0)
        assert [got[i] for i in range(3)] == pytest.approx(list(want), abs=0)


# -- validation -------------------------------------------------------------------


def checked(log, rules):
    findings = Findings()
    return validation.check_log(log, rules, findings), findings


def test_duplicate_keys(spark):
    rules = Rules(order_by=["is_emergency"])
    left, findings = checked(log(spark, [("a", 0), ("b", 1)]), rules)
    assert left.count() == 2 and not findings.failures
    twice = log(spark, [("a", 0), ("a", 1)])
    assert checked(twice, rules)[1].failures
    for action, flag in (("drop", 0), ("aggregate", 1)):
        left, findings = checked(twice, rules.but(repeated_keys=action))
        assert [r.is_emergency for r in left.collect()] == [flag]
        assert findings.count("repeated_keys") == 2 and not findings.failures
    assert checked(twice, rules.but(repeated_keys="guess"))[1].failures
    assert checked(log(spark, [("a", 0)]).drop("batch_time"), rules)[1].failures


def test_target_domain(spark):
    rows = log(spark, [("a", 5), ("b", None), ("c", 1)])
    _, findings = checked(rows, Rules())
    assert findings.count("foreign_labels") == 1 and findings.failures
    assert not checked(rows, Rules().but(foreign_labels="ignore"))[1].failures


def test_matrix_policies(spark):
    filled, findings = validation.check_matrix(matrix(spark, [[1, NAN], [3, 4]]))
    assert cells(filled) == [[1, 4], [3, 4]] and findings.count("missing_cells") == 1
    _, findings = validation.check_matrix(matrix(spark, [[1, NAN]]), Rules().but(missing_cells="fail"))
    assert findings.failures
    filled, findings = validation.check_matrix(matrix(spark, [[1, INF]]), Rules().but(missing_cells="fill_zero"))
    assert cells(filled) == [[1, 0]] and findings.count("infinite_cells") == 1
    kept, _ = validation.check_matrix(matrix(spark, [[1, NAN], [2, 3]]), Rules().but(missing_cells="drop"))
    assert kept.count() == 2
    _, findings = validation.check_matrix(matrix(spark, [[1, INF]]), Rules().but(infinite_cells="fail"))
    assert findings.failures
    assert validation.check_matrix(matrix(spark, [[1]]), Rules().but(infinite_cells="guess"))[1].failures


def test_statistics_come_after_row_drops(spark):
    findings = Findings()
    rules = Rules(missing_share=0.6).but(missing_cells="fill_mean")
    out = validation.check_cells(matrix(spark, [[1, N, N], [3, 4, INF], [100, N, N]]), rules, findings)
    assert cells(out) == [[3, 4, 0]]
    assert [findings.count(c) for c in ("infinite_cells", "sparse_rows", "missing_cells")] == [1, 2, 1]


def test_rows_without_cells_are_not_sparse(spark):
    empty = matrix(spark, [[], [N]])
    assert cleaning.drop_sparse_rows(empty).count() == 1
    findings = Findings()
    assert validation.check_cells(empty, Rules(), findings).count() == 1 and findings.count("sparse_rows") == 1


def test_inputs_raise_once_with_all_failures(spark):
    telemetry = matrix(spark, [[1, N], [2, 3]]).withColumn("batch_time", F.lit("a"))
    events = log(spark, [("a", 5), ("a", 1)])
    with pytest.raises(ValueError) as e:
        validation.check_inputs(events, telemetry, Rules().but(missing_cells="fail"))
    assert str(e.value).count("  - ") == 4
    same, _, findings = validation.check_inputs(events, telemetry, None)
    assert same is events and findings.messages("skipped")
    ok = Rules().but(repeated_keys="aggregate", foreign_labels="ignore", missing_cells="fill_zero")
    _, _, findings = validation.check_inputs(events, telemetry, ok)
    assert findings.count("multiplicity") == 1.0 and findings.count("join_rows") == 2.0
    assert {r["check"] for r in findings.to_df(spark).collect()} >= {"repeated_keys", "missing_cells", "rows_per_key"}


def test_join_multiplicity(spark):
    a = log(spark, [("a", 0)] * 3 + [("b", 0)] + [("z", 0)] * 5)
    b = log(spark, [("a", 0)] * 2 + [("b", 0)] * 4)
    row = joins.join_multiplicity(a, b).head()
    assert (row.shared_keys, row.estimated_rows, row.true_join_rows) == (2, 3, 10.0)
    assert (row.max_log_rows, row.max_telemetry_rows, row.multiplicity) == (5, 4, 1.5)


# -- roll-ups and joins --------------------------------------------------------------


def test_context(spark):
    rows = [("2023-01-01 00:00:00", "False"), ("2023-01-01T00:00:00.5", "True"), ("2023-01-01 01:00:00", "False"), ("bad", "True")]
    events = spark.createDataFrame(rows, "t string, f string").select(
        scalars.parse_time("t").alias("batch_time"), F.col("f").alias("is_emergency")
    )
    got = {r.batch_time.hour: (r.n_ops, r.n_emergency_ops, r.ground_truth) for r in rollup.context_rollup(events).collect()}
    assert got == {0: (2, 1, 1), 1: (1, 0, 0)}
    scored = spark.createDataFrame([(0.5, dt.datetime(2023, 1, 1)), (0.4, dt.datetime(2023, 1, 2))], "probability double, batch_time timestamp_ntz")
    joined = {r.batch_time.day: (r.n_ops, r.n_emergency_ops, r.ground_truth) for r in joins.attach_context(scored, events).collect()}
    assert joined == {1: (2, 1, 1), 2: (0, 0, 0)}


def test_keep_first_uses_the_given_order(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), (None, 3, "z")], "k string, o int, v string").repartition(3)
    assert {(r.k, r.v) for r in rollup.keep_first(df, ["k"], ["o"]).collect()} == {("a", "y"), (None, "z")}
    assert {(r.k, r.v) for r in rollup.keep_first(df, ["k"], [F.col("o") * -1]).collect()} == {("a", "x"), (None, "z")}


def test_keep_first_follows_the_files(spark, tmp_path):
    """Rows read from files keep their own order; wide rows are aggregated nowhere, and ties leave one row."""
    rows = [(i % 5 if i % 11 else None, i % 2, f"v{i}", [float(i)] * 50) for i in range(200)]
    spark.createDataFrame(rows, "k int, o int, v string, features array<float>").coalesce(1).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    kept = rollup.keep_first(df.filter("o >= 0"), ["k"])
    want, tied = {}, {}
    for k, o, v, _ in rows:
        want.setdefault(k, v)
        if k not in tied or o < tied[k][0]:
            tied[k] = (o, v)
    assert {(r.k, r.v) for r in kept.collect()} == set(want.items()) and kept.columns == df.columns
    assert {(r.k, (r.o, r.v)) for r in rollup.keep_first(df, ["k"], ["o"]).collect()} == set(tied.items())
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Aggregate" in line and "features" in line]


def test_label_copies_expand(spark):
    at = dt.datetime(2023, 1, 1)
    telemetry = spark.createDataFrame([(at, 1), (at, 2)], "batch_time timestamp_ntz, id int")
    events = spark.createDataFrame([(at, True), (at, False), (at, True)], "date timestamp_ntz, is_emergency boolean")
    assert joins.label_copies(telemetry, events).count() == 4
    assert joins.label_copies(telemetry, events, expand=True).count() == 6


def test_horizon_within_against_brute_force(spark):
    import random

    rng = random.Random(11)
    start = dt.datetime(2023, 1, 1)
    times = [start + dt.timedelta(minutes=rng.randrange(6000)) for _ in range(150)]
    hits = [start + dt.timedelta(minutes=rng.randrange(6000)) for _ in range(25)] + [times[0] + dt.timedelta(hours=3), times[1]]
    telemetry = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "id int, batch_time timestamp_ntz")
    events = spark.createDataFrame([(h, True) for h in hits] + [(start, False)], "date timestamp_ntz, is_emergency boolean")
    got = {r.id: r.label for r in joins.horizon_label(telemetry, events, 3, within=True).collect()}
    span = dt.timedelta(hours=3)
    assert got == {i: int(any(t < h <= t + span for h in hits)) for i, t in enumerate(times)}
    exact = {r.id: r.label for r in joins.horizon_label(telemetry, events, 3).collect()}
    assert exact == {i: int(t + span in hits) for i, t in enumerate(times)}


def test_positional_join_agreement(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "i int, a string")
    b = spark.createDataFrame([(1, "x"), (2, "q")], "j int, b string")
    assert joins.positional_join(a, b, ["i"], ["j"]).count() == 2
    assert [r.a for r in joins.positional_join(a, b, ["i"], ["j"], agree=("a", "b")).collect()] == ["x"]


def test_profile_and_modes(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 1)], "s string, n int")
    got = {r.column_name: (r.n_rows, r.n_null, r.n_distinct) for r in rollup.column_profile(df, ["s", "n"]).collect()}
    assert got == {"s": (3, 0, 2), "n": (3, 1, 1)}
    assert rollup.column_profile(df, ["s"], approximate=True).head().n_distinct == 2
    day = dt.datetime(2023, 1, 1)
    events = spark.createDataFrame([(day, True, 7), (day, True, 3), (day, False, 9)], "date timestamp_ntz, is_emergency boolean, r_id int")
    assert {(r.flag, r.r_id) for r in rollup.daily_mode(events, "date", "r_id").collect()} == {(True, 3), (False, 9)}


def test_positive_weight(spark):
    df = spark.createDataFrame([(1,), (0,), (0,)], "label int")
    weight = lambda **k: rollup.positive_weight(df, "label", **k).head().pos_weight
    assert weight() == 2.0 and weight(mode="cost_matrix") == 100.0 and weight(explicit=0.15) == 0.15
    assert weight(explicit=0.0) == 1.0 and weight(mode="explicit") == 1.0
    assert rollup.positive_weight(df.filter("label = 0"), "label").head().pos_weight == 1.0
    with pytest.raises(ValueError):
        weight(mode="guess")


def test_partition_function(spark):
    df = spark.createDataFrame([(1, "1.5"), (2, "abc"), (3, None)], "id int, v string").repartition(2)
    got = {r.id: r.v for r in partitions.coerce_partitions(df, ["v"]).collect()}
    assert got[1] == 1.5 and (got[2] is None or math.isnan(got[2])) and (got[3] is None or math.isnan(got[3]))


def test_layouts(spark):
    df = matrix(spark, [[1, N], [3, 4]])
    assert cells(arrays.from_long(arrays.to_long(df, keys=["id"]), ["id"])) == [[1, N], [3, 4]]
    wide = arrays.spread(df, "features", ["v_0", "v_1"])
    assert cells(arrays.to_array(wide, ["v_0", "v_1"])) == [[1, N], [3, 4]]


def test_sums_in_file_order(spark, tmp_path):
    """A sum that is a whole number in one order of its terms and not in another."""
    terms = [88243.54340277777, 80535.59201388888, 104283.86458333333]
    first, last = terms[0] + terms[1] + terms[2], terms[0] + terms[2] + terms[1]
    assert math.floor(first) != math.floor(last)
    for name, ordered, want in (("one", terms, first), ("other", [terms[0], terms[2], terms[1]], last)):
        paths = [str(tmp_path / name / str(i)) for i in range(3)]  # a file, and a task, for each term
        for path, x in zip(paths, ordered):
            spark.range(200).select(F.col("id").alias("k"), F.lit(x).alias("x")).coalesce(1).write.parquet(path)
        got = rollup.sums_in_file_order(spark.read.parquet(*paths), ["k"], {"s": F.col("x")}).collect()
        assert len(got) == 200 and {r.s for r in got} == {want}
