import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazardlake.operators import ordering, sequence

HOUR = dt.timedelta(hours=1)
START = dt.datetime(2023, 1, 1)


def series(spark, rows, kind="float"):
    """Rows of cells, one hour apart, spread over several partitions."""
    data = [(START + i * HOUR, r and [None if c is None else float(c) for c in r]) for i, r in enumerate(rows)]
    random.Random(3).shuffle(data)
    return spark.createDataFrame(data, f"batch_time timestamp_ntz, features array<{kind}>").repartition(3)


def cells(df, name):
    return [r[name] for r in df.orderBy("batch_time").collect()]


def close(got, expected):
    assert len(got) == len(expected)
    for g, e in zip(got, expected):
        assert g == pytest.approx(e, abs=1e-4) if e is not None else g is None


# -- global order -----------------------------------------------------------


@pytest.mark.parametrize("partitions", [1, 8])
def test_row_index_matches_sorted_order(spark, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = [(0 if i % 3 else i % 7, i) for i in range(500)]
        df = spark.createDataFrame(rows, "k int, id int").repartition(5)
        got = [(r.k, r.id) for r in ordering.add_row_index(df, ["k", "id"]).orderBy("row_idx").collect()]
        assert got == sorted(rows)
        idx = sorted(r.row_idx for r in ordering.add_row_index(df, ["k", "id"]).collect())
        assert idx == list(range(500))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_group_index_with_one_dominant_group(spark):
    rows = [("a" if i % 10 else None, i) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, id int")
    got = ordering.add_group_index(df, ["g"], [F.desc("id")]).collect()
    for g in ("a", None):
        ranked = [r.id for r in sorted((r for r in got if r.g == g), key=lambda r: r.group_idx)]
        assert ranked == sorted((i for k, i in rows if k == g), reverse=True)
        assert sorted(r.group_idx for r in got if r.g == g) == list(range(len(ranked)))


def test_prefix_sums(spark):
    df = spark.createDataFrame([(i, i * 2) for i in range(100)], "id int, v int").repartition(4)
    got = {r.id: r.run for r in ordering.add_prefix_sums(df, ["id"], {"run": "v"}).collect()}
    assert got == {i: i * (i + 1) for i in range(100)}


# -- rolling ----------------------------------------------------------------

GOLDEN = {
    (1, "mean"): [0, 0, 3, 1, 4, 1, 5, 9],
    (1, "std"): [0] * 8,
    (1, "min"): [0, 0, 3, 1, 4, 1, 5, 9],
    (1, "max"): [0, 0, 3, 1, 4, 1, 5, 9],
    (3, "mean"): [0, 0, 0, 0, 2.6667, 2.0, 3.3333, 5.0],
    (3, "std"): [0, 0, 0, 0, 1.2472, 1.4142, 1.6997, 3.2660],
    (3, "min"): [0, 0, 0, 1, 1, 1, 1, 1],
    (3, "max"): [0, 0, 0, 3, 4, 4, 5, 9],
}


@pytest.mark.parametrize("layout", ["blocks", "scalar", "nested"])
@pytest.mark.parametrize("bucket_rows", [4, 8192])
def test_rolling_golden(spark, layout, bucket_rows):
    df = series(spark, [[x] for x in (3, 1, 4, 1, 5, 9, 2, 6)])
    out = sequence.rolling_features(
        df, ["batch_time"], (1, 3), 0, ("mean", "std", "min", "max"), layout=layout, bucket_rows=bucket_rows
    )
    got = cells(out, "rolls")
    for i, (w, stat) in enumerate((w, s) for w in (1, 3) for s in ("mean", "std", "min", "max")):
        close([r[i] for r in got], GOLDEN[w, stat])


@pytest.mark.parametrize("layout", ["blocks", "scalar", "nested"])
def test_rolling_missing_cells(spark, layout):
    df = series(spark, [[1, 5], [None, 6], [3, 7], [4, None], [5, 9], [6, 10]])
    out = cells(sequence.rolling_features(df, ["batch_time"], (2,), 0, ("mean", "min"), layout=layout), "rolls")
    close([r[0] for r in out], [0, 0, 0, 0, 0, 3.5])
    close([r[2] for r in out], [0, 0, 1, 1, 3, 3])
    close([r[1] for r in out], [0, 0, 0, 5.5, 6.5, 0])


def brute_trailing(x, w, gap, stats):
    """Every window by itself: (statistic, row, feature)."""
    out = np.zeros((len(stats), *x.shape))
    for i, f in np.ndindex(x.shape):
        frame = x[max(0, i - gap - w) : max(0, i - gap), f]
        there = frame[~np.isnan(frame)]
        for k, stat in enumerate(stats):
            if stat in ("mean", "std") and len(there) == w:
                out[k, i, f] = getattr(np, stat)(there)
            elif stat in ("min", "max") and i >= w and len(there):
                out[k, i, f] = getattr(np, stat)(there)
    return out


@pytest.mark.parametrize("gap, bucket_rows", [(0, 13), (1, 1), (4, 8192)])
def test_rolling_equals_every_window_by_itself(spark, gap, bucket_rows):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(90, 3)) + np.where(np.arange(90) > 40, 1e6, 0)[:, None]  # a step that squares would drown in
    x[rng.random(x.shape) < 0.03] = np.nan
    x[60:72, 2] = 5.0
    windows, stats = (1, 2, 7, 30, 200), ("std", "max", "mean", "min")
    df = series(spark, [[None if np.isnan(v) else float(v) for v in row] for row in x], "double")
    out = cells(sequence.rolling_features(df, ["batch_time"], windows, 0, stats, gap=gap, bucket_rows=bucket_rows), "rolls")
    want = np.concatenate([brute_trailing(x, w, gap, stats) for w in windows]).transpose(1, 0, 2).reshape(90, -1)
    assert np.allclose(np.array(out), want, rtol=1e-9, atol=1e-9)


def test_rolling_rows_of_unequal_width_and_infinite_cells(spark):
    rows = [[1.0, 2.0], [3.0], None, [float("inf"), 4.0], [5.0, 6.0], [7.0, float("-inf")], [8.0, 9.0]]
    df = series(spark, rows, "double")
    for stats in (("mean",), ("min", "max")):
        blocks, nested = (cells(sequence.rolling_features(df, ["batch_time"], (1, 2), 0, stats, gap=0, layout=x), "rolls") for x in ("blocks", "nested"))
        assert blocks == nested


def test_long_windows_take_bounded_memory():
    """Windows of 10 000 rows over 200 features: the results and a few arrays of bounded size, not rows times window."""
    import tracemalloc

    from hazardlake.operators.trailing import CELLS_AT_ONCE, trailing_statistics

    x = np.random.default_rng(1).normal(size=(20_002, 200))
    tracemalloc.start()
    found = trailing_statistics()(x, 70_000, 10_000, ("mean", "std"))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < found.nbytes + 12 * 8 * CELLS_AT_ONCE
    frame = x[20_001 - 9_999 : 20_002]
    assert np.allclose(found[:, -1], [frame.mean(axis=0), frame.std(axis=0)], rtol=1e-9, atol=1e-12)


def test_rolling_shape_and_gap(spark):
    df = series(spark, [[2 * i, 2 * i + 1] for i in range(6)])
    out = cells(sequence.rolling_features(df, ["batch_time"], (3,), 0), "rolls")
    assert len(out) == 6 and all(len(r) == 4 for r in out)
    plain = cells(sequence.rolling_features(df, ["batch_time"], (3,), 0, ("mean",), gap=0), "rolls")
    close([r[0] for r in plain], [0, 0, 0, 2, 4, 6])


def test_later_rows_do_not_change_earlier_features(spark):
    rows = [[float(i * i % 7)] for i in range(12)]
    changed = [r if i != 6 else [99.0] for i, r in enumerate(rows)]
    for fn, last_same in ((sequence.rolling_features, 7), (sequence.lag_features, 6)):
        before = list(cells(fn(series(spark, rows), ["batch_time"]), "rolls" if last_same == 7 else "lags"))
        after = list(cells(fn(series(spark, changed), ["batch_time"]), "rolls" if last_same == 7 else "lags"))
        assert before[: last_same + 1] == after[: last_same + 1]
        assert before != after


# -- lag --------------------------------------------------------------------


@pytest.mark.parametrize("bucket_rows", [2, 8192])
def test_lag(spark, bucket_rows):
    df = series(spark, [[2 * i, 2 * i + 1] for i in range(5)])
    got = cells(sequence.lag_features(df, ["batch_time"], (1, 2), 0, fill=None, bucket_rows=bucket_rows), "lags")
    assert got[0] == [None] * 4
    assert got[1] == [0.0, 1.0, None, None]
    assert got[4] == [6.0, 7.0, 4.0, 5.0]
    assert cells(sequence.lag_features(df, ["batch_time"], (9,), 1), "lags") == [[0.0]] * 5
    with pytest.raises(ValueError):
        sequence.lag_features(df, ["batch_time"], (0,))


def test_key_path_equals_whole_rows(spark):
    df = series(spark, [[i, i * i % 7, -i] for i in range(20)]).withColumn("other", F.lit("x"))
    for fn, out in ((sequence.lag_features, "lags"), (sequence.rolling_features, "rolls")):
        whole = fn(df, ["batch_time"], (1, 3), 2)
        keyed = fn(df, ["batch_time"], (1, 3), 2, key=["batch_time"], bucket_rows=6)
        assert whole.columns == keyed.columns
        assert whole.orderBy("batch_time").collect() == keyed.orderBy("batch_time").collect()


def test_names():
    assert sequence.lag_names((1, 3), 2) == ["feat0_lag1", "feat1_lag1", "feat0_lag3", "feat1_lag3"]
    assert sequence.rolling_names((3,), 2) == ["feat0_roll3_mean", "feat1_roll3_mean", "feat0_roll3_std", "feat1_roll3_std"]


# -- gap filling ------------------------------------------------------------

N = None


@pytest.mark.parametrize(
    "rows, expected",
    [
        ([[1, 2], [N, N], [5, 6]], [[1, 2], [3, 4], [5, 6]]),
        ([[1, 2], [N, N], [N, N], [5, 6]], [[1, 2], [N, N], [N, N], [5, 6]]),
        ([[N, N], [3, 4]], [[3, 4], [3, 4]]),
        ([[3, 4], [N, N]], [[3, 4], [3, 4]]),
        ([[N, N]], [[0, 0]]),
        ([[1, N], [N, N], [5, 6]], [[1, N], [3, N], [5, 6]]),
        ([[1, N], [2, 3]], [[1, N], [2, 3]]),
    ],
)
@pytest.mark.parametrize("bucket_rows", [1, 8192])
def test_interpolation(spark, rows, expected, bucket_rows):
    out = sequence.interpolate_missing_rows(series(spark, rows), ["batch_time"], bucket_rows=bucket_rows)
    assert cells(out, "features") == expected


def test_downtime_periods(spark):
    pattern = [1, 0, 0, 1, 1, 0, 1, 0, 0, 0]
    df = series(spark, [[1.0, N] if up else [N, N] for up in pattern])
    got = [
        ((r.period_start - START) // HOUR, (r.period_end - START) // HOUR, r.n_rows)
        for r in sequence.downtime_periods(df, ["batch_time"], "batch_time").orderBy("period_start").collect()
    ]
    assert got == [(1, 2, 2), (5, 5, 1), (7, 9, 3)]


# -- split ------------------------------------------------------------------


@pytest.mark.parametrize("n, test_size, train", [(100, 0.2, 80), (10, 0.2, 8), (6, 0.5, 3), (5, 0.4, 3), (10, 0.9, 0)])
def test_chronological_split(spark, n, test_size, train):
    out = sequence.chronological_split(series(spark, [[i] for i in range(n)]), ["batch_time"], test_size)
    rows = out.collect()
    early = [r.batch_time for r in rows if r.is_train]
    late = [r.batch_time for r in rows if not r.is_train]
    assert (len(early), len(late)) == (train, n - train)
    assert not early or max(early) <= min(late)


def test_first_and_nth_rows(spark):
    df = series(spark, [[i] for i in range(25)])
    assert [r[0] for r in cells(sequence.every_nth_row(df, ["batch_time"], 10), "features")] == [0, 10, 20]
    assert [r[0] for r in cells(sequence.first_rows(df, ["batch_time"], 4), "features")] == [0, 1, 2, 3]
