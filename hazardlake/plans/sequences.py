"""Jobs over rows in time order, and time features."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazardlake.functions import arrays, scalars
from hazardlake.functions.scalars import CALENDAR_NAMES, SEASON_MONTHS
from hazardlake.operators import engineer, sequence
from hazardlake.sources.tables import read_table

from . import roles
from .registry import job
from .roles import FEATURES, cells_sql, r, rounded, telemetry_columns, with_parts

TWO_PI = "CAST(6.283185307179586 AS DOUBLE)"


def _cycle_sql(value: str, period: int, name: str) -> list[str]:
    angle = f"({value}) * {TWO_PI} / CAST({period} AS DOUBLE)"
    return [r(f"sin({angle})", f"{name}_sin"), r(f"cos({angle})", f"{name}_cos")]


def calendar_sql(ts: str) -> list[str]:
    cells = [
        *_cycle_sql(f"hour({ts})", 24, "hour"),
        *_cycle_sql(f"dayofweek({ts})", 7, "dayofweek"),
        *_cycle_sql(f"month({ts})", 12, "month"),
    ]
    return cells + [
        f"CAST(CAST(month({ts}) IN {months} AS INTEGER) AS DOUBLE) AS season_{season}"
        for season, months in SEASON_MONTHS.items()
    ]


def _unfold(df, array, names, *keys):
    return df.select(*keys, *[rounded(F.col(array)[i]).alias(n) for i, n in enumerate(names)])


def _lag_sql(lags) -> list[str]:
    return [
        r(f"coalesce(lag(v_{i}, {lag}) OVER (ORDER BY batch_time), 0)", f"feat{i}_lag{lag}")
        for lag in lags
        for i in range(len(FEATURES))
    ]


def _rolling_sql(windows, stats, gap=1) -> list[str]:
    cells = []
    for w in windows:
        frame = f"(ORDER BY batch_time ROWS BETWEEN {w + gap} PRECEDING AND {1 + gap} PRECEDING)"
        for stat in stats:
            for i in range(len(FEATURES)):
                v = f"CAST(v_{i} AS DOUBLE)"
                if stat in ("mean", "std"):
                    fn = "avg" if stat == "mean" else "stddev_pop"
                    value = f"CASE WHEN count({v}) OVER {frame} = {w} THEN {fn}({v}) OVER {frame} END"
                else:
                    value = f"CASE WHEN row_number() OVER (ORDER BY batch_time) > {w} THEN {stat}({v}) OVER {frame} END"
                cells.append(r(f"coalesce({value}, 0)", f"feat{i}_roll{w}_{stat}"))
    return cells


@job(with_parts("tel", f"SELECT batch_time, {', '.join(_lag_sql((1, 3, 6)))} FROM tel"))
def lag_features(spark, folder):
    table = sequence.lag_features(roles.telemetry(spark, folder), ["batch_time"], (1, 3, 6), key=["batch_time"])
    return _unfold(table, "lags", sequence.lag_names((1, 3, 6), len(FEATURES)), "batch_time")


_STATS = ("mean", "std", "min", "max")


@job(with_parts("tel", f"SELECT batch_time, {', '.join(_rolling_sql((3, 6, 12), _STATS))} FROM tel"))
def rolling_features(spark, folder):
    table = sequence.rolling_features(roles.telemetry(spark, folder), ["batch_time"], (3, 6, 12), stats=_STATS, key=["batch_time"])
    return _unfold(table, "rolls", sequence.rolling_names((3, 6, 12), len(FEATURES), _STATS), "batch_time")


@job(with_parts("telminute", f"SELECT batch_time, {', '.join(_rolling_sql((4,), ('mean', 'max'), 0))} FROM telminute"))
def rolling_by_minute(spark, folder):
    table = roles.telemetry_by_minute(spark, folder)
    table = sequence.rolling_features(table, ["batch_time"], (4,), stats=("mean", "max"), gap=0, key=["batch_time"])
    return _unfold(table, "rolls", sequence.rolling_names((4,), len(FEATURES), ("mean", "max")), "batch_time")


# A minute counts as down when neither clicks nor purchases came in; all four cells are filled.
_PAIR = "pair AS (SELECT batch_time, v_0, v_1, v_2, v_3, v_0 IS NULL AND v_1 IS NULL AS down FROM telminute)"
_CHECKED = (0, 1)


def _between(i: int) -> str:
    before, after = f"lag(v_{i}) OVER (ORDER BY batch_time)", f"lead(v_{i}) OVER (ORDER BY batch_time)"
    first = "row_number() OVER (ORDER BY batch_time) = 1"
    last = "row_number() OVER (ORDER BY batch_time DESC) = 1"
    mean = f"(CAST({before} AS DOUBLE) + CAST({after} AS DOUBLE)) / 2.0"
    value = f"CASE WHEN NOT down THEN v_{i} WHEN {first} THEN {after} WHEN {last} THEN {before} ELSE CAST({mean} AS FLOAT) END"
    return r(value, f"v_{i}")


@job(with_parts("telminute", f", {_PAIR} SELECT batch_time, {', '.join(map(_between, range(len(FEATURES))))}, down AS was_missing FROM pair"))
def interpolated_rows(spark, folder):
    table = roles.telemetry_by_minute(spark, folder)
    table = sequence.interpolate_missing_rows(table, ["batch_time"], check=_CHECKED, flag="was_missing")
    return _unfold(table, "features", FEATURES, "batch_time", "was_missing")


@job(with_parts("telminute", f""", {_PAIR}, n AS (SELECT batch_time, down, row_number() OVER (ORDER BY batch_time)
- row_number() OVER (PARTITION BY down ORDER BY batch_time) AS run FROM pair)
SELECT min(batch_time) AS period_start, max(batch_time) AS period_end, count(*) AS n_rows FROM n WHERE down GROUP BY run"""))
def downtime_periods(spark, folder):
    checked = F.transform(F.array(*[F.lit(i) for i in _CHECKED]), lambda i: F.get("features", i))
    table = roles.telemetry_by_minute(spark, folder).withColumn("features", checked)
    return sequence.downtime_periods(table, ["batch_time"], "batch_time")


@job("""SELECT event_id, row_number() OVER (ORDER BY ts, event_id) <= floor((SELECT count(*) FROM events) * CAST(0.8 AS DOUBLE)) AS is_train FROM events""")
def chronological_split(spark, folder):
    events = read_table(spark, folder, "events")
    return sequence.chronological_split(events, ["ts", "event_id"], 0.2).select("event_id", "is_train")


@job("""SELECT l_orderkey, l_partkey, l_shipdate FROM (SELECT *, row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS i FROM lineitem) WHERE i % 100 = 0""")
def every_nth_row(spark, folder):
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    items = read_table(spark, folder, "lineitem").select(*order)
    return sequence.every_nth_row(items, order, 100).select("l_orderkey", "l_partkey", "l_shipdate")


@job("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 5000")
def first_rows(spark, folder):
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return sequence.first_rows(orders, ["o_orderdate", "o_orderkey"], 5000)


# -- time ---------------------------------------------------------------------------


@job(f"SELECT event_id, {', '.join(calendar_sql('ts'))} FROM events")
def calendar_features(spark, folder):
    events = read_table(spark, folder, "events").select("event_id", *scalars.calendar_columns("ts"))
    return events.select("event_id", *[rounded(c).alias(c) for c in CALENDAR_NAMES])


@job("""SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS spaced, strftime(ts, '%Y-%m-%d %H:%M:%S') AS with_t,
CAST(NULL AS VARCHAR) AS unreadable FROM events""")
def time_text(spark, folder):
    text = F.col("ts").cast("string")
    return read_table(spark, folder, "events").select(
        "event_id",
        scalars.time_text(text).alias("spaced"),
        scalars.time_text(F.replace(text, F.lit(" "), F.lit("T"))).alias("with_t"),
        scalars.time_text(F.col("event_type")).alias("unreadable"),
    )


@job("""SELECT event_id, date_trunc('minute', ts) AS minute, ts + INTERVAL 3 HOUR AS later, CAST(year(ts) AS INTEGER) AS year,
CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day FROM events""")
def time_parts(spark, folder):
    ts = F.col("ts").cast("timestamp_ntz")
    return read_table(spark, folder, "events").select(
        "event_id",
        scalars.floor_time("minute", ts).alias("minute"),
        scalars.shift_hours(ts, 3).alias("later"),
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
        F.dayofmonth(ts).alias("day"),
    )


@job(with_parts("items", f"""SELECT l_linenumber, count(*) AS n, count(*) FILTER (WHERE isinf(f1)) AS at_limit,
{r('avg(CASE WHEN f1 IS NULL THEN 0 WHEN NOT isinf(f1) THEN CAST(f1 AS DOUBLE) END)', 'mean1')},
{r('min(least(coalesce(f0, 0), coalesce(f2, 0)))', 'low')}, {r('sum(coalesce(CAST(f0 AS DOUBLE), 0) + coalesce(CAST(f2 AS DOUBLE), 0))', 'total')}
FROM items GROUP BY 1"""))
def finite_values(spark, folder):
    f = [F.col("features")[i].cast("double") for i in range(3)]
    limited = scalars.finite_or_limit(f[1])
    row_low = F.least(F.coalesce(f[0], F.lit(0.0)), F.coalesce(f[2], F.lit(0.0)))
    row_sum = F.aggregate(arrays.zero_filled(F.array(f[0], f[2])), F.lit(0.0), lambda a, x: a + x.cast("double"))
    table = roles.measured_items(spark, folder).select(
        "l_linenumber", limited.alias("x"), scalars.is_infinite(f[1]).alias("inf"), row_low.alias("lo"), row_sum.alias("s")
    )
    return table.groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("inf") & (F.col("x") == scalars.FLOAT32_MAX)).alias("at_limit"),
        rounded(F.avg(F.when(~F.col("inf"), F.col("x")))).alias("mean1"),
        rounded(F.min("lo")).alias("low"),
        rounded(F.sum("s")).alias("total"),
    )


# -- engineered features -----------------------------------------------------------------


_SPEC = engineer.Features(lags=(1, 3), windows=(3, 6))


@job(with_parts("tel", f"""SELECT batch_time, {', '.join([cells_sql(), *calendar_sql('batch_time'), *_lag_sql((1, 3)), *_rolling_sql((3, 6), ('mean', 'std'))])} FROM
(SELECT batch_time, {', '.join(f'coalesce({n}, 0) AS {n}' for n in FEATURES)} FROM tel)"""))
def engineered_features(spark, folder):
    table = roles.telemetry(spark, folder).withColumn("features", arrays.zero_filled("features"))
    table, names = engineer.engineer(table, _SPEC, ["batch_time"], key=["batch_time"])
    return _unfold(table, "engineered", names, "batch_time")


@job(with_parts("tel", f"SELECT batch_time, {cells_sql()} FROM tel"))
def layout_round_trip(spark, folder):
    long = arrays.to_long(roles.telemetry(spark, folder), keys=["batch_time"])
    return telemetry_columns(arrays.from_long(long, ["batch_time"]))
