"""The roles of the given tables, as DataFrames and as SQL for the oracle.

``events`` is the event log; its non-error events, summed per hour and type,
are the telemetry. ``embeddings`` is wide telemetry, ``lineitem`` gives volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlake.functions.arrays import zero_filled
from hazardlake.functions.scalars import floor_time, linear_score, sigmoid
from hazardlake.sources.tables import read_table

# Event types in feature order, and the value that makes an error an emergency.
FEATURE_EVENTS = ("click", "purchase", "signup", "view")
EMERGENCY_VALUE = 100
FEATURES = [f"v_{i}" for i in range(len(FEATURE_EVENTS))]

# Weights of the linear scores.
TELEMETRY_WEIGHTS = (0.004, -0.003, 0.002, 0.001)
TELEMETRY_BIAS = -0.9
LINEITEM_WEIGHTS = (0.02, -6.0, 9.0, 0.000004)
LINEITEM_BIAS = -1.2


def rounded(c: Column | str, places: int = 6) -> Column:
    """Rounded double without a negative zero, as both engines print it."""
    value = F.col(c) if isinstance(c, str) else c
    return F.round(value.cast("double"), places) + F.lit(0.0)


def event_log(spark: SparkSession, folder: str) -> DataFrame:
    flag = (F.col("event_type") == "error") & (F.col("value") >= EMERGENCY_VALUE)
    return read_table(spark, folder, "events").select(
        "event_id",
        F.col("ts").cast("timestamp_ntz").alias("date"),
        floor_time("hour", "ts").alias("batch_time"),
        F.col("user_id").alias("r_id"),
        flag.alias("is_emergency"),
    )


def _pivot(spark: SparkSession, folder: str, *keys: Column) -> DataFrame:
    cells = [
        F.round(F.sum(F.when(F.col("event_type") == t, F.col("value"))), 4).cast("float") for t in FEATURE_EVENTS
    ]
    events = read_table(spark, folder, "events").filter(F.col("event_type") != "error")
    return events.groupBy(*keys).agg(F.array(*cells).alias("features"))


def telemetry(spark: SparkSession, folder: str) -> DataFrame:
    """One row per hour: ``batch_time, features``."""
    return _pivot(spark, folder, floor_time("hour", "ts").alias("batch_time"))


def telemetry_by_minute(spark: SparkSession, folder: str) -> DataFrame:
    return _pivot(spark, folder, floor_time("minute", "ts").alias("batch_time"))


def telemetry_by_user(spark: SparkSession, folder: str) -> DataFrame:
    """One row per hour and user: the hour repeats."""
    return _pivot(spark, folder, floor_time("hour", "ts").alias("batch_time"), F.col("user_id"))


def telemetry_columns(df: DataFrame) -> DataFrame:
    """Array cells as rounded columns v_0..v_3."""
    return df.select(
        *[c for c in df.columns if c != "features"],
        *[rounded(F.col("features")[i]).alias(n) for i, n in enumerate(FEATURES)],
    )


def telemetry_wide(spark: SparkSession, folder: str) -> DataFrame:
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    hours = F.make_dt_interval(hours=F.col("vec_id").cast("int"))
    return read_table(spark, folder, "embeddings").select(
        "vec_id", (start + hours).alias("batch_time"), F.col("embedding").alias("features"), "label"
    )


def scored_telemetry(spark: SparkSession, folder: str) -> DataFrame:
    """Telemetry with missing cells as 0 and the probability of the fixed weights."""
    table = telemetry(spark, folder).withColumn("features", zero_filled("features"))
    return table.withColumn("probability", sigmoid(linear_score("features", TELEMETRY_WEIGHTS, TELEMETRY_BIAS)))


def measured_items(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as measurements with missing and infinite cells."""
    price = F.col("l_extendedprice")
    cells = [
        F.when(F.col("l_linenumber") != 3, F.col("l_quantity")),
        F.when(F.col("l_discount") == 0, F.lit(float("inf"))).when(F.col("l_tax") != 0, F.round(price, 2)),
        F.when(((F.col("l_tax") == 0) | (F.col("l_linenumber") > 4)) & (F.col("l_linenumber") != 3), F.col("l_discount")),
    ]
    return read_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.array(*[c.cast("float") for c in cells]).alias("features")
    )


def scored_items(spark: SparkSession, folder: str) -> DataFrame:
    """``label, score, prediction`` for every line item."""
    cells = F.array("l_quantity", "l_discount", "l_tax", "l_extendedprice")
    score = F.round(sigmoid(linear_score(cells, LINEITEM_WEIGHTS, LINEITEM_BIAS)), 6)
    return (
        read_table(spark, folder, "lineitem")
        .select((F.col("l_returnflag") == "R").cast("int").alias("label"), score.alias("score"))
        .withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
    )


def labelled_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with an uneven label: one status against the rest."""
    return read_table(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"),
        "o_totalprice",
        (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("label"),
    )


def repairs(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("r_id"), F.col("c_nationkey").cast("bigint").alias("b_id"), "c_acctbal"
    )


# -- the same roles for the oracle ---------------------------------------------


def _sum(kind: str) -> str:
    return f"CAST(round(sum(value) FILTER (WHERE event_type = '{kind}'), 4) AS FLOAT)"


_CELLS = ", ".join(f"{_sum(kind)} AS {name}" for kind, name in zip(FEATURE_EVENTS, FEATURES, strict=True))

PARTS = {
    "elog": f"""elog AS (SELECT event_id, CAST(ts AS TIMESTAMP) AS date, date_trunc('hour', ts) AS batch_time,
        user_id AS r_id, (event_type = 'error' AND value >= {EMERGENCY_VALUE}) AS is_emergency FROM events)""",
    "tel": f"""tel AS (SELECT date_trunc('hour', ts) AS batch_time, {_CELLS}
        FROM events WHERE event_type <> 'error' GROUP BY 1)""",
    "teluser": f"""teluser AS (SELECT date_trunc('hour', ts) AS batch_time, user_id, {_CELLS}
        FROM events WHERE event_type <> 'error' GROUP BY 1, 2)""",
    "telminute": f"""telminute AS (SELECT date_trunc('minute', ts) AS batch_time, {_CELLS}
        FROM events WHERE event_type <> 'error' GROUP BY 1)""",
    "items": """items AS (SELECT l_orderkey, l_linenumber,
        CAST(CASE WHEN l_linenumber <> 3 THEN l_quantity END AS FLOAT) AS f0,
        CAST(CASE WHEN l_discount = 0 THEN CAST('infinity' AS DOUBLE)
                  WHEN l_tax <> 0 THEN round(l_extendedprice, 2) END AS FLOAT) AS f1,
        CAST(CASE WHEN (l_tax = 0 OR l_linenumber > 4) AND l_linenumber <> 3 THEN l_discount END AS FLOAT) AS f2 FROM lineitem)""",
    "scored": f"""scored AS (SELECT label, score, CAST(score >= 0.5 AS INTEGER) AS prediction FROM (
        SELECT CAST(l_returnflag = 'R' AS INTEGER) AS label,
        round(1.0 / (1.0 + exp(-(CAST({LINEITEM_BIAS} AS DOUBLE) + l_quantity * CAST({LINEITEM_WEIGHTS[0]} AS DOUBLE)
          + l_discount * CAST({LINEITEM_WEIGHTS[1]} AS DOUBLE) + l_tax * CAST({LINEITEM_WEIGHTS[2]} AS DOUBLE)
          + l_extendedprice * CAST({LINEITEM_WEIGHTS[3]} AS DOUBLE)))), 6) AS score FROM lineitem))""",
    "curve": """per AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
          FROM scored GROUP BY score),
        curve AS (SELECT score, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
          sum(pos) OVER () AS n_pos, sum(neg) OVER () AS n_neg FROM per WINDOW w AS (ORDER BY score DESC))""",
    "ord": """ord AS (SELECT o_orderkey, o_orderdate, o_totalprice,
        CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS label FROM orders)""",
    "rep": "rep AS (SELECT c_custkey AS r_id, CAST(c_nationkey AS BIGINT) AS b_id, c_acctbal FROM customer)",
}


def with_parts(names: str, body: str) -> str:
    """SQL that starts with the named roles; ``body`` may add more, after a comma."""
    return "WITH " + ",\n".join(PARTS[n] for n in names.split()) + "\n" + body


def draw_sql(seed: int | str, key: str) -> str:
    """The hash draw of a row, in SQL."""
    return f"(CAST('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8) AS UBIGINT) / 4294967296.0)"


def telemetry_score_sql(prefix: str = "") -> str:
    """Probability of a telemetry row in SQL, added in the same order as the array expression."""
    terms = "".join(
        f" + CAST(coalesce({prefix}{n}, 0) AS DOUBLE) * CAST({w} AS DOUBLE)"
        for n, w in zip(FEATURES, TELEMETRY_WEIGHTS, strict=True)
    )
    return f"(1.0 / (1.0 + exp(-(CAST({TELEMETRY_BIAS} AS DOUBLE){terms}))))"


R = "round(CAST({0} AS DOUBLE), {2}) + 0.0 AS {1}"


def r(expr: str, name: str, places: int = 6) -> str:
    return R.format(expr, name, places)


def cells_sql(prefix: str = "") -> str:
    return ", ".join(r(f"{prefix}{n}", n) for n in FEATURES)
