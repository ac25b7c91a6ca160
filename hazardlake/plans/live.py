"""Streaming jobs, run over what is there now."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazardlake.session import scratch_path
from hazardlake.sources.tables import read_table
from hazardlake.streaming import live

from . import roles
from .registry import job
from .roles import r, rounded, with_parts

# Weights of the live score.
WEIGHTS = (0.8, -0.4, 1.1, 0.5)
BIAS = -2.0


def _stream(spark, folder, name):
    schema = read_table(spark, folder, name).schema
    return live.follow(spark, folder, schema, f"{name}.parquet")


_X = [f"(CAST({c} AS DOUBLE) - 0.1) / 0.9" for c in ("greatest(l_quantity - 10, 0) / 50.0", "l_discount * 10.0", "l_tax * 10.0", "0.0")]
_Z = f"CAST({BIAS} AS DOUBLE)" + "".join(f" + ({x}) * CAST({w} AS DOUBLE)" for x, w in zip(_X, WEIGHTS, strict=True))


@job(f"""SELECT outcome, l_returnflag, count(*) AS n, {r('avg(p)', 'mean_probability')} FROM (SELECT l_returnflag, 1.0 / (1.0 + exp(-z)) AS p,
CASE WHEN l_discount = 0 AND l_tax = 0 AND l_quantity <= 10 THEN 'no_information' WHEN 1.0 / (1.0 + exp(-z)) >= 0.5 THEN 'alert' ELSE 'no_alert' END AS outcome
FROM (SELECT *, {_Z} AS z FROM lineitem)) GROUP BY 1, 2""")
def live_alerts(spark, folder):
    small = F.greatest(F.col("l_quantity") - 10, F.lit(0))
    values = F.array(small / 50.0, F.col("l_discount") * 10.0, F.col("l_tax") * 10.0)
    records = _stream(spark, folder, "lineitem").select("l_returnflag", values.alias("values"))
    path, progress = scratch_path(spark, "alerts"), scratch_path(spark, "alerts-progress")
    judged = live.judge(records, WEIGHTS, BIAS).select("l_returnflag", "outcome", "probability")
    live.run_to_table(judged, path, progress, once=True).awaitTermination()
    return spark.read.parquet(path).groupBy("outcome", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), rounded(F.avg("probability")).alias("mean_probability")
    )


@job(with_parts("elog", """SELECT batch_time, CAST(max(CAST(is_emergency AS INTEGER)) AS INTEGER) AS is_emergency, count(*) AS n_ops,
CAST(sum(CAST(is_emergency AS INTEGER)) AS BIGINT) AS n_emergency_ops FROM elog GROUP BY 1"""))
def streaming_rollup(spark, folder):
    flag = (F.col("event_type") == "error") & (F.col("value") >= roles.EMERGENCY_VALUE)
    log = _stream(spark, folder, "events").select(F.col("ts").cast("timestamp").alias("ts"), flag.alias("is_emergency"))
    path, progress = scratch_path(spark, "rollup"), scratch_path(spark, "rollup-progress")
    live.run_upserts(live.hourly_rollup(log), path, progress, once=True, keys=["batch_time"], merge_every=8).awaitTermination()
    return live.latest_versions(spark, path, ["batch_time"]).withColumn(
        "batch_time", F.col("batch_time").cast("timestamp_ntz")
    )


@job("SELECT user_id, date_trunc('hour', ts) AS batch_time FROM events GROUP BY 1, 2")
def streaming_first_arrivals(spark, folder):
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    log = _stream(spark, folder, "events").select("user_id", hour.alias("batch_time"))
    path, progress = scratch_path(spark, "arrivals"), scratch_path(spark, "arrivals-progress")
    firsts = live.first_arrivals(log, ["user_id", "batch_time"], "batch_time")
    live.run_to_table(firsts, path, progress, once=True).awaitTermination()
    return spark.read.parquet(path).withColumn("batch_time", F.col("batch_time").cast("timestamp_ntz"))


@job("""SELECT user_id, date_trunc('hour', ts) AS batch_time, arg_min(event_id, (ts, event_id)) AS event_id,
arg_min(event_type, (ts, event_id)) AS event_type, arg_min(value, (ts, event_id)) AS value FROM events GROUP BY 1, 2""")
def streaming_first_rows(spark, folder):
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    log = _stream(spark, folder, "events").select("user_id", hour.alias("batch_time"), "ts", "event_id", "event_type", "value")
    keys = ["user_id", "batch_time"]
    path, progress = scratch_path(spark, "firsts"), scratch_path(spark, "firsts-progress")
    firsts = live.first_in_order(log, keys, "batch_time", ["ts", "event_id"])
    live.run_upserts(firsts, path, progress, once=True, keys=keys, merge_every=8).awaitTermination()
    return live.latest_versions(spark, path, keys).drop("ts").withColumn("batch_time", F.col("batch_time").cast("timestamp_ntz"))
