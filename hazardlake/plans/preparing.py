"""Reading, cleaning, validating and rolling up."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazardlake.functions import arrays, scalars
from hazardlake.functions.arrays import to_array
from hazardlake.operators import cleaning, rollup, validation
from hazardlake.operators.joins import training_table
from hazardlake.operators.partitions import coerce_partitions
from hazardlake.session import scratch_path
from hazardlake.sources import artifacts, delimited, tables

from . import roles
from .registry import job
from .roles import FEATURES, cells_sql, r, rounded, telemetry_columns, with_parts

_ZERO_CELLS = ", ".join(r(f"coalesce({n}, 0)", n) for n in FEATURES)


def _telemetry_text(spark, folder):
    """Telemetry as it arrives: ';' separated, first column without a name, empty cells."""
    table = roles.telemetry(spark, folder)
    cells = [F.col("features")[i].cast("string").alias(n) for i, n in enumerate(FEATURES)]
    # Written out of order on purpose: readers must sort features by number.
    text = table.select(
        F.lit("x").alias(""), F.date_format("batch_time", "yyyy-MM-dd HH:mm:ss").alias("batch_time"), *reversed(cells)
    )
    return delimited.write_delimited(text, scratch_path(spark, "telemetry"), ";")


def _log_text(spark, folder):
    log = roles.event_log(spark, folder)
    text = log.select(
        "event_id", "r_id", F.col("batch_time").cast("string").alias("date"), F.col("is_emergency").cast("string").alias("is_emergency")
    )
    return delimited.write_delimited(text, scratch_path(spark, "log"))


# -- sources and sinks ---------------------------------------------------------


@job(with_parts("tel", f"SELECT batch_time, {_ZERO_CELLS} FROM tel"))
def delimited_telemetry(spark, folder):
    raw = delimited.read_telemetry(spark, _telemetry_text(spark, folder))
    folded = to_array(raw, arrays.feature_names(raw.columns))
    return telemetry_columns(folded.withColumn("features", arrays.zero_filled("features")))


@job(with_parts("elog", f"SELECT batch_time, {r('max(CAST(is_emergency AS INTEGER))', 'is_emergency')} FROM elog GROUP BY 1"))
def delimited_log_labels(spark, folder):
    log = delimited.read_event_log(spark, _log_text(spark, folder))
    return rollup.label_rollup(log).select("batch_time", rounded("is_emergency").alias("is_emergency"))


@job("SELECT l_returnflag, count(*) AS n_rows, " + r("sum(l_quantity)", "quantity") + " FROM lineitem GROUP BY 1")
def delimited_blocks(spark, folder):
    path = delimited.write_delimited(tables.read_table(spark, folder, "lineitem"), scratch_path(spark, "blocks"))
    rows = delimited.scan_in_blocks(spark, path, "16MB")
    return rows.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n_rows"), rounded(F.sum(F.col("l_quantity").try_cast("double"))).alias("quantity")
    )


@job(with_parts("tel", "SELECT batch_time, " + ", ".join(r(f"coalesce({n}, 0)", n) for n in ("v_2", "v_0")) + " FROM tel"))
def feature_contract(spark, folder):
    path = artifacts.save_contract(spark, scratch_path(spark, "contract"), ["v_2", "v_0"])
    contract = artifacts.load_contract(spark, path)
    raw = delimited.read_telemetry(spark, _telemetry_text(spark, folder))
    return raw.select("batch_time", *[rounded(scalars.number_or_zero(c)).alias(c) for c in contract])


_TRAINING = f"""SELECT t.batch_time, {cells_sql('t.')}, CAST(l.is_emergency AS INTEGER) AS label
FROM tel t JOIN (SELECT batch_time, max(is_emergency) AS is_emergency FROM elog GROUP BY 1) l ON t.batch_time = l.batch_time"""


@job(with_parts("tel elog", _TRAINING))
def training_table_sink(spark, folder):
    path = scratch_path(spark, "training")

    def build():
        return training_table(roles.telemetry(spark, folder), roles.event_log(spark, folder), ["batch_time"])

    tables.reuse_or_write(spark, path, build, by_day="batch_time")
    stored = tables.reuse_or_write(spark, path, build)
    return telemetry_columns(stored.drop("day")).select(
        "batch_time", *FEATURES, F.col("is_emergency").cast("int").alias("label")
    )


@job(with_parts("elog", "SELECT is_emergency, count(*) AS n, min(date) AS first_date FROM elog GROUP BY 1"))
def filtered_log_sink(spark, folder):
    kept = cleaning.with_known_flag(roles.event_log(spark, folder)).select("is_emergency", "date")
    stored = spark.read.parquet(tables.write_table(kept, scratch_path(spark, "filtered")))
    return stored.groupBy("is_emergency").agg(F.count(F.lit(1)).alias("n"), F.min("date").alias("first_date"))


# -- casts, projections, filters -------------------------------------------------


@job("""SELECT conv_id, turn, TRY_CAST(regexp_extract(text, '^[0-9]+') AS DOUBLE) AS lead_number,
CAST(contains(lower(text), 'error') AS DOUBLE) AS flag FROM conversations""")
def text_casts(spark, folder):
    rows = tables.read_table(spark, folder, "conversations")
    lead = F.regexp_extract("text", "^[0-9]+", 0)
    flag = scalars.flag_to_float(F.contains(F.lower("text"), F.lit("error")).cast("string"))
    return rows.select(
        "conv_id", "turn", scalars.number_or_null(lead, dtype="double").alias("lead_number"), flag.cast("double").alias("flag")
    )


@job(with_parts("elog", "SELECT r_id, count(*) AS n FROM elog WHERE is_emergency GROUP BY 1"))
def emergency_filter(spark, folder):
    return rollup.key_counts(cleaning.with_flag(roles.event_log(spark, folder), True), ["r_id"])


@job(with_parts("items", """SELECT l_linenumber, count(*) AS n,
count(*) FILTER (WHERE (f0 IS NULL OR f0 <> 0) AND (f1 IS NULL OR f1 <> 0) AND (f2 IS NULL OR f2 <> 0)) AS n_all
FROM items WHERE f0 IS NULL OR f0 <> 0 OR f1 IS NULL OR f1 <> 0 OR f2 IS NULL OR f2 <> 0 GROUP BY 1"""))
def nonzero_rows(spark, folder):
    some = cleaning.drop_zero_rows(roles.measured_items(spark, folder))
    return some.groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(arrays.all_nonzero("features")).alias("n_all")
    )


@job(with_parts("tel", f"SELECT batch_time, {cells_sql()} FROM tel WHERE v_0 IS NOT NULL AND v_1 IS NOT NULL AND v_2 IS NOT NULL AND v_3 IS NOT NULL"))
def complete_rows(spark, folder):
    return cleaning.drop_missing(telemetry_columns(roles.telemetry(spark, folder)), FEATURES)


@job(with_parts("items", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM items WHERE NOT (f0 IS NULL AND f1 IS NULL AND f2 IS NULL) GROUP BY 1, 2"))
def rows_with_any_cell(spark, folder):
    table = roles.measured_items(spark, folder)
    cells = [F.col("features")[i].alias(f"f{i}") for i in range(3)]
    kept = cleaning.drop_missing(table.select("l_orderkey", "l_linenumber", *cells), ["f0", "f1", "f2"], "all")
    return rollup.key_counts(kept, ["l_orderkey", "l_linenumber"])


@job(with_parts("tel", f"SELECT batch_time, {r('v_1', 'v_1')}, {r('v_2', 'v_2')} FROM tel"))
def column_slice(spark, folder):
    table = roles.telemetry(spark, folder)
    return arrays.spread(
        table.withColumn("features", F.slice("features", 2, 2)), "features", ["v_1", "v_2"]
    ).select("batch_time", rounded("v_1").alias("v_1"), rounded("v_2").alias("v_2"))


@job(with_parts("items", f"""SELECT l_orderkey, l_linenumber, {r('sum((CAST(coalesce(f0, 0) AS DOUBLE) - 0.1) / 0.9)', 'x0')},
CAST(floor(sum((CAST(CASE WHEN isinf(f1) THEN 0 ELSE coalesce(f1, 0) END AS DOUBLE) - 0.1) / 0.9)) AS BIGINT) AS x1, {r('sum((CAST(coalesce(f2, 0) AS DOUBLE) - 0.1) / 0.9)', 'x2')},
count(*) FILTER (WHERE coalesce(f0, 0) = 0 AND CASE WHEN isinf(f1) THEN 0 ELSE coalesce(f1, 0) END = 0 AND coalesce(f2, 0) = 0) AS n_no_information FROM items GROUP BY 1, 2"""))
def rescaled_records(spark, folder):
    raw = arrays.zero_filled(arrays.nulls_for_infinities("features"))
    rows = roles.measured_items(spark, folder).withColumn("raw", raw)
    wide = rows.withColumn("x", arrays.rescaled_record("raw", 5))
    sums = {f"x{i}": F.col("x")[i] for i in range(3)} | {"n_no_information": arrays.all_zero("raw").cast("int")}
    whole = rollup.sums_in_file_order(wide, ["l_orderkey", "l_linenumber"], sums)
    return whole.select(
        "l_orderkey", "l_linenumber", rounded("x0").alias("x0"), F.floor("x1").alias("x1"), rounded("x2").alias("x2"), "n_no_information"
    )


@job(with_parts("tel", f"SELECT batch_time, {_ZERO_CELLS} FROM tel"))
def partition_function(spark, folder):
    raw = delimited.read_telemetry(spark, _telemetry_text(spark, folder))
    return coerce_partitions(raw, FEATURES).select("batch_time", *[rounded(F.coalesce(c, F.lit(0.0))).alias(c) for c in FEATURES])


# -- roll-ups ---------------------------------------------------------------------


@job(with_parts("elog", "SELECT batch_time, CAST(max(is_emergency) AS INTEGER) AS is_emergency FROM elog GROUP BY 1"))
def label_rollup(spark, folder):
    labels = rollup.label_rollup(roles.event_log(spark, folder))
    return labels.select("batch_time", F.col("is_emergency").cast("int").alias("is_emergency"))


@job(with_parts("elog", """SELECT date_trunc('second', date) AS batch_time, count(*) AS n_ops,
CAST(sum(CAST(is_emergency AS INTEGER)) AS BIGINT) AS n_emergency_ops,
CAST(max(is_emergency) AS INTEGER) AS ground_truth FROM elog GROUP BY 1"""))
def context_rollup(spark, folder):
    return rollup.context_rollup(roles.event_log(spark, folder), "date")


@job(with_parts("teluser", f"SELECT batch_time, user_id, {cells_sql()} FROM (SELECT *, row_number() OVER (PARTITION BY batch_time ORDER BY user_id) AS rn FROM teluser) WHERE rn = 1"))
def keep_first_per_hour(spark, folder):
    return telemetry_columns(rollup.keep_first(roles.telemetry_by_user(spark, folder), ["batch_time"], ["user_id"]))


@job(with_parts("elog", """SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS duplicate_rows,
CAST(sum(bad) AS BIGINT) AS invalid_target_rows FROM (SELECT batch_time, count(*) AS n, count(*) FILTER (WHERE CAST(is_emergency AS INTEGER) NOT IN (0, 1)) AS bad FROM elog GROUP BY 1)"""))
def log_key_counters(spark, folder):
    return _log_counters(roles.event_log(spark, folder), validation.Rules())


def _log_counters(log, rules):
    names = {"repeated_keys": "duplicate_rows", "foreign_labels": "invalid_target_rows"}
    return validation.log_counts(log, rules).withColumnsRenamed(names)


@job("""SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS duplicate_rows,
CAST(sum(bad) AS BIGINT) AS invalid_target_rows FROM (SELECT l_orderkey, count(*) AS n, count(*) FILTER (WHERE l_linenumber NOT IN (0, 1)) AS bad FROM lineitem GROUP BY 1)""")
def target_domain_counters(spark, folder):
    rules = validation.Rules(time="l_orderkey", flag="l_linenumber")
    return _log_counters(tables.read_table(spark, folder, "lineitem"), rules)


@job(with_parts("items", """SELECT CAST(0 AS INTEGER) AS feature_idx, count(*) FILTER (WHERE isinf(f0)) AS n_inf FROM items
UNION ALL SELECT 1, count(*) FILTER (WHERE isinf(f1)) FROM items UNION ALL SELECT 2, count(*) FILTER (WHERE isinf(f2)) FROM items"""))
def infinite_counts(spark, folder):
    return cleaning.infinite_counts(roles.measured_items(spark, folder))


_CLEAN = "clean AS (SELECT l_orderkey, l_linenumber, f0, CASE WHEN NOT isinf(f1) THEN f1 END AS f1, f2 FROM items)"
_DENSE = _CLEAN + """, dense AS (SELECT * FROM clean
WHERE (CAST(f0 IS NULL AS INTEGER) + CAST(f1 IS NULL AS INTEGER) + CAST(f2 IS NULL AS INTEGER)) / 3.0 <= 0.5)"""


def _dense(spark, folder):
    return cleaning.drop_sparse_rows(cleaning.replace_infinite(roles.measured_items(spark, folder)), 0.5)


@job(with_parts("items", ", " + _DENSE + """ SELECT l_linenumber, count(*) AS n, count(f0) AS n0, count(f1) AS n1, count(f2) AS n2
FROM dense GROUP BY 1"""))
def sparse_row_filter(spark, folder):
    return _dense(spark, folder).groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("n"), *[F.count(F.col("features")[i]).alias(f"n{i}") for i in range(3)]
    )


def _filled_sql(fill: str) -> str:
    filled = [f"coalesce(CAST(f{i} AS DOUBLE), {fill.format(i)})" for i in range(3)]
    aggregates = ", ".join(
        f"{r(f'avg(x{i})', f'mean{i}')}, {r(f'min(x{i})', f'lo{i}')}, {r(f'max(x{i})', f'hi{i}')}" for i in range(3)
    )
    inner = ", ".join(f"CAST(CAST({e} AS FLOAT) AS DOUBLE) AS x{i}" for i, e in enumerate(filled))
    body = f", {_DENSE} SELECT l_linenumber, count(*) AS n, {aggregates} FROM (SELECT l_linenumber, {inner} FROM dense) GROUP BY 1"
    return with_parts("items", body)


def _fill_summary(df):
    x = [F.col("features")[i].cast("double") for i in range(3)]
    return df.groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("n"),
        *[e for i in range(3) for e in (rounded(F.avg(x[i])).alias(f"mean{i}"), rounded(F.min(x[i])).alias(f"lo{i}"), rounded(F.max(x[i])).alias(f"hi{i}"))],
    )


@job(_filled_sql("0.0"))
def fill_zero(spark, folder):
    return _fill_summary(cleaning.fill_missing(_dense(spark, folder), "fill_zero"))


@job(_filled_sql("(SELECT coalesce(avg(CAST(f{0} AS DOUBLE)), 0.0) FROM dense)"))
def fill_mean(spark, folder):
    return _fill_summary(cleaning.fill_missing(_dense(spark, folder), "fill_mean"))


@job(_filled_sql("(SELECT coalesce(median(CAST(f{0} AS DOUBLE)), 0.0) FROM dense)"))
def fill_median(spark, folder):
    return _fill_summary(cleaning.fill_missing(_dense(spark, folder), "fill_median"))


@job(with_parts("items", ", " + _DENSE + " SELECT l_linenumber, count(*) AS n FROM dense WHERE f0 IS NOT NULL AND f1 IS NOT NULL AND f2 IS NOT NULL GROUP BY 1"))
def drop_incomplete_rows(spark, folder):
    return rollup.key_counts(cleaning.fill_missing(_dense(spark, folder), "drop"), ["l_linenumber"])


@job(with_parts("items", ", " + _CLEAN + f""" SELECT count(*) AS n_rows,
(SELECT count(*) FROM items WHERE isinf(f1)) AS infinite_replaced,
CAST(sum(CAST(f0 IS NULL AS INTEGER) + CAST(f1 IS NULL AS INTEGER) + CAST(f2 IS NULL AS INTEGER)) AS BIGINT) AS missing_cells,
{r('avg(CAST(CAST(coalesce(CAST(f1 AS DOUBLE), (SELECT median(CAST(f1 AS DOUBLE)) FROM clean)) AS FLOAT) AS DOUBLE))', 'mean1')} FROM clean"""))
def matrix_fill_median(spark, folder):
    filled, found = validation.check_matrix(roles.measured_items(spark, folder))
    return filled.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(found.count("infinite_cells")).cast("bigint").alias("infinite_replaced"),
        F.lit(found.count("missing_cells")).cast("bigint").alias("missing_cells"),
        rounded(F.avg(F.col("features")[1].cast("double"))).alias("mean1"),
    )


@job(with_parts("elog teluser", """, cells AS (SELECT batch_time, CAST(v_0 IS NULL AS INTEGER) + CAST(v_1 IS NULL AS INTEGER)
+ CAST(v_2 IS NULL AS INTEGER) + CAST(v_3 IS NULL AS INTEGER) AS missing,
CAST(coalesce(isinf(v_0), false) AS INTEGER) + CAST(coalesce(isinf(v_1), false) AS INTEGER) + CAST(coalesce(isinf(v_2), false) AS INTEGER) + CAST(coalesce(isinf(v_3), false) AS INTEGER) AS infinite FROM teluser),
keep AS (SELECT * FROM cells WHERE (missing + infinite) / 4.0 <= 0.5),
a AS (SELECT batch_time, count(*) AS n FROM elog GROUP BY 1), b AS (SELECT batch_time, count(*) AS n FROM keep GROUP BY 1),
-- the log is rolled up to one row per time before it is joined
both_sides AS (SELECT 1 AS n1, b.n AS n2 FROM a JOIN b ON a.batch_time = b.batch_time),
found AS (SELECT 'repeated_keys' AS check_name, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS DOUBLE) AS n_found, 'aggregate' AS action FROM a
UNION ALL SELECT 'foreign_labels', CAST(count(*) FILTER (WHERE CAST(is_emergency AS INTEGER) NOT IN (0, 1)) AS DOUBLE), 'fail' FROM elog
UNION ALL SELECT 'infinite_cells', CAST(sum(infinite) AS DOUBLE), 'clear' FROM cells
UNION ALL SELECT 'sparse_rows', CAST(count(*) FILTER (WHERE (missing + infinite) / 4.0 > 0.5) AS DOUBLE), 'drop' FROM cells
UNION ALL SELECT 'missing_cells', CAST(sum(missing + infinite) AS DOUBLE), 'fill_median' FROM keep)
SELECT check_name, n_found, CASE WHEN n_found = 0 THEN 'none' ELSE action END AS action FROM found
UNION ALL SELECT 'join_rows', CAST(sum(n1 * n2) AS DOUBLE), 'none' FROM both_sides
UNION ALL SELECT 'multiplicity', CAST(sum(least(n1, n2)) AS DOUBLE) / count(*), 'none' FROM both_sides
UNION ALL SELECT 'rows_per_key', CAST(max(n) AS DOUBLE), CASE WHEN max(n) > 1 THEN 'warn' ELSE 'none' END FROM b"""))
def validation_report(spark, folder):
    rules = validation.Rules(order_by=["event_id"], missing_share=0.5).but(repeated_keys="aggregate")
    _, _, found = validation.check_inputs(roles.event_log(spark, folder), roles.telemetry_by_user(spark, folder), rules)
    return found.to_df(spark).select(F.col("check").alias("check_name"), F.col("count").alias("n_found"), "action")


_PROFILED = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


@job(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) FILTER (WHERE {c} IS NULL) AS n_null, count(DISTINCT {c}) AS n_distinct FROM orders" for c in _PROFILED))
def column_profile(spark, folder):
    return rollup.column_profile(tables.read_table(spark, folder, "orders"), _PROFILED)


@job(with_parts("ord", "SELECT label, count(*) AS n, " + r("count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM ord)", "share") + " FROM ord GROUP BY 1"))
def label_value_counts(spark, folder):
    shares = rollup.class_shares(roles.labelled_orders(spark, folder), "label")
    return shares.select("label", "n", rounded("share").alias("share"))


@job("""SELECT 'year' AS part, CAST(year(o_orderdate) AS INTEGER) AS value FROM orders GROUP BY 2
UNION ALL SELECT 'month', CAST(month(o_orderdate) AS INTEGER) FROM orders GROUP BY 2
UNION ALL SELECT 'day', CAST(day(o_orderdate) AS INTEGER) FROM orders GROUP BY 2""")
def calendar_parts(spark, folder):
    found = rollup.calendar_parts(tables.read_table(spark, folder, "orders"), "o_orderdate")

    def labelled(part, column):
        return F.transform(column, lambda v: F.struct(F.lit(part).alias("part"), v.alias("value")))

    parts = [labelled("year", "years"), labelled("month", "months"), labelled("day", "days")]
    return found.select(F.explode(F.concat(*parts)).alias("p")).select("p.part", "p.value")


@job(with_parts("elog", "SELECT is_emergency AS flag, CAST(date AS DATE) AS day, count(*) AS n FROM elog GROUP BY 1, 2"))
def daily_counts(spark, folder):
    return rollup.daily_counts(roles.event_log(spark, folder), "date")


_DAILY = ", daily AS (SELECT is_emergency AS flag, CAST(date AS DATE) AS day, count(*) AS n FROM elog GROUP BY 1, 2)"
_PEAKS = _DAILY + """, p AS (SELECT flag, day, n, row_number() OVER (PARTITION BY flag ORDER BY n DESC, day) AS hi,
row_number() OVER (PARTITION BY flag ORDER BY n, day) AS lo FROM daily)"""


@job(with_parts("elog", _PEAKS + " SELECT a.flag, a.day AS peak_day, a.n AS peak_n, b.day AS low_day, b.n AS low_n FROM p a JOIN p b ON a.flag = b.flag WHERE a.hi = 1 AND b.lo = 1"))
def extreme_days(spark, folder):
    return rollup.extreme_days(rollup.daily_counts(roles.event_log(spark, folder), "date"))


@job(with_parts("elog", _PEAKS + """ SELECT e.is_emergency AS flag, CAST(e.date AS DATE) AS day, e.r_id, count(*) AS n
FROM elog e JOIN p ON p.flag = e.is_emergency AND p.day = CAST(e.date AS DATE) WHERE p.hi = 1 GROUP BY 1, 2, 3"""))
def peak_day_entities(spark, folder):
    log = roles.event_log(spark, folder)
    peaks = rollup.extreme_days(rollup.daily_counts(log, "date")).select("flag", F.col("peak_day").alias("day"))
    return rollup.entities_on_days(log, peaks, "date", "r_id")


@job(with_parts("elog", """SELECT flag, day, r_id, n FROM (SELECT *, row_number() OVER (PARTITION BY flag, day ORDER BY n DESC, r_id) AS rn
FROM (SELECT is_emergency AS flag, CAST(date AS DATE) AS day, r_id, count(*) AS n FROM elog GROUP BY 1, 2, 3)) WHERE rn = 1"""))
def daily_mode(spark, folder):
    return rollup.daily_mode(roles.event_log(spark, folder), "date", "r_id")


@job(with_parts("ord", f""", c AS (SELECT count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS n FROM ord)
SELECT 'statistical' AS mode, {r('CAST(n AS DOUBLE) / p', 'pos_weight')} FROM c UNION ALL SELECT 'cost_matrix', 100.0 UNION ALL SELECT 'explicit', 2.5"""))
def positive_weights(spark, folder):
    table = roles.labelled_orders(spark, folder)
    parts = [
        rollup.positive_weight(table, "label", mode, 2.5 if mode == "explicit" else None).select(
            F.lit(mode).alias("mode"), rounded("pos_weight").alias("pos_weight")
        )
        for mode in ("statistical", "cost_matrix", "explicit")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
