"""Input validation: a table of checks, one aggregate per input, one table of findings.

A check is a counter. What happens when it counts something is looked up by its
action: ``fail``, or the name of a repair. Findings are rows ``(check, count,
action, message)``; all of them are gathered before any error is raised.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlake.functions.arrays import missing_cells
from hazardlake.functions.scalars import is_infinite, nan_to_null

from . import cleaning
from .joins import join_multiplicity
from .ordering import Order
from .rollup import keep_first, label_rollup

FAIL, NONE, WARN, SKIPPED = "fail", "none", "warn", "skipped"

# What is done about each finding, and the limits, unless told otherwise.
ACTIONS = {
    "repeated_keys": FAIL,
    "foreign_labels": FAIL,
    "infinite_cells": "clear",
    "sparse_rows": "drop",
    "missing_cells": "fill_median",
}
MISSING_SHARE = 0.9
MULTIPLICITY = 1.5


@dataclass(frozen=True)
class Rules:
    """Actions by check, limits, and the names and types of the columns checked."""

    actions: Mapping[str, str] = field(default_factory=lambda: dict(ACTIONS))
    missing_share: float = MISSING_SHARE
    multiplicity: float = MULTIPLICITY
    time: str = "batch_time"
    flag: str = "is_emergency"
    features: str = "features"
    dtype: str = "float"
    order_by: Order = ()

    def but(self, **changes: str) -> Rules:
        """The same rules with other actions."""
        return replace(self, actions={**self.actions, **changes})


Repair = Callable[[DataFrame, Rules], DataFrame]


def _leave(df: DataFrame, rules: Rules) -> DataFrame:
    return df


def _fill(policy: str) -> Repair:
    return lambda df, rules: cleaning.fill_missing(df, policy, rules.features)


REPAIRS: dict[str, dict[str, Repair]] = {
    "repeated_keys": {
        "drop": lambda df, rules: keep_first(df, [rules.time], rules.order_by),
        "aggregate": lambda df, rules: label_rollup(df, rules.time, rules.flag),
    },
    "foreign_labels": {"ignore": _leave},
    "infinite_cells": {"clear": lambda df, rules: cleaning.replace_infinite(df, rules.features)},
    "sparse_rows": {"drop": lambda df, rules: cleaning.drop_sparse_rows(df, rules.missing_share, rules.features), "keep": _leave},
    "missing_cells": {**{p: _fill(p) for p in cleaning.MISSING_POLICIES if p != FAIL}, "keep": _leave},
}

MESSAGES = {
    "repeated_keys": "{} rows share their time with another row",
    "foreign_labels": "{} labels other than 0 and 1",
    "infinite_cells": "{} infinite cells",
    "sparse_rows": "{} rows miss too many cells",
    "missing_cells": "{} missing cells",
}


@dataclass
class Findings:
    rows: list[tuple[str, float, str, str]] = field(default_factory=list)

    def add(self, check: str, count: float, action: str, message: str = "") -> None:
        self.rows.append((check, float(count), action, message))

    def count(self, check: str) -> float:
        return sum(n for c, n, _, _ in self.rows if c == check)

    def messages(self, *actions: str) -> list[str]:
        return [f"{c}: {text}" for c, _, a, text in self.rows if a in actions]

    @property
    def failures(self) -> list[str]:
        return self.messages(FAIL)

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, "check string, count double, action string, message string")

    def require(self) -> None:
        if self.failures:
            raise ValueError("validation failed:\n" + "\n".join(f"  - {f}" for f in self.failures))


# -- counters ------------------------------------------------------------------


def log_counts(log: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row: ``n_rows, repeated_keys, foreign_labels``; counted per key first, so no key is hot."""
    foreign = F.count_if(~F.col(rules.flag).cast("double").isin(0.0, 1.0)).alias("bad")
    per_key = log.groupBy(rules.time).agg(F.count(F.lit(1)).alias("n"), foreign)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    repeated = F.when(F.col("n") > 1, F.col("n"))
    return per_key.agg(total("n").alias("n_rows"), total(repeated).alias("repeated_keys"), total("bad").alias("foreign_labels"))


def cell_counts(telemetry: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row: ``infinite_cells, sparse_rows, missing_cells``.

    Each is counted as if the repairs before it had been made: cleared infinite
    cells are missing ones, and dropped rows miss nothing.
    """
    cells, clear = F.col(rules.features), rules.actions["infinite_cells"] == "clear"
    infinite = F.size(F.filter(cells, is_infinite))
    missing = missing_cells(cells) + (infinite if clear else F.lit(0))
    rows = telemetry.select(infinite.alias("infinite"), missing.alias("missing"), F.size(cells).alias("width"))
    sparse: Column = cleaning.is_sparse(F.col("missing"), F.col("width"), rules.missing_share)
    left = F.when(~sparse, F.col("missing")) if rules.actions["sparse_rows"] == "drop" else F.col("missing")
    return rows.agg(
        F.coalesce(F.sum("infinite"), F.lit(0)).alias("infinite_cells"),
        F.count_if(sparse).alias("sparse_rows"),
        F.coalesce(F.sum(left), F.lit(0)).alias("missing_cells"),
    )


# -- checks --------------------------------------------------------------------


def _settle(df: DataFrame, counts: DataFrame, checks: Sequence[str], rules: Rules, findings: Findings) -> DataFrame:
    """Record every check of a table and make the repairs that are called for, in order."""
    counted = counts.head()
    for check in checks:
        action, n = rules.actions[check], counted[check]
        repair = REPAIRS[check].get(action)
        if repair is None and action != FAIL:
            findings.add(check, n, FAIL, f"unknown action {action!r}")
        elif not n:
            findings.add(check, 0, NONE)
        else:
            findings.add(check, n, action, MESSAGES[check].format(n))
            df = repair(df, rules) if repair else df
    return df


def check_log(log: DataFrame, rules: Rules, findings: Findings) -> DataFrame:
    if rules.time not in log.columns:
        findings.add("time_column", 1, FAIL, f"no column {rules.time!r}")
        return log
    return _settle(log, log_counts(log, rules), ("foreign_labels", "repeated_keys"), rules, findings)


def check_cells(telemetry: DataFrame, rules: Rules, findings: Findings) -> DataFrame:
    """Infinite cells, then sparse rows, then missing cells; statistics come from the rows that are left."""
    table = telemetry.withColumn(rules.features, F.transform(rules.features, lambda x: nan_to_null(x.cast(rules.dtype))))
    return _settle(table, cell_counts(table, rules), ("infinite_cells", "sparse_rows", "missing_cells"), rules, findings)


def check_matrix(df: DataFrame, rules: Rules = Rules()) -> tuple[DataFrame, Findings]:
    """The cell checks without dropping any row."""
    keep = {"missing_cells": "keep"} if rules.actions["missing_cells"] == "drop" else {}
    findings = Findings()
    return check_cells(df, rules.but(sparse_rows="keep", **keep), findings), findings


def check_fan_out(log: DataFrame, telemetry: DataFrame, rules: Rules, findings: Findings) -> None:
    """How far the join of both would repeat rows."""
    fan = join_multiplicity(log, telemetry, rules.time).head()
    over = fan["multiplicity"] > rules.multiplicity
    findings.add("join_rows", fan["true_join_rows"], NONE)
    findings.add("multiplicity", fan["multiplicity"], FAIL if over else NONE, f"above {rules.multiplicity}" if over else "")
    most = max(fan["max_log_rows"], fan["max_telemetry_rows"])
    findings.add("rows_per_key", most, WARN if most > 1 else NONE, f"up to {most} rows share a key" if most > 1 else "")


def check_inputs(log: DataFrame, telemetry: DataFrame, rules: Rules | None = Rules()) -> tuple[DataFrame, DataFrame, Findings]:
    """Run every check, repair what the rules say, and raise all failures together; no rules, no checks."""
    findings = Findings()
    if rules is None:
        findings.add("all", 0, SKIPPED, "validation is off")
        return log, telemetry, findings
    log_left = check_log(log, rules, findings)
    telemetry_left = check_cells(telemetry, rules, findings)
    if rules.time in log.columns:
        check_fan_out(log_left, telemetry_left, rules, findings)
    findings.require()
    return log_left, telemetry_left, findings
