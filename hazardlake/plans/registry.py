"""Named jobs ``(spark, folder) -> DataFrame`` and the SQL that computes the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Job = Callable[[SparkSession, str], DataFrame]

JOBS: dict[str, Job] = {}
ORACLES: dict[str, str] = {}


def job(sql: str | None = None) -> Callable[[Job], Job]:
    """Register a function under its own name, with its SQL if there is one."""

    def add(fn: Job) -> Job:
        JOBS[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql.strip()
        return fn

    return add
