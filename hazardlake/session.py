"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "hazardlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for.

    Nothing below is required for right results: every operator keeps to
    zone-free timestamps and to explicit orders.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """This application's folder below the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` is used as it is. Where the
    session names none, a temporary one is set if all runs in one process;
    executors on other machines would not find it, so there it is an error.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="hazardlake-"))
    return context.getCheckpointDir()


_OWNERS: list[list[str]] = []


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A path in the shared folder that no other job writes to."""
    path = f"{checkpoint_dir(spark)}/{purpose}-{uuid.uuid4().hex}"
    if _OWNERS:
        _OWNERS[-1].append(path)
    return path


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a table of the shared folder that nothing reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def owned_scratch(spark: SparkSession) -> Iterator[None]:
    """Delete what was stored inside the block when it ends.

    Write the result inside the block: frames that read stored tables are of no
    use after it.
    """
    _OWNERS.append([])
    try:
        yield
    finally:
        for path in _OWNERS.pop():
            drop_scratch(spark, path)


def stored(df: DataFrame, purpose: str = "table") -> DataFrame:
    """The same rows read back from a table in the shared folder.

    Used where a plan must not be evaluated again: what was written stays the
    same when executors are lost. Unlike a checkpointed plan, the table is
    columnar, is read column by column, and has a size the optimizer knows.
    """
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the Python workers, once per application.

    Functions that run in tasks are found by import there; Spark's own file
    server distributes the modules, so executors need no shared folder for it.
    """
    context, root = spark.sparkContext, Path(__file__).parent
    if getattr(context, "_ships_hazardlake", False) or not root.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="hazardlake-code-")) / "hazardlake.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for module in sorted(root.rglob("*.py")):
            out.write(module, module.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._ships_hazardlake = True
