"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Folders of local sessions, removed with the process.
_OWN_FOLDERS: list[tempfile.TemporaryDirectory] = []


def build_session(app: str = "tidegrid", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tested with."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.checkpoint.compress", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the session names in ``spark.checkpoint.dir``.

    Only a session whose executors are threads of the driver, as in tests, gets a
    folder of its own when none is named; it goes when the process ends.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        context.setCheckpointDir(configured)
    elif context.master == "local" or context.master.startswith("local["):
        folder = tempfile.TemporaryDirectory(prefix="tidegrid-checkpoint-", ignore_cleanup_errors=True)
        _OWN_FOLDERS.append(folder)
        context.setCheckpointDir(folder.name)
    else:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A path for a new folder that all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{os.urandom(8).hex()}"


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Within, the session has these settings (dots written as two underscores)."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within, Spark removes an action's shuffle files when the action is over.

    What the action has written does not need them, and they would else fill the disks
    until the driver happens to collect its garbage.
    """
    with settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        yield


def join_counted(left: DataFrame, right: DataFrame, on: list[str], rows: int = 100_000) -> DataFrame:
    """Join with a settled frame; it is broadcast only if it has at most ``rows`` rows."""
    small = right.limit(rows + 1).count() <= rows
    return left.join(F.broadcast(right) if small else right, on)


def settle(df: DataFrame) -> DataFrame:
    """Compute a frame once into reliable storage, for steps that read it again.

    Unlike a cache this survives lost executors, and unlike a written table it
    keeps the partitioning, so windows over the same keys need no new shuffle.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()
