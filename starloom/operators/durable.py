"""Lineage cuts: intermediate tables in the folder all executors share."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_written: ContextVar[list[str] | None] = ContextVar("written", default=None)  # paths of the innermost scope
_lock, _open_scopes = threading.Lock(), []  # of shuffles_removed: the setting before the first, then one entry each


def shared_folder(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir; where that is unset, a folder inside the session's warehouse.

    Both are places that the driver and all executors reach: off a local master, a warehouse on the driver's own disk is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    warehouse, master = spark.conf.get("spark.sql.warehouse.dir").rstrip("/"), spark.sparkContext.master
    if warehouse.startswith(("file:", "/")) and not (master == "local" or master.startswith("local[")):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors reach; the warehouse {warehouse} is on the driver's disk")
    return f"{warehouse}/_scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody else uses, under this application's part of the shared folder."""
    return f"{shared_folder(spark)}/starloom/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Delete at the end the tables that durable wrote inside, but for kept ones.

    For steps whose result is stored inside as well: a DataFrame that still reads an intermediate table must not leave. Scopes may
    nest; threads of jobs.together belong to the scope that started them.
    """
    from starloom.sources import files

    paths: list[str] = []
    token = _written.set(paths)
    try:
        yield
    finally:
        _written.reset(token)
        for path in paths:
            files.delete(spark, path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of each query that starts inside when it ends, not when the driver happens to collect its garbage.

    A query that is run twice computes its stages again. Scopes may nest, also in several threads; the last to end restores the setting.
    """
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    with _lock:
        if not _open_scopes:
            _open_scopes.append(spark.conf.get(setting))
        _open_scopes.append("")
        spark.conf.set(setting, "true")
    try:
        yield
    finally:
        with _lock:
            _open_scopes.pop()
            if len(_open_scopes) == 1:
                spark.conf.set(setting, _open_scopes.pop())


def durable(df: DataFrame, label: str, partition_by: list[str] | None = None, folder: str | None = None, keep: bool = False) -> DataFrame:
    """Write df once under the shared folder and read it back; under `folder` if given, whose owner deletes it.

    The copy has a fixed content whatever happens to executors, short lineage, and true size
    statistics for the join planner. With `keep` it outlives a scope of intermediates().
    """
    spark = df.sparkSession
    path = f"{folder.rstrip('/')}/{label}-{uuid.uuid4().hex}" if folder else scratch_path(spark, label)
    scope = _written.get()
    if scope is not None and not keep and not folder:
        scope.append(path)
    writer = df.write.mode("error")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
