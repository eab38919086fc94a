"""Versioned table folders: a version is live once its marker file exists.

Creating one small file is atomic on every Hadoop file system, so all tables of a version switch at
once; a version that failed half-way has no marker and is never read.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from starloom.sources import files

MARKER = "_PUBLISHED"


def new_version(folder: str) -> str:
    """Path for a version that sorts after all earlier ones."""
    stamp = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}"
    return f"{folder.rstrip('/')}/version={stamp}-{uuid.uuid4().hex[:8]}"


def mark_live(spark: SparkSession, version: str) -> None:
    files.touch(spark, f"{version}/{MARKER}")


def live_versions(spark: SparkSession, folder: str) -> list[str]:
    """Paths of all marked versions, oldest first."""
    marks = files.glob(spark, f"{folder.rstrip('/')}/version=*/{MARKER}")
    return [mark.rsplit("/", 1)[0] for mark in marks]


def current_version(spark: SparkSession, folder: str) -> str | None:
    """Path of the newest marked version, or None."""
    versions = live_versions(spark, folder)
    return versions[-1] if versions else None


def retire_versions(spark: SparkSession, folder: str, keep: int = 2) -> list[str]:
    """Delete live versions before the newest `keep`, and unmarked ones, left by a lost driver, that are older than the live one."""
    live = live_versions(spark, folder)
    old = live[:-max(keep, 1)]
    for version in old + [v for v in files.glob(spark, f"{folder.rstrip('/')}/version=*") if live and v not in live and v < live[-1]]:
        files.delete(spark, version)
    return old
