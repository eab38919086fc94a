"""The few file operations Spark's DataFrame API lacks, on any Hadoop file system."""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, sorted."""
    fs, target = _fs(spark, pattern)
    return sorted(status.getPath().toString() for status in (fs.globStatus(target) or []))


def fingerprint(spark: SparkSession, pattern: str) -> str:
    """Short digest of names, sizes and times of the matching files; changes when one is rewritten."""
    fs, target = _fs(spark, pattern)
    seen = sorted(f"{s.getPath()} {s.getLen()} {s.getModificationTime()}" for s in (fs.globStatus(target) or []))
    return hashlib.md5("\n".join(seen).encode()).hexdigest()[:12]


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file; fails if it is there already."""
    fs, target = _fs(spark, path)
    fs.create(target, False).close()


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder and all below it."""
    fs, target = _fs(spark, path)
    fs.delete(target, True)
