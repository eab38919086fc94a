"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # With pruning on, a malformed CSV row goes unseen when only some columns are read.
    "spark.sql.csv.parser.columnPruning.enabled": "false",
}


def session(app: str = "starloom", master: str | None = None, **extra: str) -> SparkSession:
    """Get or create a session; cluster sizing is left to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
