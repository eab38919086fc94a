"""The published star of a test data folder, built once per application and state of the folder."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from starloom.operators.durable import shared_folder
from starloom.plans.audit import prepublish_gate
from starloom.plans.clean import clean_views
from starloom.plans.publish import publish, read_star
from starloom.sources import files
from starloom.sources.extracts import read_staging, write_staging
from starloom.sources.versions import current_version
from starloom.workload.feed import raw_feed

_open: dict[str, dict[str, DataFrame]] = {}  # the folder name holds the application id and the state of the data


def home_folder(spark: SparkSession, sf_dir: str) -> str:
    state = files.fingerprint(spark, f"{sf_dir.rstrip('/')}/*.parquet")
    return f"{shared_folder(spark)}/starloom/{spark.sparkContext.applicationId}/home-{state}"


def live_raw(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    """The staged raw tables; the first call of an application stages the feed."""
    folder = f"{home_folder(spark, sf_dir)}/staging"
    if current_version(spark, folder) is None:
        write_staging(spark, raw_feed(spark, sf_dir), folder)
    return read_staging(spark, folder)


def live_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The live star; the first call of an application stages, builds, audits and publishes it."""
    folder = f"{home_folder(spark, sf_dir)}/warehouse"
    if folder not in _open:
        if current_version(spark, folder) is None:
            raw = live_raw(spark, sf_dir)
            publish(spark, clean_views(raw), folder, prepublish_gate(raw))
        _open[folder] = read_star(spark, folder)
    return _open[folder]
