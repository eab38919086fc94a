"""What stays on disk while a star is staged and published, and after."""

from __future__ import annotations

import time

from starloom.operators.durable import shuffles_removed
from starloom.plans import publish
from starloom.plans.clean import clean_views
from starloom.sources.extracts import read_staging, write_staging
from starloom.workload.feed import raw_feed

SMALL = "/root/testdata/sf0.001"
SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark) -> set[str]:
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for k in range(found.size()) if (name := found.apply(k).getName()).startswith("shuffle_")}


def left_by(spark, job) -> set[str]:
    before = shuffle_files(spark)
    job()
    for _ in range(20):  # files go a moment after the query
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.5)
    return left


def test_staging_and_publishing_leave_no_shuffle_files(spark, tmp_path, monkeypatch):
    audited, deleted = [], []
    delete = publish.files.delete
    monkeypatch.setattr(publish.files, "delete", lambda s, path: (deleted.append(path.split("/_scratch")[-1]), delete(s, path)))
    assert not left_by(spark, lambda: write_staging(spark, raw_feed(spark, SMALL), f"{tmp_path}/staging"))
    raw = read_staging(spark, f"{tmp_path}/staging")
    assert not left_by(spark, lambda: publish.publish(spark, clean_views(raw), f"{tmp_path}/warehouse", lambda star: audited.append(star["fact_sales"].count()) or []))
    assert audited[0] > 0 and spark.conf.get(SETTING) == "false"
    # what a step stored on the way goes before the next one
    assert deleted == ["/dimensions", "/fact_order_fulfillment", "/orders", "/fact_sales", ""]


def test_the_setting_comes_back(spark):
    with shuffles_removed(spark), shuffles_removed(spark):
        assert spark.conf.get(SETTING) == "true"
    assert spark.conf.get(SETTING) == "false"
