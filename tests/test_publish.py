"""CSV ingest, write-audit-publish, stage runner and reports."""

from __future__ import annotations

import csv
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from small_shop import ROWS, raw_shop

from starloom.__main__ import main, summary
from starloom.jobs import together
from starloom.plans import audit, publish
from starloom.plans.clean import clean_views
from starloom.plans.run import run
from starloom.schemas import DURATIONS, RAW_COLUMNS, STAR_TABLES, star_columns
from starloom.sources.extracts import read_extracts
from starloom.sources.sql import run_query, run_suite
from starloom.sources.versions import current_version, live_versions, retire_versions


def write_csv(folder: Path, skip=()):
    folder.mkdir(parents=True, exist_ok=True)
    for table, rows in ROWS.items():
        if table in skip:
            continue
        suffix = "" if table.endswith("translation") else "_dataset"
        with open(folder / f"shop_{table}{suffix}.csv", "w", encoding="utf-8-sig", newline="") as f:
            out = csv.writer(f)
            out.writerow(RAW_COLUMNS[table])
            out.writerows([["" if v is None else v for v in row] for row in rows])
    return str(folder)


@pytest.fixture(scope="module")
def shop_csv(tmp_path_factory):
    return write_csv(tmp_path_factory.mktemp("csv"))


def test_csv_scan(spark, shop_csv):
    raw = read_extracts(spark, shop_csv)
    assert {t: df.count() for t, df in raw.items()} == {t: len(rows) for t, rows in ROWS.items()}
    assert raw["customers"].columns[0] == "customer_id"  # no byte order mark in sight
    review = raw["order_reviews"].filter("review_id = 'r2'").first()
    assert review.review_comment_message == 'fine, "really"\nfine'
    assert raw["customers"].filter("customer_id = 'c1'").first().customer_zip_code_prefix == "01001"


def test_missing_extract_is_an_empty_table(spark, tmp_path):
    raw = read_extracts(spark, write_csv(tmp_path, skip=("sellers",)))
    assert raw["sellers"].isEmpty() and raw["sellers"].columns == RAW_COLUMNS["sellers"]


def test_malformed_row_stops_the_load(spark, tmp_path):
    folder = write_csv(tmp_path)
    with open(tmp_path / "shop_sellers_dataset.csv", "a", encoding="utf-8") as f:
        f.write("s9,1\r\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_extracts(spark, folder)["sellers"].select("seller_id").collect()


def test_publish_and_read(spark, tmp_path):
    raw = raw_shop(spark)
    version = publish.publish(spark, clean_views(raw), str(tmp_path), audit=lambda star: [])
    star = publish.read_star(spark, str(tmp_path), register=True)
    assert list(star) == STAR_TABLES and version.rsplit("/", 1)[1] in current_version(spark, str(tmp_path))
    keys = [r.sales_key for r in star["fact_sales"].select("sales_key").collect()]
    assert sorted(keys) == list(range(1, 7))
    assert spark.sql("SELECT count(*) AS n FROM fact_order_fulfillment").first().n == 6
    lazily = {t: df for t, df in star.items()}
    assert lazily["fact_sales"].columns == star_columns("fact_sales") + ["purchase_month"]


def test_qualified_table_names(spark, tmp_path):
    publish.publish(spark, clean_views(raw_shop(spark)), str(tmp_path), audit=lambda star: [])
    publish.register_database(spark, str(tmp_path), "shop_dwh")
    sql = "SELECT count(*) AS n, sum(s.sales_amount) AS v FROM shop_dwh.fact_sales s LEFT JOIN shop_dwh.dim_date d ON s.date_key = d.date_key"
    row = spark.sql(sql).first()
    assert row.n == 6 and str(row.v) == "38.85"
    assert spark.table("shop_dwh.fact_sales").columns == star_columns("fact_sales")


def test_failed_audit_keeps_the_old_version(spark, tmp_path):
    views = clean_views(raw_shop(spark))
    publish.publish(spark, views, str(tmp_path), audit=lambda star: [])
    before = current_version(spark, str(tmp_path))
    with pytest.raises(publish.AuditFailed) as e:
        publish.publish(spark, views, str(tmp_path), audit=lambda star: ["grain"])
    assert e.value.problems == ["grain"]
    assert [p.name for p in tmp_path.glob("version=*")] == [before.rsplit("/", 1)[1]]  # nothing of the failed version stays
    assert not list(tmp_path.glob("version=*/_scratch*"))
    assert current_version(spark, str(tmp_path)) == before


def test_gate_stops_a_repeated_order(spark, tmp_path):
    raw = raw_shop(spark)
    raw["orders"] = raw["orders"].unionByName(raw["orders"].filter("order_id = 'o1'"))
    with pytest.raises(publish.AuditFailed) as e:
        publish.publish(spark, clean_views(raw), str(tmp_path), audit.prepublish_gate(raw))
    text = str(e.value)
    assert "grain: fact_order_fulfillment (order_id): 1" in text and "grain: fact_sales (order_id, order_item_id): 2" in text
    assert current_version(spark, str(tmp_path)) is None


def test_gate_explains_missing_items(spark):
    raw = raw_shop(spark)
    views = clean_views(raw)
    from starloom.plans.star import build_lazy

    star = build_lazy(spark, views)
    star["fact_sales"] = star["fact_sales"].filter("order_id != 'lost'").withColumn("sales_key", F.lit(1))
    star["fact_order_fulfillment"] = star["fact_order_fulfillment"].withColumn("fulfillment_key", F.lit(1))
    problems = audit.prepublish_gate(raw)(star)
    assert "every eligible item is loaded: 1" in problems
    assert "lost items of orders that the order extract does not hold: 1" in problems and "lost items without an order or an item number: 2" in problems


def test_old_versions_retire(spark, tmp_path):
    views = clean_views(raw_shop(spark))
    for _ in range(3):
        publish.publish(spark, views, str(tmp_path), audit=lambda star: [])
    keep = live_versions(spark, str(tmp_path))[-1]
    assert len(retire_versions(spark, str(tmp_path), keep=1)) == 2
    assert live_versions(spark, str(tmp_path)) == [keep]


def test_counts_are_observed_while_tables_are_written(spark, tmp_path):
    """The audit of a version just written finds what a scan finds, and scans no fact for it."""
    raw = raw_shop(spark)
    version = publish.write_star(spark, clean_views(raw), f"{tmp_path}/v1")
    assert set(version.seen) == set(STAR_TABLES)
    assert {t: n["n"] for t, n in version.seen.items()} == {t: df.count() for t, df in version.items()}
    negative = " OR ".join(f"{c} < 0" for c in DURATIONS)
    assert version.seen["fact_order_fulfillment"]["negative"] == version["fact_order_fulfillment"].where(negative).count()
    observed, scanned = audit.prepublish(raw, version), audit.prepublish(raw, dict(version))
    assert sorted(map(tuple, observed.collect())) == sorted(map(tuple, scanned.collect()))
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (observed, scanned)]
    assert not any(c in plans[0] for c in DURATIONS) and all(c in plans[1] for c in DURATIONS)
    assert not (tmp_path / "v1" / "_scratch").exists()


def test_scopes_delete_intermediate_tables_but_kept_ones(spark):
    from starloom.operators.durable import durable, intermediates
    from starloom.sources import files

    def path(df):
        return df.inputFiles()[0].rsplit("/", 1)[0]

    before = path(durable(spark.range(3), "before"))
    with intermediates(spark):
        gone, kept = durable(spark.range(3), "gone"), durable(spark.range(4), "kept", keep=True)
        in_thread = together(lambda: path(durable(spark.range(3), "thread")))[0]
        with intermediates(spark):
            inner = path(durable(spark.range(3), "inner"))
        assert not files.exists(spark, inner) and files.exists(spark, path(gone)) and files.exists(spark, in_thread)
        paths = [path(gone), in_thread]
    assert not any(files.exists(spark, p) for p in paths)
    assert kept.count() == 4 and files.exists(spark, before)
    with pytest.raises(ZeroDivisionError), intermediates(spark):
        failed = path(durable(spark.range(3), "failed"))
        1 / 0
    assert not files.exists(spark, failed)


def test_a_driver_disk_is_no_shared_folder_of_a_cluster():
    from types import SimpleNamespace as Fake

    from starloom.operators.durable import shared_folder

    def session(master, **conf):
        return Fake(conf=Fake(get=lambda key, *default: conf.get(key.rsplit(".", 2)[-2], *default)), sparkContext=Fake(master=master))

    assert shared_folder(session("local[2]", warehouse="file:/tmp/w")) == "file:/tmp/w/_scratch"
    assert shared_folder(session("yarn", warehouse="hdfs://n/w")) == "hdfs://n/w/_scratch"
    assert shared_folder(session("yarn", warehouse="file:/tmp/w", checkpoint="hdfs://n/c/")) == "hdfs://n/c"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session("spark://h:7077", warehouse="file:/tmp/w"))


def test_month_filter_prunes_folders(spark, tmp_path):
    publish.publish(spark, clean_views(raw_shop(spark)), str(tmp_path), audit=lambda star: [])
    sales = publish.read_star(spark, str(tmp_path))["fact_sales"].filter("purchase_month = 201701")
    plan = sales._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(purchase_month" in plan
    assert sales.count() == 3


def test_stage_runner(spark, shop_csv, tmp_path):
    report = run(spark, shop_csv, str(tmp_path))
    assert report.staged_rows["orders"] == 8 and report.version
    assert len(report.checks) == 72 and report.critical_failures > 0
    assert "warehouse_null_rates_overview.csv" in report.reports
    for name in report.reports:
        assert any((tmp_path / "validation_reports" / name).glob("part-*.csv"))
    assert "null_mandatory_fact_sales_price.csv" in report.reports
    assert "72 checks" in summary(report)
    again = run(spark, shop_csv, str(tmp_path), stages=("validation",))
    assert again.version is None and [c.failed_count for c in again.checks] == [c.failed_count for c in report.checks]


def test_exit_codes(spark, shop_csv, tmp_path, capsys):
    assert main([str(tmp_path / "nothing"), str(tmp_path / "home")]) == 1  # every table empty: the gate refuses
    assert "not empty" in capsys.readouterr().err
    assert main([shop_csv, str(tmp_path / "other"), "--skip-staging"]) == 2
    assert main([shop_csv, str(tmp_path / "third"), "--skip-validation"]) == 0


def test_parameters_are_values_not_text(spark):
    rows = run_query(spark, "SELECT :a AS a, :b AS b", {"a": "x' OR '1'='1", "b": 3}).collect()
    assert (rows[0].a, rows[0].b) == ("x' OR '1'='1", 3)


def test_sql_suites(spark, tmp_path):
    views = clean_views(raw_shop(spark))
    shipped = Path(audit.__file__).parent.parent / "sql" / "staging_tests.sql"
    result = run_suite(spark, "staging", shipped, views)
    assert dict(result.tests)["orders_null_order_id"] == 1 and result.failed == 1
    broken = tmp_path / "broken.sql"
    broken.write_text("SELECT nothing FROM nowhere")
    assert run_suite(spark, "broken", broken, {}).failed == 1
    broken.write_text("  ")
    assert "empty" in run_suite(spark, "empty", broken, {}).error
