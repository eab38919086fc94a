"""The audit: a clean star passes, and each single defect flips exactly its own checks."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from small_shop import raw_shop

from starloom.plans import audit
from starloom.plans.clean import clean_views
from starloom.plans.star import Calendar, dim_date
from starloom.schemas import STAR_TABLES, star_schema


def make_star(spark):
    """Ten orders with one item each, nothing wrong anywhere."""
    n = range(1, 11)
    frames = {
        "dim_customer": [(i, f"u{i}", "town", "SP", "01001") for i in n],
        "dim_product": [(i, f"p{i}", "cat", "Cat", 1, 1, 1, D("1.00"), D("1.00"), D("1.00"), D("1.00")) for i in n],
        "dim_seller": [(i, f"s{i}", "town", "RJ", "20000") for i in n],
        "fact_sales": [(i, f"o{i}", 1, i, i, i, 20170101 + i, D("10.00"), D("1.00"), D("11.00")) for i in n],
        "fact_order_fulfillment": [
            (i, f"o{i}", i, 20170101 + i, 20170102 + i, 20170103 + i, 20170104 + i, 20170110, D("1.00"), D("2.00"), D("3.00"), D("6.00"),
             D("-1.00"), 5, "delivered", True, D("11.00"), 1) for i in n],
    }
    star = {t: spark.createDataFrame(rows, star_schema(t)) for t, rows in frames.items()}
    star["dim_date"] = dim_date(spark, Calendar(dt.date(2017, 1, 1), dt.date(2017, 12, 31)))
    return {t: star[t] for t in STAR_TABLES}


@pytest.fixture(scope="module")
def good(spark):
    return {t: df.coalesce(1).cache() for t, df in make_star(spark).items()}


def change(star, table, where, **values):
    """The star with some columns of some rows replaced."""
    df = star[table]
    for name, value in values.items():
        new = (value if not isinstance(value, (str, int, float, bool, type(None))) else F.lit(value)).cast(df.schema[name].dataType)
        df = df.withColumn(name, F.when(F.expr(where), new).otherwise(F.col(name)))
    return {**star, table: df}


def repeat(star, table, where):
    return {**star, table: star[table].unionByName(star[table].filter(where))}


def failed(star, groups=None):
    return {r.name: r.failed_count for r in audit.check_results(star, groups).filter("failed_count > 0").collect()}


def test_catalogue_counts():
    checks = audit.catalogue()
    assert len(checks) == 72
    groups = [sum(c.category == name for c in checks) for name in audit.CATEGORIES.values()]
    assert groups == [17, 32, 8, 3, 3, 8, 1]
    assert sum(c.severity == "CRITICAL" for c in checks) == 60


@pytest.fixture(autouse=True)
def _session(spark):
    """Columns of the catalogue need a running session."""


def test_clean_star_passes(good):
    rows = audit.check_results(good).collect()
    assert sorted(r.check_no for r in rows) == list(range(1, 73))
    assert all(r.status == "PASS" and r.error_pct == 0.0 for r in rows)
    v = audit.verdict(audit.check_results(good)).first()
    assert (v.total_checks, v.passed, v.warnings, v.critical_failures) == (72, 72, 0, 0)


FOF, FS = "fact_order_fulfillment", "fact_sales"

DEFECTS = [
    (lambda s, k: change(s, FS, f"sales_key = {k}", price=-1, freight_value=12), {"Non-negative values: price, freight, sales_amount": 1}),
    (lambda s, k: change(s, FS, f"sales_key = {k}", sales_amount=12), {"Sales Amount Match: sales_amount == price + freight (tol 0.01)": 1,
                                                                "Order Sales vs Payment Discrepancy (> 1% diff)": 1}),
    (lambda s, k: change(s, FS, f"sales_key = {k}", sales_amount=F.lit("11.01")), {}),
    (lambda s, k: change(s, FS, f"sales_key = {k}", price=None), {"Mandatory Column Not Null: fact_sales.price": 1}),
    (lambda s, k: change(s, FOF, f"fulfillment_key = {k}", hours_to_approval=-1, total_fulfillment_hours=4), {"Non-negative hours in fact_order_fulfillment": 1}),
    (lambda s, k: change(s, FOF, f"fulfillment_key = {k}", total_fulfillment_hours=F.lit("6.06")), {"Fulfillment Hours Additivity: total == sum(stages) (tol 0.05h)": 1}),
    (lambda s, k: change(s, FOF, f"fulfillment_key = {k}", total_fulfillment_hours=F.lit("6.05")), {}),
    (lambda s, k: change(s, FOF, f"fulfillment_key = {k}", total_fulfillment_hours=9, hours_to_carrier=None), {}),
    (lambda s, k: change(s, FOF, f"fulfillment_key = {k}", review_score=6), {"Review Score Range: 1 <= review_score <= 5": 1}),
    (lambda s, k: change(s, FOF, f"fulfillment_key = {k}", order_status="odd"), {"Valid order_status Domain": 1}),
    (lambda s, k: change(s, FOF, f"fulfillment_key = {k}", order_status=None),
     {"Valid order_status Domain": 1, "Mandatory Column Not Null: fact_order_fulfillment.order_status": 1}),
    (lambda s, k: change(s, FOF, f"fulfillment_key = {k}", is_on_time=False), {"On-Time Consistency: is_on_time vs days_vs_estimate": 1}),
    (lambda s, k: change(s, FOF, f"fulfillment_key = {k}", is_on_time=False, days_vs_estimate=F.lit("-0.01")), {}),
    (lambda s, k: change(s, FOF, f"fulfillment_key = {k}", payment_count=None), {"Payment Count >= 1 when total_payment_value > 0": 1}),
    (lambda s, k: change(s, FOF, f"fulfillment_key = {k}", order_purchase_date_key=20170201), {"Timeline: purchase_date_key <= approved_date_key": 1}),
    (lambda s, k: change(s, FOF, f"fulfillment_key = {k}", order_approved_date_key=20170201), {"Timeline: approved_date_key <= carrier_date_key": 1}),
    (lambda s, k: change(s, FOF, f"fulfillment_key = {k}", delivered_date_key=20170102), {"Timeline: carrier_date_key <= delivered_date_key": 1}),
    (lambda s, k: change(s, FOF, f"fulfillment_key = {k}", total_payment_value=F.lit("10.89")), {"Order Sales vs Payment Discrepancy (> 1% diff)": 1}),
    (lambda s, k: change(s, FOF, f"fulfillment_key = {k}", total_payment_value=0), {}),
    (lambda s, k: change(s, FS, f"sales_key = {k}", product_key=99), {"FK Orphan: fact_sales.product_key -> dim_product.product_key": 1}),
    (lambda s, k: change(s, FOF, f"fulfillment_key = {k}", estimated_delivery_date_key=20200101),
     {"FK Orphan: fact_order_fulfillment.estimated_delivery_date_key -> dim_date.date_key": 1}),
    (lambda s, k: change(s, FS, f"sales_key = {k}", order_id=f"o{k % 10 + 1}"), {"Fact Sales Grain Unique: (order_id, order_item_id)": 1,
                                                             "Order Sales vs Payment Discrepancy (> 1% diff)": 1}),
    (lambda s, k: change(s, FS, f"sales_key = {k}", sales_key=k % 10 + 1), {"PK Unique & Not Null: fact_sales.sales_key": 1}),
    (lambda s, k: change(s, "dim_customer", f"customer_key = {k}", zip_code_prefix="1"), {"Zip Code Length == 5: dim_customer.zip_code_prefix": 1}),
    (lambda s, k: change(s, "dim_seller", f"seller_key = {k}", seller_state="RJX"), {"State Code Length == 2: dim_seller.seller_state": 1}),
    (lambda s, k: change(s, "dim_product", f"product_key = {k}", category_name=" cat"), {"No Untrimmed Spaces: dim_product.category_name": 1}),
]

CALENDAR_DEFECTS = [
    (lambda s: {**s, "dim_date": s["dim_date"].filter("full_date != date'2017-06-01'")}, {"No Calendar Gaps in dim_date (full_date continuous)": 1}),
    (lambda s: change(s, "dim_date", "date_key = 20171231", date_key=20171232), {"Date Key Format Match: date_key == YYYYMMDD(full_date)": 1}),
    (lambda s: {**s, "dim_date": s["dim_date"].filter("date_key > 20170102")},
     {"Dim Date Range Covers Fact Dates": 1, "FK Orphan: fact_sales.date_key -> dim_date.date_key": 1,
      "FK Orphan: fact_order_fulfillment.order_purchase_date_key -> dim_date.date_key": 1}),
]


def batches():
    """Defects on different rows of one star: nine at a time, on rows 1, 2, ..."""
    return [DEFECTS[i:i + 9] for i in range(0, len(DEFECTS), 9)]


@pytest.mark.parametrize("batch", batches())
def test_each_defect_flips_its_check_only(good, batch):
    star, expected = good, Counter()
    for k, (defect, checks) in enumerate(batch, start=1):
        star = defect(star, k)
        expected.update(checks)
    assert failed(star) == dict(expected)


@pytest.mark.parametrize("defect, expected", CALENDAR_DEFECTS, ids=["gap", "key", "range"])
def test_calendar_defects(good, defect, expected):
    assert failed(defect(good)) == expected


def test_null_key_counts_as_duplicate_and_null(good):
    # keys 1, 1, NULL: 3 - 1 duplicates plus 1 NULL
    three = good[FS].filter("sales_key <= 3")
    star = change({**good, FS: three}, FS, "sales_key = 2", sales_key=1)
    star = change(star, FS, "sales_key = 3", sales_key=None)
    row = audit.check_results(star, ["keys"]).filter("check_no = 5").first()
    assert (row.failed_count, row.notes) == (3, "Dups: 2, Nulls: 1")


def test_grain_counts_null_parts_as_values(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2)], "a int, b int")
    row = audit.count_grain(df, ["a", "b"], 1).first()
    assert (row.total_evaluated, row.failed_count) == (3, 1)


def test_empty_facts_report_every_check(good):
    star = {**good, FS: good[FS].filter("false"), FOF: good[FOF].filter("false")}
    rows = audit.check_results(star).collect()
    assert len(rows) == 72
    assert {r.name for r in rows if r.failed_count} == {"Dim Date Range Covers Fact Dates"}


def test_violation_rows_match_counts(good):
    star = change(good, FOF, "fulfillment_key <= 4", order_status=None, payment_count=0)
    counts = failed(star)
    for check in audit.catalogue():
        if check.name in counts:
            assert check.violations(star).count() == counts[check.name]


def test_reconciliation_percent(spark, good):
    star = change(change(good, FOF, "fulfillment_key = 1", total_payment_value=F.lit("126.12")), FS, "sales_key = 1", sales_amount=F.lit("177.74"))
    star = change(change(star, FOF, "fulfillment_key = 2", total_payment_value=F.lit("25.14")), FS, "sales_key = 2", sales_amount=F.lit("35.14"))
    rows = audit.reconciliation_rows(star).collect()
    assert [(r.order_id, r.diff_amount, r.diff_percent) for r in rows] == [("o1", D("51.62"), D("40.93")), ("o2", D("10.00"), D("39.78"))]


def test_null_profile(good):
    star = change(good, "dim_product", "product_key <= 3", category_name=None)
    rows = {(r.table_name, r.column_name): r for r in audit.null_profile(star).collect()}
    assert len(rows) == 60 and sum(r.is_mandatory for r in rows.values()) == 32
    assert rows["dim_product", "category_name"].null_pct == 30.0


def test_assertion_suites(good):
    assert [r.failed_rows for r in audit.warehouse_tests(good).collect()] == [0] * 29
    star = repeat(change(good, FS, "sales_key = 1", sales_amount=None), FOF, "fulfillment_key = 1")
    bad = {r.test_name: r.failed_rows for r in audit.warehouse_tests(star).filter("failed_rows > 0").collect()}
    assert bad == {"invalid_sales_amount": 1, "duplicate_fulfillment_order_id": 1}


def test_staging_suite(spark):
    views = clean_views(raw_shop(spark))
    assert {r.test_name: r.failed_rows for r in audit.staging_tests(views).collect()} == {
        "vw_customers_empty": 0, "vw_orders_empty": 0, "orders_null_order_id": 1, "duplicate_orders": 0, "duplicate_order_items": 0}


def test_source_reconciliation(spark):
    from starloom.plans.star import build_lazy

    raw = raw_shop(spark)
    r = audit.source_reconciliation(raw, build_lazy(spark, clean_views(raw))).first()
    # lost has no order; no item's order lacks its customer record; o5 belongs to a blank person
    assert (r.orphan_orders, r.orphan_customers, r.orphan_dim_customer) == (1, 0, 1)


def test_status_note(good):
    star = change(good, FOF, "fulfillment_key <= 3", order_status="shipped")
    note = next(r.notes for r in audit.check_results(star, ["rules"]).collect() if r.check_no == 55)
    assert note == "Distinct values: 2, with their counts in business_order_status_counts.csv"
    assert {r.order_status: r.order_count for r in audit.status_counts(star).collect()} == {"delivered": 7, "shipped": 3}


def test_check_sets_read_facts_few_times(spark, good, tmp_path):
    star = {}
    for name, df in good.items():  # stored, so that the plan shows scans
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}")
        star[name] = spark.read.schema(df.schema).parquet(f"{tmp_path}/{name}")
    raw = {t: spark.createDataFrame([], "order_id string, order_item_id string") for t in ("order_items", "orders")}
    # the checks read each fact's own key once more, alone, for its bitmaps
    for df, most in ((audit.check_results(star), 5), (audit.warehouse_tests(star), 3), (audit.prepublish(raw, star), 3)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        for key in ("sales_key", "fulfillment_key"):
            assert 1 <= plan.count(f"Relation [{key}#") <= most, (key, plan.count(f"Relation [{key}#"))


def test_reports_hold_every_orphan(spark, good, tmp_path):
    lost = good["fact_sales"].limit(1).drop("customer_key").crossJoin(spark.range(12_000).select((-F.col("id") - 1).alias("customer_key")))
    star = {**good, "fact_sales": good["fact_sales"].unionByName(lost.select(*good["fact_sales"].columns))}
    name = audit.generated("fk", "fact_sales", "customer_key", "dim_customer")[0]
    audit.write_reports(star, {name}, str(tmp_path))
    assert spark.read.option("header", True).csv(f"{tmp_path}/fk_orphans_fact_sales_customer_key.csv").count() == 12_000
