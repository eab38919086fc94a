"""Headline timings: star build and publish, audit, metrics and analyses. Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from starloom.session import session
from starloom.workload.live import live_star
from starloom.workload.queries import QUERIES

HEADLINE = [
    "j2_dim_customer", "j3_dim_product", "j9_fact_sales", "j10_fact_order_fulfillment", "c1_modal_row", "c2_latest_row", "c3_duplicate_keys",
    "k5_null_profile", "k20_reconciliation_rows", "k21_verdict", "k26_warehouse_tests",
    "l1_total_revenue", "l2_monthly_revenue", "l3_total_orders", "l4_delivery_success", "l5_orders_by_weekday", "l6_top_categories",
    "l7_category_performance", "l8_average_price", "l9_total_customers", "l10_customers_by_state", "l11_customers_by_city",
    "l12_repeat_customers", "l13_average_review", "l14_on_time_rate", "l15_delivery_day_vs_review", "l16_transit_days_by_state",
    "m3_city_share", "m4_on_time_vs_late", "m5_trend_line", "n1_monthly_trend", "n2_sla_by_state", "n3_purchase_segments", "n4_category_reviews",
    "n6_delivery_sla_by_state", "n8_sales_growth", "n9_rfm_scores", "n10_category_pareto", "n11_seller_performance",
    "n13_seller_concentration", "n14_cohorts", "n15_rfm_segments", "f6_running_total",
]


def scale_of(sf_dir: str) -> float | str:
    label = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    try:
        return float(label)
    except ValueError:
        return label


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session("starloom-bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="starloom-bench-")})  # a local master: the driver's disk is the executors'
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the engine before the clock
    timings: dict[str, float] = {}

    start = time.time()
    live_star(spark, sf_dir)
    timings["build_audit_publish_star"] = round(time.time() - start, 3)
    for name in HEADLINE:
        start = time.time()
        # noop runs every row and column to the end without moving them to the driver
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.time() - start, 3)
    result = {"metric": "total_seconds", "value": round(sum(timings.values()), 3), "unit": "sec", "queries": timings,
              "sf": scale_of(sf_dir)}
    print(json.dumps(result))
    sys.stdout.flush()
    spark.stop()


if __name__ == "__main__":
    main()
