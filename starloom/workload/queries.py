"""Registered queries: name -> function of (session, data folder) returning a DataFrame.

Queries on clean views, joins and builders derive from the raw feed lazily. Metrics, analyses and
checks read the published star, as a warehouse's users do.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping
from functools import partial
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions import blank_to_null, exact_avg, place_label, safe_div, title_case
from starloom.jobs import together
from starloom.operators import calendar as calendars
from starloom.operators.dedup import duplicate_keys, latest_row, modal_row
from starloom.operators.durable import shared_folder, shuffles_removed
from starloom.operators.joins import orphan_rows, rollup_via
from starloom.operators.keys import row_keys
from starloom.operators.ordering import ntile, ordered, top_k
from starloom.plans import analysis, audit, clean, metrics, publish
from starloom.plans import star as builders
from starloom.schemas import star_columns
from starloom.plans.run import run
from starloom.sources import files
from starloom.sources.extracts import read_extracts, read_staging, write_staging
from starloom.sources.sql import run_query, run_suite
from starloom.workload.feed import feed_views, line_amounts, raw_feed
from starloom.workload.live import live_raw, live_star

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

SPLIT_KEY = 19980701


def portable(df: DataFrame) -> DataFrame:
    """Types both engines report alike: BIGINT, DOUBLE, STRING, BOOLEAN."""
    def cast(field: T.StructField) -> Column:
        col, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            col = col.cast("bigint")
        elif isinstance(kind, (T.DecimalType, T.FloatType)):
            col = col.cast("double")
        elif isinstance(kind, (T.DateType, T.TimestampNTZType)):
            col = col.cast("string")
        return col.alias(field.name)

    return df.select([cast(f) for f in df.schema.fields])


def register(name: str) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: portable(fn(spark, sf_dir))
        return fn

    return add


def on_star(name: str, plan: Callable[[Mapping[str, DataFrame]], DataFrame]) -> None:
    register(name)(lambda spark, sf_dir: plan(live_star(spark, sf_dir)))


def on_views(name: str, plan: Callable[[Mapping[str, DataFrame]], DataFrame]) -> None:
    register(name)(lambda spark, sf_dir: plan(feed_views(spark, sf_dir)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- A: sources, sinks, lifecycle ---------------------------------------------------------------------


def _write_extracts(raw: Mapping[str, DataFrame], tables: list[str], folder: str) -> None:
    """Raw tables as CSV extracts, written side by side."""
    def write(name: str) -> None:
        suffix = "" if name.endswith("translation") else "_dataset"
        raw[name].write.option("header", True).option("escape", '"').csv(f"{folder}/retail_{name}{suffix}.csv")

    with shuffles_removed(raw[tables[0]].sparkSession):
        together(*[partial(write, name) for name in tables])


def _csv_extracts(spark: SparkSession, sf_dir: str, tables: list[str]) -> dict[str, DataFrame]:
    """Write raw tables as CSV extracts, then read them as a folder; tables not written stay empty."""
    folder = f"{shared_folder(spark)}/starloom/{spark.sparkContext.applicationId}/extracts-{uuid.uuid4().hex}"
    _write_extracts(raw_feed(spark, sf_dir), tables, folder)
    return read_extracts(spark, folder)


@register("a1_csv_scan_reviews")
def _(spark, sf_dir):
    reviews = _csv_extracts(spark, sf_dir, ["order_reviews"])["order_reviews"]
    return reviews.select("review_id", "order_id", blank_to_null("review_score").alias("review_score"),
                          "review_comment_message", "review_creation_date", "review_answer_timestamp")


@register("a2_extract_with_bom")
def _(spark, sf_dir):
    folder = f"{shared_folder(spark)}/starloom/{spark.sparkContext.applicationId}/extracts-{uuid.uuid4().hex}"
    orders = raw_feed(spark, sf_dir)["orders"]
    marked = orders.withColumnRenamed(orders.columns[0], "\ufeff" + orders.columns[0])  # each file then begins with the mark
    marked.write.option("header", True).option("escape", '"').csv(f"{folder}/retail_orders_dataset.csv")
    return read_extracts(spark, folder)["orders"].groupBy("order_status").agg(F.count(F.lit(1)).alias("orders"), F.min("order_id").alias("first_order"))


@register("a6_full_refresh")
def _(spark, sf_dir):
    """A second refresh replaces the first: the live version holds the feed, once."""
    folder = f"{shared_folder(spark)}/starloom/{spark.sparkContext.applicationId}/refresh-{uuid.uuid4().hex}"
    raw = {name: raw_feed(spark, sf_dir)[name] for name in ("orders", "order_payments", "sellers")}
    write_staging(spark, {name: df.unionByName(df) for name, df in raw.items()}, folder)
    write_staging(spark, raw, folder)
    live = read_staging(spark, folder)
    return publish.version_rows({name: live[name] for name in raw})


@register("a14_staged_run")
def _(spark, sf_dir):
    """All stages from CSV extracts to the report; its check rows by status."""
    home = f"{shared_folder(spark)}/starloom/{spark.sparkContext.applicationId}/run-{uuid.uuid4().hex}"
    raw = raw_feed(spark, sf_dir)
    _write_extracts(raw, list(raw), f"{home}/extracts")
    run(spark, f"{home}/extracts", home, ("staging",))
    files.delete(spark, f"{home}/extracts")  # staged, and not read again
    report = run(spark, f"{home}/extracts", home, ("warehouse", "validation"))
    rows = [(c.check_no, c.name, c.total_evaluated, c.failed_count, c.status) for c in report.checks]
    return spark.createDataFrame(rows, "check_no int, name string, total_evaluated bigint, failed_count bigint, status string")


@register("a4_extract_row_counts")
def _(spark, sf_dir):
    written = ["customers", "orders", "order_items", "order_payments", "products", "sellers", "geolocation",
               "product_category_name_translation"]
    raw = _csv_extracts(spark, sf_dir, written)
    return publish.version_rows(raw)


@register("a7_typed_tables")
def _(spark, sf_dir):
    sales = live_star(spark, sf_dir)["fact_sales"]
    return sales.groupBy("purchase_month").agg(F.count(F.lit(1)).alias("total_rows"), F.sum("sales_amount").alias("sales_amount"))


on_star("a8_published_star", publish.version_rows)


@register("a9_view_layer")
def _(spark, sf_dir):
    clean.clean_views(raw_feed(spark, sf_dir), register=True)
    return spark.sql(
        "SELECT o.order_status, count(*) AS orders, count(p.order_id) AS paid_orders, sum(p.total_payment_value) AS paid "
        "FROM vw_orders o LEFT JOIN vw_order_payments_agg p ON o.order_id = p.order_id GROUP BY o.order_status")


on_star("a10_violation_rows", lambda star: _violations(star, "Timeline: carrier_date_key <= delivered_date_key"))


def _violations(star: Mapping[str, DataFrame], name: str) -> DataFrame:
    return next(c for c in audit.catalogue() if c.name == name).violations(star)


@register("a12_parameter_query")
def _(spark, sf_dir):
    return run_query(
        spark,
        "SELECT c.customer_state, count(*) AS orders, sum(f.total_payment_value) AS paid "
        "FROM fact_order_fulfillment f JOIN dim_customer c ON f.customer_key = c.customer_key "
        "WHERE f.order_status = :status AND f.order_purchase_date_key >= :since GROUP BY c.customer_state",
        {"status": "delivered", "since": 19970101}, live_star(spark, sf_dir))


@register("a13_sql_suite")
def _(spark, sf_dir):
    suite = Path(__file__).parent.parent / "sql" / "staging_tests.sql"
    result = run_suite(spark, "staging", suite, feed_views(spark, sf_dir))
    if result.error:
        raise RuntimeError(result.error)
    return spark.createDataFrame(result.tests, "test_name string, failed_rows bigint")


# --- B: projections, casts, predicates ----------------------------------------------------------------

on_views("b1_orders_typed", lambda v: v["vw_orders"])
on_views("b2_products_typed", lambda v: v["vw_products"])
on_views("b3_items_typed", lambda v: v["vw_order_items"])
on_views("b4_customers_trimmed", lambda v: v["vw_customers"])
on_views("b5_sellers_trimmed", lambda v: v["vw_sellers"])
on_views("b6_category_fallback", lambda v: v["vw_products"].groupBy("category_name_english").agg(
    F.count(F.lit(1)).alias("products"), F.count("category_name").alias("named")))
on_views("b7_null_safe_amount", lambda v: v["vw_order_items"].select("order_id", "order_item_id", (
    F.coalesce("price", F.lit(0)) + F.coalesce("freight_value", F.lit(0))).alias("sales_amount")))
on_views("b8_lifecycle_measures", lambda v: builders.lifecycle_measures(v["vw_orders"]).select(
    "order_id", "hours_to_approval", "hours_to_carrier", "hours_to_customer", "total_fulfillment_hours", "days_vs_estimate", "is_on_time"))


@register("b11_predicates")
def _(spark, sf_dir):
    f = live_star(spark, sf_dir)["fact_order_fulfillment"]
    return f.filter(
        F.col("review_score").between(1, 4) & F.col("order_status").isin("delivered", "shipped", "lost")
        & ~F.col("order_id").isin("3", "6") & F.col("customer_key").isNotNull() & (F.col("order_purchase_date_key") >= 19960101)
    ).groupBy("order_status", "review_score").agg(F.count(F.lit(1)).alias("orders"))


on_star("b12_null_safe_difference", lambda star: star["fact_sales"].filter(~F.col("price").eqNullSafe(F.col("sales_amount"))).groupBy(
    F.isnull("price").alias("price_missing")).agg(F.count(F.lit(1)).alias("items"), F.sum("sales_amount").alias("sales_amount")))
on_star("b13_status_label", lambda star: star["fact_order_fulfillment"].groupBy(
    F.when(F.col("is_on_time"), "On Time").otherwise("Late").alias("delivery_status")).agg(F.count(F.lit(1)).alias("orders")))
on_star("b14_size_buckets", lambda star: star["dim_product"].groupBy(analysis.size_bucket("weight").alias("weight"), analysis.size_bucket("photos").alias("photos")).agg(
    F.count(F.lit(1)).alias("products")))

# --- C: deduplication -----------------------------------------------------------------------------------


@register("c1_modal_row")
def _(spark, sf_dir):
    return modal_row(table(spark, sf_dir, "events"), "user_id", ["event_type"])


@register("c2_latest_row")
def _(spark, sf_dir):
    return latest_row(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], ["event_id", "event_type", "value"])


@register("c3_duplicate_keys")
def _(spark, sf_dir):
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


# --- D: joins -------------------------------------------------------------------------------------------

on_views("d1_lookup_join", lambda v: v["vw_products"].select("product_id", "category_name", "category_name_english"))


@register("d2_key_resolution")
def _(spark, sf_dir):
    views = feed_views(spark, sf_dir)
    people = builders.dim_customer(views["vw_customers"])
    keys = builders.customer_keys(views["vw_customers"], people)
    orders = views["vw_orders"].select("order_id", "customer_id")
    return views["vw_order_items"].select("order_id", "order_item_id").join(orders, "order_id", "left").join(
        keys, "customer_id", "left").select("order_id", "order_item_id", "customer_key")


@register("d3_role_playing_join")
def _(spark, sf_dir):
    orders = feed_views(spark, sf_dir)["vw_orders"]
    days = builders.dim_date(spark, builders.Calendar(dt.date(1996, 1, 1), dt.date(2000, 12, 31)))
    return builders.role_keys_by_join(orders, days).select("order_id", *builders.DATE_ROLES)


on_star("d4_fact_to_dimension", lambda star: rollup_via(
    star["fact_sales"], "seller_key", {"v": F.sum("sales_amount"), "n": F.count(F.lit(1))}, star["dim_seller"], ["seller_state"]
).groupBy("seller_state").agg(F.sum("v").alias("sales_amount"), F.sum("n").alias("items")))


@register("d7_anti_join")
def _(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey")
    return orphan_rows(table(spark, sf_dir, "orders"), "o_orderkey", lines, "l_orderkey").select("o_orderkey", "o_custkey", "o_totalprice")


@register("d8_two_totals")
def _(spark, sf_dir):
    f = live_star(spark, sf_dir)["fact_order_fulfillment"]
    return f.agg(F.count_if("is_on_time").alias("on_time_orders"), F.count(F.lit(1)).alias("total_orders"))


@register("d10_calendar_gaps")
def _(spark, sf_dir):
    groups = [F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status")]
    days = table(spark, sf_dir, "orders").select(*groups, F.to_date("o_orderdate").alias("day")).distinct()
    return calendars.missing_days(days, "day", ["priority", "status"])


# --- E: aggregations --------------------------------------------------------------------------------------

on_star("e1_global_aggregates", lambda star: star["fact_sales"].agg(
    F.count(F.lit(1)).alias("items"), F.sum("sales_amount").alias("total"), F.min("price").alias("lowest"),
    F.max("price").alias("highest"), exact_avg("price", 2).alias("mean")))
on_views("e2_grouped_payments", lambda v: v["vw_order_payments_agg"])
on_star("e3_distinct_counts", lambda star: star["fact_sales"].groupBy("date_key").agg(
    F.count_distinct("order_id").alias("orders"), F.count_distinct("product_key").alias("products")))


@register("e4_distinct_row_values")
def _(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    pair = F.struct(F.when(F.col("l_returnflag") != "N", F.col("l_orderkey")).alias("a"), F.col("l_linenumber").alias("b"))
    return lines.agg(F.count(F.lit(1)).alias("total_rows"), F.count_distinct(pair).alias("distinct_pairs"))


on_star("e5_filtered_aggregates", lambda star: star["fact_order_fulfillment"].groupBy("order_status").agg(
    F.count_if("is_on_time").alias("on_time"), F.count_if(~F.col("is_on_time")).alias("late"),
    F.sum(F.when(F.col("is_on_time"), F.col("total_payment_value"))).alias("on_time_paid")))
on_star("e6_filtered_distinct", lambda star: star["fact_order_fulfillment"].agg(
    F.count_distinct(F.when(F.col("order_status") == "delivered", F.col("customer_key"))).alias("delivered_customers"),
    F.count_distinct(F.when(F.col("order_status") == "canceled", F.col("customer_key"))).alias("canceled_customers")))
on_star("e7_having", lambda star: star["fact_sales"].groupBy("order_id").agg(F.sum("sales_amount").alias("total"), F.count(F.lit(1)).alias("items")).filter(
    (F.col("items") >= 5) & (F.col("total") > 300000)))
on_star("e8_group_by_expression", lambda star: star["fact_order_fulfillment"].filter(F.col("total_fulfillment_hours").isNotNull()).groupBy(
    F.round(F.col("total_fulfillment_hours") / F.lit(24).cast("decimal(2,0)"), 0).alias("days")).agg(F.count(F.lit(1)).alias("orders")))
on_star("e9_orders_histogram", lambda star: metrics.orders_per_customer(star).groupBy("order_count").agg(F.count(F.lit(1)).alias("customers")))
on_star("e13_status_counts", audit.status_counts)
on_star("e14_duration_percentiles", analysis.duration_percentiles)
on_star("e15_delay_score_correlation", lambda star: analysis.delay_score_correlation(star).select(F.round("corr_delay_score", 6).alias("corr_delay_score")))

# --- F, G: windows, order, top-k ---------------------------------------------------------------------------


@register("f4_row_numbers")
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return ordered(orders, ["-o_orderdate", "o_orderkey"], row_no="row_no").select("o_orderkey", "row_no")


@register("f6_running_total")
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", F.col("o_totalprice").cast("decimal(12,2)").alias("total"))
    return ordered(orders, ["o_orderdate", "o_orderkey"], running={"running_total": "total"}).select("o_orderkey", "running_total")


@register("f8_ntile")
def _(spark, sf_dir):
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return ntile(people, ["c_acctbal", "c_custkey"], 5, "quintile")


@register("g1_null_order")
def _(spark, sf_dir):
    f = live_star(spark, sf_dir)["fact_order_fulfillment"].select("order_id", "days_vs_estimate")
    return top_k(f, [F.col("days_vs_estimate").desc_nulls_first(), F.asc("order_id")], 50, rank_as="rank_no")


@register("g3_top_orders")
def _(spark, sf_dir):
    values = analysis.order_values(live_star(spark, sf_dir))
    return top_k(values, [F.desc("total_sales"), F.asc("order_id")], 10)


on_star("g4_violation_extract", lambda star: _violations(star, "Mandatory Column Not Null: fact_sales.price").join(
    star["fact_sales"].select("sales_key", "order_id", "order_item_id"), "sales_key").select("order_id", "order_item_id", "price"))
on_star("g5_categories_by_name", lambda star: metrics.top_categories(star, "name", None))
on_star("g5_categories_by_quantity", lambda star: metrics.top_categories(star, "quantity", 10))

# --- I: scalar functions -----------------------------------------------------------------------------------


@register("i2_title_case")
def _(spark, sf_dir):
    v = feed_views(spark, sf_dir)["vw_customers"]
    return v.groupBy(title_case("customer_city").alias("city")).agg(F.count(F.lit(1)).alias("records"))


on_star("i11_place_labels", lambda star: star["dim_seller"].groupBy(place_label("seller_city", "seller_state").alias("label")).agg(
    F.count(F.lit(1)).alias("sellers")))


@register("i12_number_or_zero")
def _(spark, sf_dir):
    text = F.regexp_extract("props", r": *([^}]*)\}", 1)
    mixed = F.when(F.col("event_id") % 10 == 0, F.col("event_type")).otherwise(text)
    events = table(spark, sf_dir, "events").select("event_type", mixed.alias("v"))
    return events.groupBy("event_type").agg(F.sum(metrics.to_number("v")).alias("total"))


@register("i13_guarded_division")
def _(spark, sf_dir):
    lines = line_amounts(table(spark, sf_dir, "lineitem"))
    per_flag = lines.groupBy("l_returnflag", "l_linenumber").agg(F.sum("freight").alias("freight"), F.sum(F.when(F.col("l_linenumber") > 1, F.col("price")).otherwise(0)).alias("price"))
    ratio = F.round(safe_div("freight", F.col("price")).cast("double"), 6)
    return per_flag.select("l_returnflag", "l_linenumber", ratio.alias("ratio"))


on_star("i14_strict_formats", lambda star: audit.strict_format_results(star).select("name", "total_evaluated", "failed_count", "status"))

# --- J: star builders --------------------------------------------------------------------------------------


@register("j1_dim_date")
def _(spark, sf_dir):
    span = table(spark, sf_dir, "orders").agg(F.min(F.to_date("o_orderdate")), F.max(F.to_date("o_orderdate"))).first()
    return builders.dim_date(spark, builders.Calendar(span[0], span[1]))


on_views("j2_dim_customer", lambda v: builders.dim_customer(v["vw_customers"]))
on_views("j3_dim_product", lambda v: builders.dim_product(v["vw_products"]))
on_views("j4_dim_seller", lambda v: builders.dim_seller(v["vw_sellers"]))


@register("j6_surrogate_keys")
def _(spark, sf_dir):
    star = live_star(spark, sf_dir)
    parts = [star[t].agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("total_rows"), F.min(k).alias("first_key"),
                         F.max(k).alias("last_key"), F.count_distinct(k).alias("distinct_keys")) for t, k in audit.PRIMARY_KEYS.items() if t != "dim_date"]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("j6_row_keys")
def _(spark, sf_dir):
    keyed = row_keys(table(spark, sf_dir, "lineitem").select("l_orderkey"), "row_key", "lineitem")
    return keyed.agg(F.count(F.lit(1)).alias("total_rows"), F.min("row_key").alias("first_key"), F.max("row_key").alias("last_key"),
                     F.count_distinct("row_key").alias("distinct_keys"))


on_views("j8_reviews_latest", lambda v: v["vw_order_reviews_latest"])


@register("j9_fact_sales")
def _(spark, sf_dir):
    return builders.build_lazy(spark, feed_views(spark, sf_dir))["fact_sales"]


@register("j10_fact_order_fulfillment")
def _(spark, sf_dir):
    return builders.build_lazy(spark, feed_views(spark, sf_dir))["fact_order_fulfillment"]


on_star("j10_published_fulfillment", lambda star: star["fact_order_fulfillment"].select(*star_columns("fact_order_fulfillment")[1:]))

# --- K: audit ------------------------------------------------------------------------------------------------

CHECK_COLUMNS = ["check_no", "category", "name", "total_evaluated", "failed_count", "severity", "error_pct", "status", "notes"]


def _checks(name: str, groups: list[str]) -> None:
    def plan(star: Mapping[str, DataFrame]) -> DataFrame:
        return audit.check_results(star, groups).withColumn("error_pct", F.round("error_pct", 6)).select(*CHECK_COLUMNS)

    on_star(name, plan)


_checks("k1_k3_key_checks", ["keys"])
_checks("k4_mandatory_columns", ["nulls"])
on_star("k5_null_profile", audit.null_profile)
_checks("k6_k12_business_rules", ["rules"])
_checks("k13_k15_formats", ["format"])
_checks("k16_date_order", ["dates"])
_checks("k17_k19_calendar", ["calendar"])
_checks("k20_reconciliation", ["recon"])
on_star("k20_reconciliation_rows", audit.reconciliation_rows)
on_star("k21_verdict", lambda star: audit.verdict(audit.check_results(star)))


@register("k2_grain_of_lines")
def _(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return audit.count_grain(lines, ["l_orderkey", "l_linenumber"], 1).select("total_evaluated", "failed_count")


@register("k22_k24_prepublish")
def _(spark, sf_dir):
    return audit.prepublish(live_raw(spark, sf_dir), live_star(spark, sf_dir))


@register("k25_source_reconciliation")
def _(spark, sf_dir):
    return audit.source_reconciliation(live_raw(spark, sf_dir), live_star(spark, sf_dir))


on_star("k26_warehouse_tests", audit.warehouse_tests)
on_views("k27_staging_tests", audit.staging_tests)

# --- L, M: served metrics --------------------------------------------------------------------------------------

on_star("l1_total_revenue", metrics.total_revenue)
on_star("l2_monthly_revenue", metrics.monthly_revenue)
on_star("l3_total_orders", metrics.total_orders)
on_star("l4_delivery_success", metrics.delivery_success)
on_star("l5_orders_by_weekday", metrics.orders_by_weekday)
on_star("l6_top_categories", metrics.top_categories_by_revenue)
on_star("l7_category_performance", metrics.category_performance)
on_star("l8_average_price", metrics.average_price_by_category)
on_star("l9_total_customers", metrics.total_customers)
on_star("l10_customers_by_state", metrics.customers_by_state)
on_star("l11_customers_by_city", metrics.customers_by_city)
on_star("l12_repeat_customers", metrics.repeat_customers)
on_star("l13_average_review", metrics.average_review_score)
on_star("l14_on_time_rate", metrics.on_time_rate_all_orders)
on_star("l15_delivery_day_vs_review", metrics.delivery_day_vs_review)
on_star("l16_transit_days_by_state", metrics.transit_days_by_state)
on_star("m1_repeat_rate", metrics.repeat_rate)
on_star("m2_segment_share", metrics.customer_segment_share)
on_star("m3_state_share", metrics.state_share)
on_star("m3_city_share", metrics.city_share)
on_star("m4_on_time_vs_late", metrics.on_time_vs_late)
on_star("m5_trend_line", lambda star: metrics.review_trend_line(star).select("review_score", F.round("delivery_day", 6).alias("delivery_day")))
on_star("m6_top_by_revenue", metrics.top_categories)

# --- N: analyses -------------------------------------------------------------------------------------------------

on_star("n1_monthly_trend", analysis.monthly_trend)
on_star("n2_sla_by_state", analysis.sla_by_state)
on_star("n3_purchase_segments", analysis.purchase_segments)
on_star("n4_category_reviews", analysis.category_sales_and_reviews)
on_star("n5_order_values", analysis.order_values)
on_star("n6_delivery_sla", lambda star: analysis.delivery_sla(star, by=None))
on_star("n6_delivery_sla_by_month", lambda star: analysis.delivery_sla(star, by="month"))
on_star("n6_delivery_sla_by_state", analysis.delivery_sla)
on_star("n7_score_distribution", analysis.score_distribution)
on_star("n7_on_time_by_purchase_month", analysis.on_time_trend)
on_star("n7_on_time_by_delivery_month", lambda star: analysis.on_time_trend(star, "delivered_date_key"))
on_star("n8_sales_growth", analysis.sales_growth)
on_star("n8_sales_by_year", lambda star: analysis.sales_by(star, "year"))
on_star("n8_sales_by_day", lambda star: analysis.sales_by(star, "day"))
on_star("n8_sales_by_quarter", lambda star: analysis.sales_by(star, "quarter"))
on_star("n8_sales_by_weekend", lambda star: analysis.sales_by(star, "weekend"))
on_star("n8_peak_days", analysis.peak_periods)
on_star("n8_peak_weeks", lambda star: analysis.peak_periods(star, "week"))
on_star("n9_customer_value", lambda star: analysis.customer_value(star))
on_star("n9_customer_summary", analysis.customer_summary)
on_star("n9_rfm_scores", analysis.rfm)
on_star("n9_revenue_by_state", analysis.revenue_by_place)
on_star("n9_revenue_by_city", lambda star: analysis.revenue_by_place(star, ("customer_city", "customer_state"), 10))
on_star("n10_category_pareto", analysis.category_pareto)
on_star("n10_weight_buckets", analysis.product_buckets)
on_star("n10_photo_buckets", lambda star: analysis.product_buckets(star, "photos"))
on_star("n10_product_correlations", lambda star: analysis.product_correlations(star).select(
    *[F.round(c, 6).alias(c) for c in ["corr_photos_items", "corr_description_items", "corr_weight_freight"]]))
on_star("n11_seller_performance", analysis.seller_performance)
on_star("n11_sellers_by_state", analysis.sellers_by_place)
on_star("n11_sellers_by_city", lambda star: analysis.sellers_by_place(star, ("seller_state", "seller_city")))
on_star("n11_route_comparison", analysis.route_comparison)
on_star("n12_average_order_value", analysis.average_order_value)
on_star("n13_seller_concentration", analysis.seller_concentration)
on_star("n14_cohorts", analysis.cohorts)
on_star("n15_rfm_segments", analysis.rfm_segments)
on_star("n16_price_drift", lambda star: analysis.price_drift(star, SPLIT_KEY, 0.0, 100000.0).withColumn("psi_part", F.round("psi_part", 9)))
on_star("n16_score_drift", lambda star: analysis.score_drift(star, SPLIT_KEY).withColumn("psi_part", F.round("psi_part", 9)))

