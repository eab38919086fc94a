"""Served metrics over the star.

Every join between a fact and a dimension runs on rows already grouped by the foreign key, so a
popular product or customer is combined before the shuffle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions import exact_avg, pct, place_label, title_case, weighted_mean
from starloom.operators.calendar import calendar_columns, gap_fill, month_spine
from starloom.operators.joins import rollup_via, share_of_total
from starloom.operators.ordering import top_k
from starloom.schemas import MONEY, MONTH_PARTITION

Star = Mapping[str, DataFrame]


def _zero() -> Column:
    return F.lit(0).cast(MONEY)


def _in_months(fact: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Keep the fact's month folders between two dates, where the table is laid out by month."""
    if MONTH_PARTITION not in fact.columns:
        return fact
    return fact.filter(F.col(MONTH_PARTITION).between(first.year * 100 + first.month, last.year * 100 + last.month))


# --- Overview ---------------------------------------------------------------------------------------


def total_revenue(star: Star) -> DataFrame:
    """Sum of item sales; 0 for an empty fact."""
    return star["fact_sales"].agg(F.round(F.coalesce(F.sum("sales_amount"), _zero()), 2).alias("total_revenue"))


def monthly_revenue(star: Star, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """Revenue per month on a gap-filled spine: the calendar's months, or those from first's to last's.

    Sales without a calendar day, or in a month outside a given range, are left out.
    """
    if first is None or last is None:
        ends = star["dim_date"].agg(F.min("full_date"), F.max("full_date")).first()
        first, last = first or ends[0] or dt.date(1970, 1, 1), last or ends[1] or dt.date(1970, 1, 1)
    sales = _in_months(star["fact_sales"], first, last).filter(F.col("sales_amount").isNotNull())
    daily = rollup_via(sales, "date_key", {"v": F.sum("sales_amount")}, star["dim_date"], ["full_date"])
    monthly = daily.groupBy(F.trunc("full_date", "MM").alias("month_start")).agg(F.sum("v").alias("total_revenue"))
    spine = month_spine(star["fact_sales"].sparkSession, first, last)
    filled = gap_fill(spine, monthly, "month_start", {"total_revenue": 0})
    return filled.select(
        "month_start", F.date_format("month_start", "yyyy-MM").alias("year_month"),
        F.round("total_revenue", 2).alias("total_revenue"),
    ).orderBy("month_start")


def total_orders(star: Star) -> DataFrame:
    return star["fact_order_fulfillment"].agg(F.count_distinct("order_id").alias("total_orders"))


def delivery_success(star: Star) -> DataFrame:
    """Share of delivered orders; NULL for an empty fact."""
    delivered = F.count_if(F.col("order_status") == "delivered")
    return star["fact_order_fulfillment"].agg(
        F.count(F.lit(1)).alias("total_orders"), delivered.alias("delivered_orders")
    ).withColumn("delivery_success_rate_pct", pct("delivered_orders", "total_orders"))


def orders_by_weekday(star: Star) -> DataFrame:
    """Orders with items per weekday, Monday first; weekdays without sales stay, with 0."""
    days = calendar_columns(star, "day_of_week", "day_name")
    counted = star["fact_sales"].select("date_key", "order_id").join(days, "date_key").groupBy("day_of_week", "day_name").agg(F.count_distinct("order_id").alias("total_orders"))
    weekdays = star["dim_date"].select("day_of_week", "day_name").distinct()
    filled = weekdays.join(counted, ["day_of_week", "day_name"], "left").select(
        "day_of_week", "day_name", F.coalesce("total_orders", F.lit(0)).cast("bigint").alias("total_orders"))
    return filled.orderBy(F.when(F.col("day_of_week") == 1, 8).otherwise(F.col("day_of_week")))


# --- Products ---------------------------------------------------------------------------------------


def _by_category(star: Star, partials: dict[str, Column]) -> DataFrame:
    grouped = rollup_via(star["fact_sales"], "product_key", partials, star["dim_product"], ["category_name_english"])
    return grouped.withColumnRenamed("category_name_english", "category")


def category_performance(star: Star) -> DataFrame:
    """Revenue and items sold per category."""
    grouped = _by_category(star, {"v": F.sum("sales_amount"), "n": F.count("order_item_id")})
    return grouped.filter(F.col("category").isNotNull()).groupBy("category").agg(
        F.round(F.coalesce(F.sum("v"), _zero()), 2).alias("total_revenue"), F.sum("n").alias("total_quantity"))


def top_categories_by_revenue(star: Star, k: int = 10) -> DataFrame:
    """The k categories with the highest revenue; a NULL category may appear."""
    grouped = _by_category(star, {"v": F.sum("sales_amount")}).groupBy("category").agg(F.sum("v").alias("_sum"))
    best = top_k(grouped, [F.col("_sum").desc_nulls_first(), F.col("category").asc_nulls_last()], k)
    return best.select("category", F.round(F.coalesce("_sum", _zero()), 2).alias("total_revenue"))


def average_price_by_category(star: Star) -> DataFrame:
    """Mean item price per category, ordered on the rounded value."""
    grouped = _by_category(star, {"v": F.sum("price"), "n": F.count("price")})
    mean = F.round(F.sum("v") / F.nullif(F.sum("n"), F.lit(0).cast("bigint")).cast("decimal(20,0)"), 2)
    out = grouped.filter(F.col("category").isNotNull()).groupBy("category").agg(mean.alias("avg_price"))
    return out.orderBy(F.col("avg_price").desc_nulls_first(), "category")


SORTABLE = {"revenue": "total_revenue", "quantity": "total_quantity", "customers": "total_customers"}


def sorted_table(df: DataFrame, name: str, sort_by: str, k: int | None = 10) -> DataFrame:
    """A page table: sorted by a measure (largest first) or by 'name', numbered from 1, first k rows or all (k=None)."""
    names = [F.col(c).asc_nulls_last() for c in ([name] if isinstance(name, str) else name)]
    order = names if sort_by == "name" else [F.col(SORTABLE[sort_by]).desc_nulls_first(), *names]
    if k is not None:
        return top_k(df, order, k, rank_as="rank_no")
    # a page table has a row per group, so a plain sort numbers it
    return df.select(F.row_number().over(Window.orderBy(*order)).cast("bigint").alias("rank_no"), *df.columns).orderBy("rank_no")


def top_categories(star: Star, metric: str = "revenue", k: int | None = 10) -> DataFrame:
    """Category table sorted by 'revenue', 'quantity' or 'name'."""
    return sorted_table(category_performance(star), "category", metric, k)


# --- Customers --------------------------------------------------------------------------------------


def total_customers(star: Star) -> DataFrame:
    return star["dim_customer"].agg(F.count_distinct("customer_unique_id").alias("total_customers"))


def customers_by_state(star: Star) -> DataFrame:
    out = star["dim_customer"].filter(F.col("customer_state").isNotNull()).groupBy(F.col("customer_state").alias("state")).agg(
        F.count_distinct("customer_unique_id").alias("total_customers"))
    return out.orderBy(F.desc("total_customers"), "state")


def customers_by_city(star: Star) -> DataFrame:
    """Groups on the stored city and shows it capitalised, so two groups may show one label."""
    grouped = star["dim_customer"].filter(F.col("customer_city").isNotNull()).groupBy("customer_city", "customer_state").agg(
        F.count_distinct("customer_unique_id").alias("total_customers"))
    shown = grouped.select(title_case("customer_city").alias("city"), F.col("customer_state").alias("state"), "total_customers")
    return shown.orderBy(F.desc("total_customers"), "city", "state")


def orders_per_customer(star: Star) -> DataFrame:
    """(customer_unique_id, order_count). The order fact has one row per order, which publishing checks."""
    per_key = star["fact_order_fulfillment"].groupBy("customer_key").agg(F.count(F.lit(1)).alias("order_count"))
    return per_key.join(star["dim_customer"].select("customer_key", "customer_unique_id"), "customer_key").groupBy(
        "customer_unique_id").agg(F.sum("order_count").alias("order_count"))


def repeat_customers(star: Star) -> DataFrame:
    """Customers with one order and with more than one (each customer is one row here)."""
    return orders_per_customer(star).agg(
        F.count_if(F.col("order_count") == 1).alias("one_time_customers"),
        F.count_if(F.col("order_count") > 1).alias("repeat_customers"))


def repeat_rate(star: Star) -> DataFrame:
    """Repeat customers as a share of all buying customers; 0 when there are none."""
    total = F.col("one_time_customers") + F.col("repeat_customers")
    return repeat_customers(star).select(
        "one_time_customers", "repeat_customers",
        F.coalesce(pct("repeat_customers", total), F.lit(0).cast("decimal(5,2)")).alias("repeat_rate_pct"))


def customer_segment_share(star: Star) -> DataFrame:
    """One-time and repeat customers as two rows with their shares."""
    parts = F.array(
        F.struct(F.lit("One-time").alias("segment"), F.col("one_time_customers").alias("customers")),
        F.struct(F.lit("Repeat").alias("segment"), F.col("repeat_customers").alias("customers")))
    both = F.col("one_time_customers") + F.col("repeat_customers")
    rows = repeat_customers(star).select(both.alias("_all"), F.explode(parts).alias("p")).select("_all", "p.*")
    return rows.select("segment", "customers", pct("customers", "_all").alias("share_pct"))


def state_share(star: Star, sort_by: str = "customers", k: int | None = None) -> DataFrame:
    """State table with share of all customers, numbered."""
    shared = share_of_total(customers_by_state(star), "total_customers", "share_pct")
    return sorted_table(shared, "state", sort_by, k)


def city_share(star: Star, sort_by: str = "customers", k: int | None = 10) -> DataFrame:
    """City table with share of all customers and a 'city (state)' label; shares are of all cities, also for a top k."""
    shared = share_of_total(customers_by_city(star), "total_customers", "share_pct")
    labelled = shared.withColumn("city_label", place_label("city", "state"))
    return sorted_table(labelled, ["city", "state"], sort_by, k)


# --- Service quality --------------------------------------------------------------------------------


def average_review_score(star: Star) -> DataFrame:
    return star["fact_order_fulfillment"].agg(exact_avg("review_score", 2).alias("avg_review_score"))


def on_time_rate_all_orders(star: Star) -> DataFrame:
    """On-time orders over all orders, delivered or not; NULL for an empty fact."""
    counts = star["fact_order_fulfillment"].agg(F.count_if("is_on_time").alias("hit"), F.count(F.lit(1)).alias("n"))
    return counts.select(pct("hit", "n").alias("on_time_rate_pct"))


def delivery_day_vs_review(star: Star, max_days: int | None = None) -> DataFrame:
    """Mean score and orders per delivery status and rounded day; a day limit, if given, applies before rounding.

    An unknown on-time flag counts as Late.
    """
    days = F.col("total_fulfillment_hours") / F.lit(24).cast("decimal(2,0)")
    wanted = days >= 0 if max_days is None else days.between(0, max_days)
    kept = star["fact_order_fulfillment"].filter(F.col("review_score").isNotNull() & wanted)
    status = F.when(F.col("is_on_time"), "On Time").otherwise("Late")
    return kept.groupBy(status.alias("delivery_status"), F.round(days, 0).alias("delivery_day")).agg(
        exact_avg("review_score", 2).alias("avg_review_score"), F.count(F.lit(1)).alias("order_count")
    ).orderBy("delivery_day", "delivery_status")


def transit_days_by_state(star: Star) -> DataFrame:
    """Mean carrier-to-customer days and orders per customer state, delivered orders only."""
    delivered = star["fact_order_fulfillment"].filter((F.col("order_status") == "delivered") & F.col("hours_to_customer").isNotNull())
    grouped = rollup_via(delivered, "customer_key", {"h": F.sum("hours_to_customer"), "n": F.count(F.lit(1))},
                         star["dim_customer"], ["customer_state"])
    days = F.sum("h") / (F.sum("n").cast("decimal(20,0)") * F.lit(24).cast("decimal(2,0)"))
    out = grouped.groupBy("customer_state").agg(F.round(days, 2).alias("avg_delivery_days"), F.sum("n").alias("delivered_orders"))
    return out.orderBy(F.col("avg_delivery_days").desc_nulls_first(), "customer_state")


def on_time_vs_late(star: Star, max_days: int | None = None) -> DataFrame:
    """Orders, share, and order-weighted mean day and score per delivery status, from the rounded day rows."""
    grouped = delivery_day_vs_review(star, max_days).groupBy("delivery_status").agg(
        F.sum("order_count").alias("order_count"),
        weighted_mean(F.col("delivery_day").cast("decimal(10,2)"), F.col("order_count").cast("decimal(18,0)")).alias("_day"),
        weighted_mean(F.col("avg_review_score").cast("decimal(10,2)"), F.col("order_count").cast("decimal(18,0)")).alias("_score"))
    both = F.sum("order_count").over(Window.partitionBy())  # two rows
    shared = grouped.withColumn("share_pct", pct("order_count", both))
    return shared.select("delivery_status", "order_count", "share_pct", F.round("_day", 1).alias("avg_delivery_day"),
                         F.round("_score", 2).alias("avg_review_score"))


def review_trend_line(star: Star, at: tuple[float, ...] = (1.0, 5.0), max_days: int | None = None) -> DataFrame:
    """Least-squares line of delivery day on score over the day rows; its points at the given scores.

    No rows with fewer than two points.
    """
    points = delivery_day_vs_review(star, max_days).select(F.col("avg_review_score").cast("double").alias("x"), F.col("delivery_day").cast("double").alias("y"))
    line = points.agg(F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept"), F.count(F.lit(1)).alias("n"))
    ends = line.filter("n > 1").select("slope", "intercept", F.explode(F.array(*[F.lit(x) for x in at])).alias("review_score"))
    return ends.select("review_score", (F.col("slope") * F.col("review_score") + F.col("intercept")).alias("delivery_day"))


def to_number(col: str) -> Column:
    """Chart feed: text that is no number counts as 0."""
    return F.coalesce(F.col(col).try_cast("double"), F.lit(0.0))

