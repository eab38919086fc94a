"""Analyses over the star: sales, customers, products, sellers, delivery."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions import exact_avg, pct, safe_div
from starloom.operators.calendar import calendar_columns
from starloom.operators.durable import durable
from starloom.operators.joins import rollup_via, share_of_total
from starloom.operators.ordering import ntiles, ordered, top_k, weighted_percentiles

Star = Mapping[str, DataFrame]

HOURS_PER_DAY = 24


def _mean(total: Column, n: Column, digits: int, divide_by: int = 1) -> Column:
    """round(total / n / divide_by, digits) in one decimal division; NULL for n = 0."""
    den = F.nullif(n, F.lit(0).cast("bigint")).cast("decimal(20,0)") * F.lit(divide_by).cast("decimal(4,0)")
    return F.round(total.cast("decimal(26,2)") / den, digits)


# --- Sales over time --------------------------------------------------------------------------------

# Calendar columns of each reporting grain.
GRAINS = {
    "year": ["year"],
    "quarter": ["year", "quarter"],
    "month": ["year", "month"],
    "day": ["full_date"],
    "weekend": ["is_weekend"],
}


def _sales_measures(grouped_price: str = "price") -> list[Column]:
    price = F.col(grouped_price)
    return [
        F.count_distinct("order_id").alias("total_orders"),
        F.count(F.lit(1)).alias("total_items"),
        F.sum(price).alias("gmv"),
        F.sum("freight_value").alias("freight"),
        F.sum("sales_amount").alias("total_sales"),
        exact_avg("price", 2).alias("avg_price"),
        exact_avg("freight_value", 2).alias("avg_freight"),
        pct(F.sum("freight_value"), F.sum(price)).alias("freight_ratio_pct"),
    ]


def sales_by(star: Star, grain: str = "month") -> DataFrame:
    """Orders, items, revenue parts, mean prices and freight ratio per calendar grain.

    The calendar is small enough to be joined on the map side, so the one large shuffle is the
    distinct count's, on (period, order).
    """
    columns = GRAINS[grain]
    days = calendar_columns(star, *columns)
    return star["fact_sales"].join(days, "date_key").groupBy(*columns).agg(*_sales_measures())


def monthly_trend(star: Star) -> DataFrame:
    """Orders, items and revenue parts per calendar month."""
    days = calendar_columns(star, "year", "month", "month_name")
    return star["fact_sales"].join(days, "date_key").groupBy("year", "month", "month_name").agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.count(F.lit(1)).alias("total_items_sold"),
        F.sum("price").alias("total_product_revenue"),
        F.sum("freight_value").alias("total_freight_value"),
        F.sum("sales_amount").alias("total_sales_amount"),
        exact_avg("price", 2).alias("avg_item_price"),
    ).orderBy("year", "month")


def sales_growth(star: Star) -> DataFrame:
    """Monthly sales with growth on the month before and on the same month a year before; NULL where that month has no sales."""
    monthly = sales_by(star, "month")
    by_month = Window.orderBy((F.col("year") * 12 + F.col("month")).cast("int"))  # one row per calendar month
    previous, year_before = (F.first("total_sales").over(by_month.rangeBetween(-n, -n)) for n in (1, 12))
    return monthly.select(
        "*",
        pct(F.col("total_sales") - previous, previous).alias("mom_growth_pct"),
        pct(F.col("total_sales") - year_before, year_before).alias("yoy_growth_pct"),
    ).orderBy("year", "month")


def peak_periods(star: Star, grain: str = "day", k: int = 10) -> DataFrame:
    """The k days or ISO weeks with the highest sales."""
    columns = {"day": ["full_date"], "week": ["iso_year", "week_of_year"]}[grain]
    # The Thursday of a week decides its ISO year.
    iso_year = F.year(F.date_add(F.col("full_date"), 3 - F.weekday("full_date"))).alias("iso_year")
    daily = rollup_via(star["fact_sales"], "date_key", {"v": F.sum("sales_amount"), "n": F.count(F.lit(1))},
                       star["dim_date"], ["full_date", "week_of_year"])
    out = daily.select("full_date", iso_year, "week_of_year", "v", "n").groupBy(*columns).agg(
        F.sum("v").alias("total_sales"), F.sum("n").alias("total_items"))
    return top_k(out, [F.col("total_sales").desc_nulls_last(), *[F.col(c) for c in columns]], k, rank_as="rank_no")


# --- Delivery ---------------------------------------------------------------------------------------


def _delivered(star: Star) -> DataFrame:
    return star["fact_order_fulfillment"].filter((F.col("order_status") == "delivered") & F.col("delivered_date_key").isNotNull())


def sla_by_state(star: Star, min_orders: int = 100) -> DataFrame:
    """Lead time, deviation, on-time rate and score per customer state with enough delivered orders."""
    grouped = rollup_via(_delivered(star), "customer_key", {
        "n": F.count(F.lit(1)), "h": F.sum("total_fulfillment_hours"), "hn": F.count("total_fulfillment_hours"),
        "d": F.sum("days_vs_estimate"), "dn": F.count("days_vs_estimate"), "hit": F.count_if("is_on_time"),
        "s": F.sum("review_score"), "sn": F.count("review_score"),
    }, star["dim_customer"], ["customer_state"])
    t = {c: F.sum(c) for c in ["n", "h", "hn", "d", "dn", "hit", "s", "sn"]}
    out = grouped.groupBy("customer_state").agg(
        t["n"].alias("total_delivered_orders"),
        _mean(t["h"], t["hn"], 1).alias("avg_lead_time_hours"),
        _mean(t["h"], t["hn"], 1, HOURS_PER_DAY).alias("avg_lead_time_days"),
        _mean(t["d"], t["dn"], 1).alias("avg_days_vs_estimate"),
        pct(t["hit"], t["n"]).alias("on_time_delivery_rate_pct"),
        _mean(t["s"], t["sn"], 2).alias("avg_review_score"),
    )
    return out.filter(F.col("total_delivered_orders") >= min_orders).orderBy(F.col("avg_lead_time_days").asc_nulls_last(), "customer_state")


def delivery_sla(star: Star, by: str | None = "state") -> DataFrame:
    """On-time rate over delivered orders, mean times, mean scores on time and late, and the score lost by delay.

    by: "state" of the customer, "month" of purchase (year, month), or None for all orders as one row.
    """
    on_time, late = F.col("is_on_time"), ~F.col("is_on_time")
    score = F.col("review_score")
    partials = {
        "n": F.count(F.lit(1)), "hit": F.count_if(on_time), "miss": F.count_if(late),
        "lead": F.sum("total_fulfillment_hours"), "lead_n": F.count("total_fulfillment_hours"),
        "transit": F.sum("hours_to_customer"), "transit_n": F.count("hours_to_customer"),
        "dev": F.sum("days_vs_estimate"), "dev_n": F.count("days_vs_estimate"),
        "s": F.sum(score), "s_n": F.count(score),
        "s_hit": F.sum(F.when(on_time, score)), "s_hit_n": F.count(F.when(on_time, score)),
        "s_miss": F.sum(F.when(late, score)), "s_miss_n": F.count(F.when(late, score)),
    }
    t = {name: F.sum(name) for name in partials}
    if by == "state":
        grouped = rollup_via(_delivered(star), "customer_key", partials, star["dim_customer"], ["customer_state"]).groupBy("customer_state")
    elif by == "month":
        daily = _delivered(star).groupBy("order_purchase_date_key").agg(*[e.alias(n) for n, e in partials.items()])
        days = calendar_columns(star, "year", "month", key="order_purchase_date_key")
        grouped = daily.join(days, "order_purchase_date_key").groupBy("year", "month")
    else:
        grouped = _delivered(star).agg(*[e.alias(n) for n, e in partials.items()]).groupBy()
    out = grouped.agg(
        t["n"].alias("delivered_orders"), t["hit"].alias("on_time_orders"), t["miss"].alias("delayed_orders"),
        pct(t["hit"], t["n"]).alias("on_time_rate_pct"),
        _mean(t["lead"], t["lead_n"], 2, HOURS_PER_DAY).alias("avg_lead_time_days"),
        _mean(t["transit"], t["transit_n"], 2, HOURS_PER_DAY).alias("avg_transit_days"),
        _mean(t["dev"], t["dev_n"], 2).alias("avg_days_vs_estimate"),
        _mean(t["s"], t["s_n"], 2).alias("avg_review_score"),
        _mean(t["s_hit"], t["s_hit_n"], 2).alias("csat_on_time"),
        _mean(t["s_miss"], t["s_miss_n"], 2).alias("csat_delayed"),
        # the difference of the exact means, rounded once
        ((t["s_hit"] * t["s_miss_n"] - t["s_miss"] * t["s_hit_n"]).cast("decimal(28,0)")
         / F.nullif((t["s_hit_n"] * t["s_miss_n"]).cast("decimal(28,0)"), F.lit(0).cast("decimal(28,0)"))).alias("_lost"),
    )
    return out.withColumn("csat_penalty", F.round(F.col("_lost"), 2)).drop("_lost")


def score_distribution(star: Star) -> DataFrame:
    """Orders per score 1-5, on time and late, delivered orders."""
    scored = _delivered(star).filter(F.col("is_on_time").isNotNull())
    counts = scored.groupBy("is_on_time").pivot("review_score", [1, 2, 3, 4, 5]).count()
    return counts.select("is_on_time", *[F.coalesce(F.col(str(s)), F.lit(0)).cast("bigint").alias(f"score_{s}") for s in range(1, 6)])


def on_time_trend(star: Star, role: str = "order_purchase_date_key") -> DataFrame:
    """On-time rate per month of purchase or of delivery (role names the date key)."""
    grouped = _delivered(star).groupBy(role).agg(F.count(F.lit(1)).alias("n"), F.count_if("is_on_time").alias("hit"))
    days = calendar_columns(star, "year", "month", key=role)
    return grouped.join(days, role).groupBy("year", "month").agg(
        F.sum("n").alias("delivered_orders"), F.sum("hit").alias("on_time_orders"),
        pct(F.sum("hit"), F.sum("n")).alias("on_time_rate_pct")).orderBy("year", "month")


def duration_percentiles(star: Star, measure: str = "total_fulfillment_hours", points: tuple[float, ...] = (0.5, 0.9)) -> DataFrame:
    """Exact interpolated percentiles of a duration per order status: weighted_percentiles of the counts of equal durations."""
    counts = star["fact_order_fulfillment"].filter(F.col(measure).isNotNull()).groupBy("order_status", measure).agg(F.count(F.lit(1)).alias("n"))
    return weighted_percentiles(durable(counts, "durations"), "order_status", measure, "n", points, "order_count")


def delay_score_correlation(star: Star) -> DataFrame:
    """Correlation of the deviation from the estimate with the score, delivered orders."""
    return _delivered(star).agg(
        F.corr(F.col("days_vs_estimate").cast("double"), F.col("review_score").cast("double")).alias("corr_delay_score"))


# --- Customers --------------------------------------------------------------------------------------


def _dated_orders(star: Star, excluded: list[str]) -> DataFrame:
    """Orders outside the given statuses, with a known customer key and calendar day."""
    days = calendar_columns(star, "full_date", key="order_purchase_date_key")
    return star["fact_order_fulfillment"].filter(~F.col("order_status").isin(excluded)).join(days, "order_purchase_date_key")


def customer_value(star: Star, excluded: tuple[str, ...] = ("canceled",), place: tuple[str, ...] = ("customer_state",)) -> DataFrame:
    """Per customer: frequency, monetary value, first and last purchase day, and the wanted columns of the place."""
    orders = _dated_orders(star, list(excluded)).groupBy("customer_key").agg(
        F.count(F.lit(1)).alias("frequency"), F.sum("total_payment_value").alias("monetary"),
        F.min("full_date").alias("first_purchase_date"), F.max("full_date").alias("last_purchase_date"))
    people = star["dim_customer"].select("customer_key", "customer_unique_id", *place)
    return orders.join(people, "customer_key").drop("customer_key")


def purchase_segment(frequency: str) -> Column:
    """Fixed labels of the three purchase segments."""
    return F.when(F.col(frequency) == 1, "1. One-time Buyer").when(
        F.col(frequency) == 2, "2. Repeat Buyer (2 orders)").otherwise("3. Loyal Buyer (3+ orders)")


def purchase_segments(star: Star) -> DataFrame:
    """Customers, mean spend and total spend by number of orders, canceled and unavailable orders excluded."""
    value = customer_value(star, ("canceled", "unavailable"))
    return value.groupBy(purchase_segment("frequency").alias("customer_segment")).agg(
        F.count(F.lit(1)).alias("customer_count"), exact_avg("monetary", 2).alias("avg_spending_per_customer"),
        F.sum("monetary").alias("total_revenue_contribution")).orderBy("customer_segment")


def customer_summary(star: Star) -> DataFrame:
    """Customers, repeat purchase rate and mean lifetime value, canceled orders excluded."""
    value = customer_value(star)
    return value.agg(
        F.count(F.lit(1)).alias("total_customers"),
        pct(F.count_if(F.col("frequency") >= 2), F.count(F.lit(1))).alias("repeat_purchase_rate_pct"),
        exact_avg("monetary", 2).alias("avg_clv"))


def rfm(star: Star) -> DataFrame:
    """Recency, frequency and monetary value per customer with quintile scores; 5 is best.

    Recency counts days to the last purchase day of any order. Ties are split by customer id. The base is stored once.
    """
    days = calendar_columns(star, "full_date", key="order_purchase_date_key")
    last = star["fact_order_fulfillment"].select("order_purchase_date_key").join(days, "order_purchase_date_key").agg(F.max("full_date").alias("d")).scalar()
    base = customer_value(star).select(
        "customer_unique_id", "customer_state", F.datediff(last, "last_purchase_date").alias("recency_days"), "frequency",
        F.coalesce("monetary", F.lit(0)).alias("monetary"))
    orders = {"r_score": "-recency_days", "f_score": "frequency", "m_score": "monetary"}
    return ntiles(durable(base, "rfm"), {score: [measure, "customer_unique_id"] for score, measure in orders.items()}, 5)


def rfm_segment(r: str = "r_score", f: str = "f_score") -> Column:
    """Segment of a score pair. The cut-offs are this library's own:

    Champions r >= 4 and f >= 4; Loyal Customers other r >= 3; At Risk r = 2, or r = 1 with f >= 4; Lost the rest.
    """
    r_col, f_col = F.col(r), F.col(f)
    return (
        F.when((r_col >= 4) & (f_col >= 4), "Champions").when(r_col >= 3, "Loyal Customers")
        .when((r_col == 2) | (f_col >= 4), "At Risk").otherwise("Lost"))


def rfm_segments(star: Star) -> DataFrame:
    """Customers, revenue and share of revenue per segment."""
    grouped = rfm(star).groupBy(rfm_segment().alias("segment")).agg(
        F.count(F.lit(1)).alias("customers"), F.sum("monetary").alias("revenue"))
    return share_of_total(grouped, "revenue", "revenue_share_pct").orderBy("segment")


def revenue_by_place(star: Star, place: tuple[str, ...] = ("customer_state",), k: int = 5) -> DataFrame:
    """The k customer states, or cities, with the highest payments, canceled orders excluded."""
    grouped = customer_value(star, place=place).groupBy(*place).agg(F.sum("monetary").alias("revenue"), F.count(F.lit(1)).alias("customers"))
    return top_k(grouped, [F.col("revenue").desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in place]], k, rank_as="rank_no")


def cohorts(star: Star) -> DataFrame:
    """Active customers per first-purchase month and months since; canceled orders excluded."""
    month = F.trunc("full_date", "MM")
    active = _dated_orders(star, ["canceled"]).filter(F.col("customer_key").isNotNull()).select("customer_key", month.alias("month")).distinct()
    # A customer has at most one row per calendar month here, so the window stays small for any customer.
    first = F.min("month").over(Window.partitionBy("customer_key"))
    offset = F.months_between("month", "cohort_month").cast("int")
    return active.withColumn("cohort_month", first).groupBy("cohort_month", offset.alias("month_offset")).agg(
        F.count(F.lit(1)).alias("customers")).orderBy("cohort_month", "month_offset")


def average_order_value(star: Star) -> DataFrame:
    """Payments per order."""
    one = star["fact_order_fulfillment"].agg(F.sum("total_payment_value").alias("paid"), F.count_distinct("order_id").alias("n"))
    return one.select(F.col("n").alias("total_orders"), F.col("paid").alias("total_payments"),
                      _mean(F.col("paid"), F.col("n"), 2).alias("avg_order_value"))


# --- Products ---------------------------------------------------------------------------------------


def _product_rollup(star: Star, attrs: list[str]) -> DataFrame:
    return rollup_via(star["fact_sales"], "product_key", {
        "items": F.count(F.lit(1)), "gmv": F.sum("price"), "price_n": F.count("price"),
        "freight": F.sum("freight_value"), "freight_n": F.count("freight_value"), "sales": F.sum("sales_amount"),
    }, star["dim_product"], attrs)


def _product_measures() -> list[Column]:
    t = {c: F.sum(c) for c in ["items", "gmv", "price_n", "freight", "freight_n", "sales"]}
    return [
        t["items"].alias("items_sold"), t["gmv"].alias("gmv"), t["sales"].alias("total_revenue"),
        _mean(t["gmv"], t["price_n"], 2).alias("avg_price"), _mean(t["freight"], t["freight_n"], 2).alias("avg_freight"),
        pct(t["freight"], t["gmv"]).alias("freight_ratio_pct"),
    ]


def category_pareto(star: Star, k: int | None = None) -> DataFrame:
    """Categories by revenue with rank and cumulative share; k keeps the first ranks."""
    grouped = _product_rollup(star, ["category_name_english"]).groupBy("category_name_english").agg(*_product_measures())
    order = [F.col("total_revenue").desc_nulls_last(), F.col("category_name_english").asc_nulls_last()]
    by_rank = Window.orderBy(*order)  # a row per category
    ranked = grouped.select("*", F.row_number().over(by_rank).cast("bigint").alias("rank_no"),
                            F.sum("total_revenue").over(by_rank.rowsBetween(Window.unboundedPreceding, 0)).alias("_running"),
                            F.sum("total_revenue").over(Window.partitionBy()).alias("_all"))
    out = ranked.withColumn("cumulative_pct", pct("_running", "_all")).drop("_running", "_all")
    return (out.filter(F.col("rank_no") <= k) if k else out).orderBy("rank_no")


def size_bucket(kind: str) -> Column:
    grams, photos = F.col("product_weight_g"), F.col("product_photos_qty")
    if kind == "weight":
        return F.when(grams < 1000, "< 1kg").when(grams <= 5000, "1-5kg").when(grams > 5000, "> 5kg").otherwise("unknown")
    return F.when(photos == 1, "1 photo").when(photos.between(2, 4), "2-4 photos").when(photos >= 5, "5+ photos").otherwise("unknown")


def product_buckets(star: Star, kind: str = "weight") -> DataFrame:
    """Product measures per weight or photo bucket."""
    column = {"weight": "product_weight_g", "photos": "product_photos_qty"}[kind]
    grouped = _product_rollup(star, [column]).withColumn("bucket", size_bucket(kind))
    return grouped.groupBy("bucket").agg(*_product_measures()).orderBy("bucket")


def product_correlations(star: Star) -> DataFrame:
    """Over sold products: photos and description length against items sold, weight against mean freight."""
    sold = _product_rollup(star, ["product_photos_qty", "product_description_length", "product_weight_g"])
    items = F.col("items").cast("double")
    freight = safe_div("freight", "freight_n").cast("double")
    return sold.agg(
        F.corr(F.col("product_photos_qty").cast("double"), items).alias("corr_photos_items"),
        F.corr(F.col("product_description_length").cast("double"), items).alias("corr_description_items"),
        F.corr(F.col("product_weight_g").cast("double"), freight).alias("corr_weight_freight"))


def category_sales_and_reviews(star: Star, k: int = 20) -> DataFrame:
    """Per category over delivered orders: orders, sales, mean order score.

    Items are summed per (order, category) before meeting the order fact, so no order measure repeats.
    """
    named = star["fact_sales"].select("order_id", "product_key", "sales_amount").join(
        star["dim_product"].select("product_key", "category_name_english"), "product_key")
    per_order = named.groupBy("order_id", "category_name_english").agg(F.sum("sales_amount").alias("category_sales"))
    delivered = star["fact_order_fulfillment"].filter(F.col("order_status") == "delivered").select("order_id", "review_score")
    out = per_order.join(delivered, "order_id").groupBy("category_name_english").agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("category_sales").alias("total_sales"),
        exact_avg("review_score", 2).alias("avg_order_review_score"))
    return top_k(out, [F.col("total_sales").desc_nulls_first(), F.col("category_name_english").asc_nulls_last()], k)


def order_values(star: Star) -> DataFrame:
    """Items and sales of each order next to its payment."""
    per_order = star["fact_sales"].groupBy("order_id").agg(F.sum("sales_amount").alias("total_sales"), F.count(F.lit(1)).alias("item_count"))
    return star["fact_order_fulfillment"].select("order_id", "total_payment_value").join(per_order, "order_id")


# --- Sellers ----------------------------------------------------------------------------------------


def seller_orders(star: Star) -> DataFrame:
    """One row per (order, seller): item sums plus the order's dispatch time, score and route.

    Order-level measures thus count once per seller of the order, however many items the seller has in it.
    """
    pairs = star["fact_sales"].groupBy("order_id", "seller_key").agg(
        F.sum("price").alias("gmv"), F.sum("freight_value").alias("freight"), F.count(F.lit(1)).alias("items"))
    orders = star["fact_order_fulfillment"].select("order_id", "customer_key", "hours_to_carrier", "total_fulfillment_hours", "review_score")
    people = star["dim_customer"].select("customer_key", "customer_state")
    sellers = star["dim_seller"].select("seller_key", "seller_id", "seller_state", "seller_city")
    return pairs.join(orders, "order_id", "left").join(people, "customer_key", "left").join(sellers, "seller_key").withColumn(
        "same_state", F.col("seller_state") == F.col("customer_state"))


def _seller_totals() -> list[Column]:
    return [
        F.sum("gmv").alias("total_gmv"), F.count(F.lit(1)).alias("total_orders"), F.sum("items").alias("total_items"),
        exact_avg("hours_to_carrier", 2).alias("avg_dispatch_hours"),
        _mean(F.sum("hours_to_carrier"), F.count("hours_to_carrier"), 2, HOURS_PER_DAY).alias("avg_dispatch_days"),
        pct(F.count_if("same_state"), F.count(F.lit(1))).alias("same_state_rate_pct"),
        exact_avg("review_score", 2).alias("avg_csat"),
    ]


def seller_tier(gmv: str = "total_gmv") -> Column:
    """Tier 1 above 100,000, tier 2 from 20,000, tier 3 below."""
    return F.when(F.col(gmv) > 100_000, "Tier 1").when(F.col(gmv) >= 20_000, "Tier 2").otherwise("Tier 3")


def seller_performance(star: Star) -> DataFrame:
    """Sales, dispatch time, same-state rate, score and tier of each seller with sales."""
    return seller_orders(star).groupBy("seller_id", "seller_state").agg(*_seller_totals()).withColumn("tier", seller_tier())


def sellers_by_place(star: Star, place: tuple[str, ...] = ("seller_state",)) -> DataFrame:
    """Active sellers, their share of all active sellers, sales and mean dispatch hours per seller state, or city."""
    grouped = seller_orders(star).groupBy(*place).agg(
        F.count_distinct("seller_id").alias("active_sellers"), F.sum("gmv").alias("total_gmv"),
        exact_avg("hours_to_carrier", 2).alias("avg_dispatch_hours"))
    selling = star["fact_sales"].select("seller_key").distinct().join(star["dim_seller"].select("seller_key"), "seller_key")
    everyone = selling.agg(F.count(F.lit(1)).alias("n")).scalar()
    return grouped.withColumn("seller_share_pct", pct("active_sellers", everyone)).orderBy(F.desc("total_gmv"), *place)


def route_comparison(star: Star) -> DataFrame:
    """Intra-state against inter-state orders: mean time and freight; unknown places are left out."""
    route = F.when(F.col("same_state"), "Intra-state").otherwise("Inter-state")
    return seller_orders(star).filter(F.col("same_state").isNotNull()).groupBy(route.alias("route")).agg(
        F.count(F.lit(1)).alias("seller_orders"), exact_avg("total_fulfillment_hours", 2).alias("avg_fulfillment_hours"),
        exact_avg("freight", 2).alias("avg_freight"))


def seller_concentration(star: Star) -> DataFrame:
    """Sellers by sales with the cumulative share of sales and of sellers."""
    grouped = rollup_via(star["fact_sales"], "seller_key", {"v": F.sum("price")}, star["dim_seller"], ["seller_id"])
    totals = grouped.groupBy("seller_id").agg(F.coalesce(F.sum("v"), F.lit(0)).alias("total_gmv"))
    ranked = ordered(durable(totals, "seller-sales"), ["-total_gmv", "seller_id"], running={"_running": "total_gmv"}, totals={"_all": "total_gmv"},
                     row_no="rank_no", row_count="_sellers")
    return ranked.select("rank_no", "seller_id", "total_gmv", pct("_running", "_all").alias("cumulative_gmv_pct"),
                         pct("rank_no", "_sellers").alias("seller_pct"))


# --- Drift ------------------------------------------------------------------------------------------


def price_drift(star: Star, split_key: int, low: float, high: float, buckets: int = 10) -> DataFrame:
    """Item price distribution before and from a date key; buckets 0 and n+1 hold prices out of range."""
    priced = star["fact_sales"].filter(F.col("price").isNotNull() & F.col("date_key").isNotNull()).select(
        F.width_bucket(F.col("price").cast("double"), F.lit(low), F.lit(high), F.lit(buckets)).alias("bucket"), "date_key")
    return _drift(priced, "date_key", split_key)


def score_drift(star: Star, split_key: int) -> DataFrame:
    """Review score distribution before and from a purchase date key."""
    key = "order_purchase_date_key"
    scored = star["fact_order_fulfillment"].filter(F.col("review_score").isNotNull() & F.col(key).isNotNull())
    return _drift(scored.select(F.col("review_score").cast("bigint").alias("bucket"), key), key, split_key)


def _drift(values: DataFrame, key: str, split_key: int) -> DataFrame:
    """Bucket counts of both periods and each bucket's part of the population stability index, in one pass.

    A bucket empty in one period counts half a row there, so the logarithm is defined.
    """
    before = F.col(key) < split_key
    counts = values.groupBy("bucket").agg(F.count_if(before).alias("base_n"), F.count_if(~before).alias("current_n"))
    base_all, current_all = (values.agg(F.count_if(c).alias("n")).scalar() for c in (before, ~before))
    b = F.greatest(F.col("base_n").cast("double"), F.lit(0.5)) / base_all
    c = F.greatest(F.col("current_n").cast("double"), F.lit(0.5)) / current_all
    return counts.select("bucket", "base_n", "current_n", ((c - b) * F.log(c / b)).alias("psi_part"))
