"""Star schema builders."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starloom.functions import calendar_key, date_key, days_between, hours_between, not_blank
from starloom.operators.calendar import day_spine
from starloom.operators.dedup import modal_row
from starloom.operators.durable import durable
from starloom.operators.keys import dense_keys
from starloom.schemas import MONEY, star_columns, star_schema


@dataclass(frozen=True)
class Calendar:
    """Range of the calendar dimension; an end that is not given comes from the orders, see `calendar_of`."""

    first: dt.date | None = None
    last: dt.date | None = None


STRAY_YEARS = 25  # days further away from all others stand outside the calendar


def _days_seen() -> list[Column]:
    """The distinct days of each order time stamp, as day numbers: at most one per day of the calendar, whatever the rows."""
    return [F.collect_set(F.unix_date(F.to_date(stamp))).alias(stamp) for stamp in DATE_ROLES.values()]


def _calendar(seen: Mapping[str, list[int]], wanted: Calendar) -> Calendar:
    """The wanted calendar with missing ends from the days seen.

    Days fall into blocks where more than STRAY_YEARS pass without any; the calendar spans the block of most days, of equal ones the first.
    A stray day, such as 9999-12-31, so neither stretches the calendar nor stops the load: rows of that day get no date key.
    """
    days = sorted(set().union(*seen.values()))
    cuts = [0, *[k for k in range(1, len(days)) if days[k] - days[k - 1] > STRAY_YEARS * 366], len(days)]
    block = max((days[a:b] for a, b in zip(cuts, cuts[1:])), key=len)
    ends = [dt.date(1970, 1, 1) + dt.timedelta(days=d) for d in (block[0], block[-1])] if block else [None, None]
    first = wanted.first or ends[0] or wanted.last or dt.date(1970, 1, 1)
    return Calendar(first, wanted.last or max(ends[1] or first, first))


def calendar_of(orders: DataFrame, wanted: Calendar = Calendar()) -> Calendar:
    """The wanted calendar with missing ends from all order time stamps but stray ones (one aggregate)."""
    if wanted.first and wanted.last:
        return wanted
    return _calendar(orders.agg(*_days_seen()).first().asDict(), wanted)


def stored_orders(orders: DataFrame, wanted: Calendar = Calendar(), folder: str | None = None) -> tuple[DataFrame, Calendar]:
    """The orders, written once, and the calendar that calendar_of finds, observed while they are written."""
    seen = Observation("days of orders")
    watched = orders if wanted.first and wanted.last else orders.observe(seen, *_days_seen())
    stored = durable(watched, "typed-orders", folder=folder)
    return stored, wanted if watched is orders else _calendar(seen.get, wanted)


def conform(df: DataFrame, table: str) -> DataFrame:
    """Columns and types of the declared table, in order."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in star_schema(table).fields])


def dim_date(spark: SparkSession, calendar: Calendar) -> DataFrame:
    day = F.col("full_date")
    days = day_spine(spark, calendar.first, calendar.last).select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
    )
    return conform(days, "dim_date")


def dim_customer(customers: DataFrame, folder: str | None = None) -> DataFrame:
    """One row per person, at the place most of the person's records name. What the keys need on the way stands below folder, if given."""
    place = ["customer_city", "customer_state", "customer_zip_code_prefix"]
    people = modal_row(customers, "customer_unique_id", place)
    people = people.withColumnRenamed("customer_zip_code_prefix", "zip_code_prefix")
    return conform(dense_keys(people, "customer_unique_id", "customer_key", unique=True, folder=folder), "dim_customer")


def dim_product(products: DataFrame, folder: str | None = None) -> DataFrame:
    return conform(dense_keys(products, "product_id", "product_key", folder=folder), "dim_product")


def dim_seller(sellers: DataFrame, folder: str | None = None) -> DataFrame:
    named = sellers.withColumnRenamed("seller_zip_code_prefix", "zip_code_prefix")
    return conform(dense_keys(named, "seller_id", "seller_key", folder=folder), "dim_seller")


def customer_keys(customers: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """customer_id -> customer_key, through the person id; one row per customers row."""
    return customers.select("customer_id", "customer_unique_id").join(
        dim_customer.select("customer_unique_id", "customer_key"), "customer_unique_id", "left"
    ).select("customer_id", "customer_key")


# Calendar role of each order time stamp.
DATE_ROLES = {
    "order_purchase_date_key": "order_purchase_timestamp",
    "order_approved_date_key": "order_approved_at",
    "carrier_pickup_date_key": "order_delivered_carrier_date",
    "delivered_date_key": "order_delivered_customer_date",
    "estimated_delivery_date_key": "order_estimated_delivery_date",
}


def role_keys(orders: DataFrame, calendar: Calendar) -> DataFrame:
    """Add the five role keys by range test: no join, as the calendar has no gaps."""
    keys = [calendar_key(stamp, calendar.first, calendar.last).alias(role) for role, stamp in DATE_ROLES.items()]
    return orders.select("*", *keys)


def role_keys_by_join(orders: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Add the five role keys by joining the calendar once per role; for calendars with gaps."""
    out = orders
    for role, stamp in DATE_ROLES.items():
        days = dim_date.select(F.col("full_date").alias(f"_{role}"), F.col("date_key").alias(role))
        out = out.join(F.broadcast(days), F.to_date(stamp) == F.col(f"_{role}"), "left").drop(f"_{role}")
    return out


def lifecycle_measures(orders: DataFrame) -> DataFrame:
    """Add stage durations, deviation from the estimate and the on-time flag.

    The flag compares full time stamps, so delivery later on the estimated day is late.
    """
    purchase, approved, carrier, delivered, estimated = DATE_ROLES.values()
    return orders.select(
        "*",
        hours_between(purchase, approved).alias("hours_to_approval"),
        hours_between(approved, carrier).alias("hours_to_carrier"),
        hours_between(carrier, delivered).alias("hours_to_customer"),
        hours_between(purchase, delivered).alias("total_fulfillment_hours"),
        days_between(estimated, delivered).alias("days_vs_estimate"),
        (F.col(delivered) <= F.col(estimated)).alias("is_on_time"),
    )


def fact_order_fulfillment(orders: DataFrame, customers: DataFrame, payments_agg: DataFrame, reviews_latest: DataFrame,
                           dim_customer: DataFrame, calendar: Calendar = Calendar()) -> DataFrame:
    """One row per order, without its row key.

    Payments and reviews arrive grouped by order_id, so their joins reuse the orders' shuffle on it.
    Left joins: an order is never dropped for a missing customer, payment or review. A calendar without ends takes them
    from the orders in a job of its own.
    """
    known, calendar = orders.filter(not_blank("order_id")), calendar_of(orders, calendar)
    enriched = lifecycle_measures(role_keys(known, calendar))
    joined = (
        enriched.join(reviews_latest, "order_id", "left")
        .join(payments_agg, "order_id", "left")
        .join(customer_keys(customers, dim_customer), "customer_id", "left")
    )
    return _conform_unkeyed(joined, "fact_order_fulfillment")


def fact_sales(items: DataFrame, order_facts: DataFrame, dim_product: DataFrame, dim_seller: DataFrame) -> DataFrame:
    """One row per order item, without its row key.

    Customer and purchase date are properties of the order, so they come from the order fact: one
    join on order_id in place of a chain through orders, customers and both dimensions.
    """
    spine = order_facts.select("order_id", "customer_key", F.col("order_purchase_date_key").alias("date_key"))
    zero = F.lit(0).cast(MONEY)
    joined = (
        items.join(spine, "order_id", "left")
        .join(dim_product.select("product_id", "product_key"), "product_id", "left")
        .join(dim_seller.select("seller_id", "seller_key"), "seller_id", "left")
        .withColumn("sales_amount", F.coalesce("price", zero) + F.coalesce("freight_value", zero))
    )
    return _conform_unkeyed(joined, "fact_sales")


def _conform_unkeyed(df: DataFrame, table: str) -> DataFrame:
    fields = star_schema(table).fields[1:]
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def build_lazy(spark: SparkSession, views: Mapping[str, DataFrame], calendar: Calendar = Calendar()) -> dict[str, DataFrame]:
    """Whole star, facts without row keys. Typed orders and numbered dimensions are stored on the way, so each is computed once; the facts are lazy."""
    orders, calendar = stored_orders(views["vw_orders"], calendar)
    star = {
        "dim_date": dim_date(spark, calendar),
        "dim_customer": dim_customer(views["vw_customers"]),
        "dim_product": dim_product(views["vw_products"]),
        "dim_seller": dim_seller(views["vw_sellers"]),
    }
    star["fact_order_fulfillment"] = fact_order_fulfillment(
        orders, views["vw_customers"], views["vw_order_payments_agg"], views["vw_order_reviews_latest"],
        star["dim_customer"], calendar,
    )
    star["fact_sales"] = fact_sales(
        views["vw_order_items"], star["fact_order_fulfillment"], star["dim_product"], star["dim_seller"]
    )
    return star


__all__ = [
    "Calendar", "DATE_ROLES", "build_lazy", "calendar_of", "conform", "customer_keys", "dim_customer", "dim_date", "dim_product",
    "dim_seller", "fact_order_fulfillment", "fact_sales", "lifecycle_measures", "role_keys", "role_keys_by_join",
    "star_columns", "stored_orders",
]
