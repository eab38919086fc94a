"""Typed, trimmed, pre-aggregated views over the raw tables. All are lazy."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions import not_blank, typed
from starloom.operators.dedup import latest_row
from starloom.schemas import MONEY
from starloom.tables import LazyTables


def customers(raw: DataFrame) -> DataFrame:
    return raw.filter(not_blank("customer_unique_id")).select(
        "customer_id",
        "customer_unique_id",
        F.trim("customer_city").alias("customer_city"),
        F.trim("customer_state").alias("customer_state"),
        F.trim("customer_zip_code_prefix").alias("customer_zip_code_prefix"),
    )


ORDER_STAMPS = [
    "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date",
]


def orders(raw: DataFrame) -> DataFrame:
    """Blank order ids are kept here; only the order fact drops them."""
    stamps = [typed(c, "timestamp_ntz").alias(c) for c in ORDER_STAMPS]
    return raw.select("order_id", "customer_id", "order_status", *stamps)


def order_items(raw: DataFrame) -> DataFrame:
    return raw.filter(not_blank("order_id") & not_blank("order_item_id")).select(
        "order_id",
        typed("order_item_id", "smallint").alias("order_item_id"),
        "product_id",
        "seller_id",
        typed("price", MONEY).alias("price"),
        typed("freight_value", MONEY).alias("freight_value"),
    )


def products(raw: DataFrame, translation: DataFrame) -> DataFrame:
    """Category falls back from English to the original name to 'unknown'."""
    names = translation.select(
        F.col("product_category_name").alias("_category"), F.col("product_category_name_english").alias("_english")
    )
    joined = raw.filter(not_blank("product_id")).join(names, F.col("product_category_name") == F.col("_category"), "left")
    return joined.select(
        "product_id",
        F.col("product_category_name").alias("category_name"),
        F.coalesce("_english", "product_category_name", F.lit("unknown")).alias("category_name_english"),
        typed("product_name_lenght", "int").alias("product_name_length"),
        typed("product_description_lenght", "int").alias("product_description_length"),
        typed("product_photos_qty", "int").alias("product_photos_qty"),
        typed("product_weight_g", "decimal(10,2)").alias("product_weight_g"),
        typed("product_length_cm", "decimal(8,2)").alias("product_length_cm"),
        typed("product_height_cm", "decimal(8,2)").alias("product_height_cm"),
        typed("product_width_cm", "decimal(8,2)").alias("product_width_cm"),
    )


def sellers(raw: DataFrame) -> DataFrame:
    return raw.filter(not_blank("seller_id")).select(
        "seller_id",
        F.trim("seller_city").alias("seller_city"),
        F.trim("seller_state").alias("seller_state"),
        F.trim("seller_zip_code_prefix").alias("seller_zip_code_prefix"),
    )


def order_payments_agg(raw: DataFrame) -> DataFrame:
    """One row per order, so the order fact keeps its grain."""
    return raw.groupBy("order_id").agg(
        F.sum(typed("payment_value", MONEY)).alias("total_payment_value"),
        F.count(F.lit(1)).alias("payment_count"),
    )


def order_reviews_latest(raw: DataFrame) -> DataFrame:
    """Newest scored review per order.

    The creation date is compared as text; the answer time and the review id break ties.
    """
    order = ["review_creation_date", "review_answer_timestamp", "review_id"]
    newest = latest_row(raw.filter(not_blank("review_score")), "order_id", order, ["review_score"])
    return newest.select("order_id", typed("review_score", "smallint").alias("review_score"))


def clean_views(raw: Mapping[str, DataFrame], register: bool = False) -> Mapping[str, DataFrame]:
    """All seven views by name; register=True also makes them visible to SQL."""
    views = LazyTables({
        "vw_customers": lambda: customers(raw["customers"]),
        "vw_orders": lambda: orders(raw["orders"]),
        "vw_order_items": lambda: order_items(raw["order_items"]),
        "vw_products": lambda: products(raw["products"], raw["product_category_name_translation"]),
        "vw_sellers": lambda: sellers(raw["sellers"]),
        "vw_order_payments_agg": lambda: order_payments_agg(raw["order_payments"]),
        "vw_order_reviews_latest": lambda: order_reviews_latest(raw["order_reviews"]),
    })
    if register:
        for name, df in views.items():
            df.createOrReplaceTempView(name)
    return views
