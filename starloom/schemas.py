"""Declared schemas: nine raw all-text tables, six star tables, audit outputs."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw table layouts, in file column order (the source spells "length" as "lenght").
RAW_COLUMNS: dict[str, list[str]] = {
    "customers": [
        "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state",
    ],
    "orders": [
        "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
        "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date",
    ],
    "order_items": [
        "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value",
    ],
    "order_payments": [
        "order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value",
    ],
    "order_reviews": [
        "review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
        "review_creation_date", "review_answer_timestamp",
    ],
    "products": [
        "product_id", "product_category_name", "product_name_lenght", "product_description_lenght",
        "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
    ],
    "sellers": ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
    "geolocation": [
        "geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng", "geolocation_city",
        "geolocation_state",
    ],
    "product_category_name_translation": ["product_category_name", "product_category_name_english"],
}


def raw_schema(table: str) -> T.StructType:
    """All-string schema of one raw table."""
    return T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS[table]])


# Star table layouts as Spark DDL. Keys, counts and money are wider than a small store needs, so that one
# order with a large share of all rows does not overflow them.
STAR_DDL: dict[str, str] = {
    "dim_date": (
        "date_key INT, full_date DATE, year SMALLINT, quarter SMALLINT, month SMALLINT, month_name STRING, "
        "week_of_year SMALLINT, day_of_month SMALLINT, day_of_week SMALLINT, day_name STRING, is_weekend BOOLEAN"
    ),
    "dim_customer": (
        "customer_key BIGINT, customer_unique_id STRING, customer_city STRING, customer_state STRING, "
        "zip_code_prefix STRING"
    ),
    "dim_product": (
        "product_key BIGINT, product_id STRING, category_name STRING, category_name_english STRING, "
        "product_name_length INT, product_description_length INT, product_photos_qty INT, "
        "product_weight_g DECIMAL(10,2), product_length_cm DECIMAL(8,2), product_height_cm DECIMAL(8,2), "
        "product_width_cm DECIMAL(8,2)"
    ),
    "dim_seller": (
        "seller_key BIGINT, seller_id STRING, seller_city STRING, seller_state STRING, zip_code_prefix STRING"
    ),
    "fact_sales": (
        "sales_key BIGINT, order_id STRING, order_item_id SMALLINT, customer_key BIGINT, product_key BIGINT, "
        "seller_key BIGINT, date_key INT, price DECIMAL(18,2), freight_value DECIMAL(18,2), "
        "sales_amount DECIMAL(18,2)"
    ),
    "fact_order_fulfillment": (
        "fulfillment_key BIGINT, order_id STRING, customer_key BIGINT, order_purchase_date_key INT, "
        "order_approved_date_key INT, carrier_pickup_date_key INT, delivered_date_key INT, "
        "estimated_delivery_date_key INT, hours_to_approval DECIMAL(10,2), hours_to_carrier DECIMAL(10,2), "
        "hours_to_customer DECIMAL(10,2), total_fulfillment_hours DECIMAL(10,2), days_vs_estimate DECIMAL(10,2), "
        "review_score SMALLINT, order_status STRING, is_on_time BOOLEAN, total_payment_value DECIMAL(22,2), "
        "payment_count BIGINT"
    ),
}

MONEY = "decimal(18,2)"

# Durations of an order's life, in hours; the last one is the whole.
DURATIONS = ["hours_to_approval", "hours_to_carrier", "hours_to_customer", "total_fulfillment_hours"]

# Types that the model declares where the star stores a wider one: a duration holds any span from year 1 to 9999.
MODEL_TYPES = {column: "decimal(8,2)" for column in [*DURATIONS, "days_vs_estimate"]}

DIMENSIONS = ["dim_date", "dim_customer", "dim_product", "dim_seller"]
FACTS = ["fact_sales", "fact_order_fulfillment"]
STAR_TABLES = DIMENSIONS + FACTS

# Physical partition column of both facts: purchase year-month as yyyymm, 0 when the date key is NULL.
MONTH_PARTITION = "purchase_month"


def star_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(STAR_DDL[table])


def star_columns(table: str) -> list[str]:
    """Column names; needs no session."""
    return [column.split()[0] for column in STAR_DDL[table].split(", ")]
