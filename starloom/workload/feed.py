"""Raw retail extracts derived from the generic test tables.

Each order has its own customer record of a person who lives mostly in one place; repeated
(order, line) pairs of lineitem are added up, so the pair is the item grain; the ship dates set the
life of an order; two events in a row review one order in three.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.plans.clean import clean_views
from starloom.schemas import RAW_COLUMNS
from starloom.tables import LazyTables

def _text(col: Column) -> Column:
    return col.cast("string")


def _hundredths(name: str, spark_type: str) -> Column:
    """A column of two digits as a whole number of hundredths, as a cast to spark_type gives it.

    A double that is a hundredth but for its last bits needs no text on the way; the cast itself settles, or refuses, all others.
    """
    scaled = F.col(name) * F.lit(100)
    whole = F.rint(scaled)
    limit = 10 ** int(spark_type.removeprefix("decimal(").split(",")[0])
    return F.when((F.abs(scaled - whole) < 1e-4) & (F.abs(whole) < limit), whole.cast("bigint")).otherwise(
        (F.col(name).cast(spark_type) * F.lit(100)).cast("bigint"))


def _from_hundredths(value: Column) -> Column:
    """Hundredths of hundredths to hundredths, half away from zero."""
    away = F.when(value < 0, F.lit(-50)).otherwise(F.lit(50))
    return F.call_function("div", value + away, F.lit(100))


def _amount(cents: Column) -> Column:
    return (cents.cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(18,2)")


def line_cents(lineitem: DataFrame) -> DataFrame:
    """Lines with exact price and freight in cents."""
    gross = _hundredths("l_extendedprice", "decimal(12,2)")
    return lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_shipdate",
        _from_hundredths(gross * (F.lit(100) - _hundredths("l_discount", "decimal(4,2)"))).alias("price"),
        _from_hundredths(gross * _hundredths("l_tax", "decimal(4,2)")).alias("freight"),
    )


def line_amounts(lineitem: DataFrame) -> DataFrame:
    """Lines with exact price and freight; the sources have two digits, so nothing is lost."""
    return line_cents(lineitem).withColumns({name: _amount(F.col(name)) for name in ("price", "freight")})


def _places(nation: DataFrame) -> DataFrame:
    key = F.col("n_nationkey")
    return nation.select(
        key.alias("_nation"),
        F.concat(F.lit("  "), F.lower("n_name"), F.lit(" d'oeste ")).alias("city"),
        F.concat(F.char(65 + key), F.char(65 + F.col("n_regionkey"))).alias("state"),
        F.lpad(_text(key * 4000 + 17), 5, "0").alias("zip"),
    )


def raw_customers(t: Mapping[str, DataFrame]) -> DataFrame:
    order = F.col("o_orderkey")
    home = F.col("c_nationkey")
    moved = F.when(order % 4 == 0, (home + 1 + order % 3) % 25).otherwise(home)
    records = t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey")).select(
        F.concat(F.lit("c"), _text(order)).alias("customer_id"),
        F.when(order % 499 == 0, F.lit(" ")).otherwise(_text(F.col("o_custkey"))).alias("customer_unique_id"),
        moved.cast("int").alias("_nation"),
    )
    return records.join(_places(t["nation"]), "_nation").select(
        "customer_id", "customer_unique_id", F.col("zip").alias("customer_zip_code_prefix"),
        F.col("city").alias("customer_city"), F.col("state").alias("customer_state"))


def raw_orders(t: Mapping[str, DataFrame]) -> DataFrame:
    ships = t["lineitem"].groupBy("l_orderkey").agg(F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"))
    k = F.col("o_orderkey")
    priority = F.col("o_orderpriority")
    other = (
        F.when(priority == "1-URGENT", "canceled").when(priority == "2-HIGH", "unavailable")
        .when(priority == "3-MEDIUM", "invoiced").when(priority == "4-NOT SPECIFIED", "processing").otherwise("lost"))
    status = (
        F.when(F.col("o_orderstatus") == "F", "delivered")
        .when((F.col("o_orderstatus") == "O") & (priority == "1-URGENT"), "shipped")
        .when(F.col("o_orderstatus") == "O", "delivered").otherwise(other))

    def plus(base: Column, days: Column | int = 0, hours: Column | int = 0, minutes: Column | int = 0, seconds: Column | int = 0) -> Column:
        parts = [F.lit(x) if isinstance(x, int) else x.cast("int") for x in (days, hours, minutes, seconds)]
        return base + F.make_dt_interval(*parts)

    purchase = plus(F.col("o_orderdate"), seconds=(k * 7919) % 86400)
    approved = plus(F.col("purchase"), hours=k % 5, minutes=(k % 7) * 11)
    lag = F.pmod(F.datediff("first_ship", "o_orderdate"), F.lit(20))
    carrier = plus(F.col("purchase"), days=lag - 1, hours=9)
    transit = F.pmod(F.datediff("last_ship", "first_ship"), F.lit(70))
    delivered = plus(F.col("carrier"), days=transit, hours=k % 24 - 2)
    # Both sides hold one row per order and grow alike, so neither is one to broadcast.
    stamped = (
        t["orders"].join(ships.hint("merge"), k == F.col("l_orderkey"), "left")
        .withColumn("status", status)
        .withColumn("purchase", purchase)
        .withColumn("approved", F.when(k % 61 != 0, approved))
        .withColumn("carrier", F.when(F.col("status").isin("delivered", "shipped"), carrier))
        .withColumn("delivered", F.when((F.col("status") == "delivered") & (k % 89 != 0), delivered))
        .withColumn("estimated", plus(F.date_trunc("DAY", F.col("o_orderdate")).cast("timestamp_ntz"), days=45))
    )

    def stamp(name: str) -> Column:
        return F.coalesce(_text(F.col(name)), F.lit(""))

    return stamped.select(
        _text(k).alias("order_id"), F.concat(F.lit("c"), _text(k)).alias("customer_id"), F.col("status").alias("order_status"),
        stamp("purchase").alias("order_purchase_timestamp"), stamp("approved").alias("order_approved_at"),
        stamp("carrier").alias("order_delivered_carrier_date"), stamp("delivered").alias("order_delivered_customer_date"),
        stamp("estimated").alias("order_estimated_delivery_date"))


def raw_order_items(t: Mapping[str, DataFrame]) -> DataFrame:
    items = line_cents(t["lineitem"]).groupBy("l_orderkey", "l_linenumber").agg(
        F.max("l_partkey").alias("part"), F.max("l_suppkey").alias("supplier"), F.max("l_shipdate").alias("ship"),
        F.max("l_quantity").alias("quantity"), F.sum("price").alias("price"), F.sum("freight").alias("freight"))
    unpriced = (F.col("l_linenumber") == 7) & (F.col("quantity") == 50)
    return items.select(
        _text(F.col("l_orderkey")).alias("order_id"), _text(F.col("l_linenumber")).alias("order_item_id"),
        _text(F.col("part")).alias("product_id"), _text(F.col("supplier")).alias("seller_id"),
        _text(F.col("ship")).alias("shipping_limit_date"),
        F.when(unpriced, "").otherwise(_text(_amount(F.col("price")))).alias("price"), _text(_amount(F.col("freight"))).alias("freight_value"))


def raw_order_payments(t: Mapping[str, DataFrame]) -> DataFrame:
    paid = F.col("price") + F.col("freight")
    voucher = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)
    value = F.when(voucher, _from_hundredths(paid * F.lit(90))).otherwise(paid)
    blank = (F.col("l_linenumber") == 7) & (F.col("l_quantity") == 50)
    return line_cents(t["lineitem"]).select(
        _text(F.col("l_orderkey")).alias("order_id"), _text(F.col("l_linenumber")).alias("payment_sequential"),
        F.col("l_returnflag").alias("payment_type"), _text(F.col("l_quantity").cast("int") % 10 + 1).alias("payment_installments"),
        F.when(blank, "").otherwise(_text(_amount(value))).alias("payment_value"))


def raw_order_reviews(t: Mapping[str, DataFrame]) -> DataFrame:
    e = F.col("event_id")
    return t["events"].select(
        F.concat(F.lit("r"), F.lpad(_text(e), 12, "0")).alias("review_id"),
        _text(F.floor(e / F.lit(2)).cast("bigint") * 3).alias("order_id"),
        F.when(F.col("event_type") == "error", "").otherwise(_text(e % 5 + 1)).alias("review_score"),
        F.lit(None).cast("string").alias("review_comment_title"), F.col("props").alias("review_comment_message"),
        F.concat(_text(F.to_date("ts")), F.lit(" 00:00:00")).alias("review_creation_date"),
        _text(F.col("ts")).alias("review_answer_timestamp"))


def _category() -> Column:
    name = F.concat(F.lower("p_type"), F.lit("_"), F.regexp_replace(F.lower("p_brand"), "#", "_"))
    return F.when(F.col("p_size") % 17 == 0, F.lit(None).cast("string")).otherwise(name)


def raw_products(t: Mapping[str, DataFrame]) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size")
    return t["part"].select(
        _text(k).alias("product_id"), _category().alias("product_category_name"),
        _text(F.length("p_name")).alias("product_name_lenght"), _text(size * 10 + k % 7).alias("product_description_lenght"),
        F.when(k % 41 == 0, "").otherwise(_text(k % 6 + 1)).alias("product_photos_qty"),
        F.when(k % 43 == 0, "").otherwise(_text((size * 15000 + k % 1000).cast("decimal(12,0)") / F.lit(100).cast("decimal(4,0)"))).alias("product_weight_g"),
        _text(size + 10).alias("product_length_cm"), _text(size + 5).alias("product_height_cm"), _text(size + 7).alias("product_width_cm"))


def raw_sellers(t: Mapping[str, DataFrame]) -> DataFrame:
    return t["supplier"].join(_places(t["nation"]), F.col("s_nationkey") == F.col("_nation")).select(
        _text(F.col("s_suppkey")).alias("seller_id"), F.col("zip").alias("seller_zip_code_prefix"),
        F.col("city").alias("seller_city"), F.col("state").alias("seller_state"))


def raw_translation(t: Mapping[str, DataFrame]) -> DataFrame:
    """English names of all categories but those of one brand."""
    known = t["part"].filter(F.col("p_brand") != "Brand#25").select(_category().alias("product_category_name"))
    return known.filter(F.col("product_category_name").isNotNull()).distinct().select(
        "product_category_name", F.regexp_replace("product_category_name", "_brand_", " no ").alias("product_category_name_english"))


def raw_geolocation(t: Mapping[str, DataFrame]) -> DataFrame:
    return _places(t["nation"]).select(
        F.col("zip").alias("geolocation_zip_code_prefix"), _text(F.col("_nation") * 2 - 25).alias("geolocation_lat"),
        _text(F.col("_nation") * 3 - 40).alias("geolocation_lng"), F.col("city").alias("geolocation_city"),
        F.col("state").alias("geolocation_state"))


BUILDERS = {
    "customers": raw_customers, "orders": raw_orders, "order_items": raw_order_items, "order_payments": raw_order_payments,
    "order_reviews": raw_order_reviews, "products": raw_products, "sellers": raw_sellers, "geolocation": raw_geolocation,
    "product_category_name_translation": raw_translation,
}

SOURCE_TABLES = ["nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def source_tables(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    folder = sf_dir.rstrip("/")
    return LazyTables({t: partial(spark.read.parquet, f"{folder}/{t}.parquet") for t in SOURCE_TABLES})


def raw_feed(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    """The nine raw tables, all text, lazily."""
    tables = source_tables(spark, sf_dir)

    def build(name: str) -> DataFrame:
        return BUILDERS[name](tables).select(*RAW_COLUMNS[name])

    return LazyTables({name: partial(build, name) for name in BUILDERS})


def feed_views(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    return clean_views(raw_feed(spark, sf_dir))
