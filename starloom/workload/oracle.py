"""SQL twins of the registered queries, for a second engine on the same tables.

Each twin starts from the generic tables and derives feed, views and star on its own. Ratios are
rounded with integers (half away from zero), so both engines agree to the last digit.
"""

from __future__ import annotations

SQL: dict[str, str] = {}


def scaled(num: str, den: str, digits: int) -> str:
    """num / den times 10^digits, rounded half away from zero, for integer num and positive den."""
    factor = 10**digits
    return (f"(CASE WHEN ({num}) < 0 THEN -1 ELSE 1 END * ((2 * abs(CAST(({num}) AS HUGEINT)) * {factor} + ({den})) // (2 * ({den}))))")


def ratio(num: str, den: str, digits: int) -> str:
    """Rounded num / den as DOUBLE; NULL for den = 0."""
    return f"(CASE WHEN ({den}) > 0 THEN CAST({scaled(num, den, digits)} AS DOUBLE) / {float(10**digits)} END)"


def cents(expr: str) -> str:
    """A two-digit decimal as a whole number of hundredths."""
    return f"CAST(({expr}) * 100 AS HUGEINT)"


def pct(part: str, whole: str, digits: int = 2) -> str:
    return ratio(f"100 * ({part})", whole, digits)


def mean(col: str, digits: int, divide_by: int = 1, keep: str = "TRUE") -> str:
    """Mean of a two-digit decimal column over rows that satisfy `keep`."""
    return ratio(f"coalesce(sum({cents(col)}) FILTER (WHERE {keep}), 0)", f"(count({col}) FILTER (WHERE {keep})) * {100 * divide_by}", digits)


def span(start: str, end: str, unit: int) -> str:
    """Rounded duration as DECIMAL(18,2)."""
    micros = f"(epoch_us({end}) - epoch_us({start}))"
    return f"CAST(CAST({scaled(micros, str(unit), 2)} AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2))"


HOUR, DAY = 3_600_000_000, 86_400_000_000

BASE = f"""
place AS (
  SELECT n_nationkey AS nation, lower(n_name) || ' d''oeste' AS city, chr(65 + n_nationkey) || chr(65 + n_regionkey) AS state,
         lpad(CAST(n_nationkey * 4000 + 17 AS VARCHAR), 5, '0') AS zip
  FROM nation
), line AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag, l_shipdate,
         CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(18,2)) AS price,
         CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS freight
  FROM lineitem
), person AS (
  SELECT 'c' || o_orderkey AS customer_id, CAST(o_custkey AS VARCHAR) AS uid, city, state, zip
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN place ON nation = CASE WHEN o_orderkey % 4 = 0 THEN (c_nationkey + 1 + o_orderkey % 3) % 25 ELSE c_nationkey END
  WHERE o_orderkey % 499 <> 0
), ship AS (
  SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey
), ord1 AS (
  SELECT o_orderkey AS k, 'c' || o_orderkey AS customer_id, o_orderdate,
         o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS purchase,
         CASE WHEN o_orderstatus = 'F' THEN 'delivered'
              WHEN o_orderstatus = 'O' THEN CASE WHEN o_orderpriority = '1-URGENT' THEN 'shipped' ELSE 'delivered' END
              ELSE CASE o_orderpriority WHEN '1-URGENT' THEN 'canceled' WHEN '2-HIGH' THEN 'unavailable'
                        WHEN '3-MEDIUM' THEN 'invoiced' WHEN '4-NOT SPECIFIED' THEN 'processing' ELSE 'lost' END END AS status,
         ((date_diff('day', o_orderdate, first_ship) % 20) + 20) % 20 AS lag_days,
         ((date_diff('day', first_ship, last_ship) % 70) + 70) % 70 AS transit_days
  FROM orders LEFT JOIN ship ON o_orderkey = l_orderkey
), ord2 AS (
  SELECT *, CASE WHEN k % 61 <> 0 THEN purchase + to_hours(k % 5) + to_minutes((k % 7) * 11) END AS approved,
         CASE WHEN status IN ('delivered', 'shipped') THEN purchase + to_days(CAST(lag_days - 1 AS INTEGER)) + to_hours(9) END AS carrier,
         date_trunc('day', o_orderdate) + to_days(45) AS estimated
  FROM ord1
), ord AS (
  SELECT CAST(k AS VARCHAR) AS order_id, customer_id, status, purchase, approved, carrier,
         CASE WHEN status = 'delivered' AND k % 89 <> 0 THEN carrier + to_days(CAST(transit_days AS INTEGER)) + to_hours(k % 24 - 2) END AS delivered,
         CAST(estimated AS TIMESTAMP) AS estimated
  FROM ord2
), item AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id, CAST(max(l_partkey) AS VARCHAR) AS product_id,
         CAST(max(l_suppkey) AS VARCHAR) AS seller_id,
         CAST(CASE WHEN l_linenumber = 7 AND max(l_quantity) = 50 THEN NULL ELSE sum(price) END AS DECIMAL(18,2)) AS price,
         CAST(sum(freight) AS DECIMAL(18,2)) AS freight_value
  FROM line GROUP BY l_orderkey, l_linenumber
), pay AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
         CAST(sum(CASE WHEN l_linenumber = 7 AND l_quantity = 50 THEN NULL
                       WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN CAST(round((price + freight) * CAST(0.9 AS DECIMAL(3,2)), 2) AS DECIMAL(18,2))
                       ELSE CAST(price + freight AS DECIMAL(18,2)) END) AS DECIMAL(22,2)) AS paid,
         count(*) AS payments
  FROM line GROUP BY l_orderkey
), review AS (
  SELECT order_id, score FROM (
    SELECT CAST((event_id // 2) * 3 AS VARCHAR) AS order_id, event_id % 5 + 1 AS score,
           row_number() OVER (PARTITION BY event_id // 2 ORDER BY CAST(ts AS DATE) DESC, ts DESC, event_id DESC) AS rn
    FROM events WHERE event_type <> 'error') WHERE rn = 1
), categorised AS (
  SELECT *, CASE WHEN p_size % 17 <> 0 THEN lower(p_type) || '_' || replace(lower(p_brand), '#', '_') END AS category FROM part
), english AS (
  SELECT DISTINCT category AS c, replace(category, '_brand_', ' no ') AS e FROM categorised WHERE p_brand <> 'Brand#25' AND category IS NOT NULL
), product AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, category AS category_name, coalesce(e, category, 'unknown') AS category_name_english,
         length(p_name) AS product_name_length, p_size * 10 + p_partkey % 7 AS product_description_length,
         CASE WHEN p_partkey % 41 <> 0 THEN p_partkey % 6 + 1 END AS product_photos_qty,
         CASE WHEN p_partkey % 43 <> 0 THEN CAST((p_size * 15000 + p_partkey % 1000) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) END AS product_weight_g,
         p_size + 10 AS product_length_cm, p_size + 5 AS product_height_cm, p_size + 7 AS product_width_cm
  FROM categorised LEFT JOIN english ON category = c
), seller AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, city AS seller_city, state AS seller_state, zip FROM supplier JOIN place ON nation = s_nationkey
), dd AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date, year(d) AS year, quarter(d) AS quarter,
         month(d) AS month, monthname(d) AS month_name, weekofyear(d) AS week_of_year, day(d) AS day_of_month,
         dayofweek(d) + 1 AS day_of_week, dayname(d) AS day_name, dayofweek(d) IN (0, 6) AS is_weekend
  FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d FROM (
    SELECT date_trunc('day', min(least(purchase, approved, carrier, delivered, estimated)))::TIMESTAMP AS lo,
           date_trunc('day', max(greatest(purchase, approved, carrier, delivered, estimated)))::TIMESTAMP AS hi FROM ord))
), dc AS (
  SELECT row_number() OVER (ORDER BY md5(uid), uid) AS customer_key, uid AS customer_unique_id, city AS customer_city, state AS customer_state, zip
  FROM (SELECT uid, city, state, zip, row_number() OVER (PARTITION BY uid ORDER BY count(*) DESC, city, state, zip) AS rn
        FROM person GROUP BY uid, city, state, zip) WHERE rn = 1
), dp AS (
  SELECT row_number() OVER (ORDER BY md5(product_id), product_id) AS product_key, * FROM product
), ds AS (
  SELECT row_number() OVER (ORDER BY md5(seller_id), seller_id) AS seller_key, * FROM seller
), fof AS (
  SELECT o.order_id, c.customer_key,
         d1.date_key AS order_purchase_date_key, d2.date_key AS order_approved_date_key, d3.date_key AS carrier_pickup_date_key,
         d4.date_key AS delivered_date_key, d5.date_key AS estimated_delivery_date_key,
         CASE WHEN approved >= purchase THEN {span('purchase', 'approved', HOUR)} END AS hours_to_approval,
         CASE WHEN carrier >= approved THEN {span('approved', 'carrier', HOUR)} END AS hours_to_carrier,
         CASE WHEN delivered >= carrier THEN {span('carrier', 'delivered', HOUR)} END AS hours_to_customer,
         CASE WHEN delivered >= purchase THEN {span('purchase', 'delivered', HOUR)} END AS total_fulfillment_hours,
         CASE WHEN delivered IS NOT NULL AND estimated IS NOT NULL THEN {span('estimated', 'delivered', DAY)} END AS days_vs_estimate,
         score AS review_score, status AS order_status, delivered <= estimated AS is_on_time, paid AS total_payment_value, payments AS payment_count
  FROM ord o LEFT JOIN person p ON o.customer_id = p.customer_id LEFT JOIN dc c ON p.uid = c.customer_unique_id
  LEFT JOIN review r ON o.order_id = r.order_id LEFT JOIN pay ON o.order_id = pay.order_id
  LEFT JOIN dd d1 ON d1.full_date = CAST(purchase AS DATE) LEFT JOIN dd d2 ON d2.full_date = CAST(approved AS DATE)
  LEFT JOIN dd d3 ON d3.full_date = CAST(carrier AS DATE) LEFT JOIN dd d4 ON d4.full_date = CAST(delivered AS DATE)
  LEFT JOIN dd d5 ON d5.full_date = CAST(estimated AS DATE)
), fs AS (
  SELECT i.order_id, i.order_item_id, f.customer_key, dp.product_key, ds.seller_key, f.order_purchase_date_key AS date_key, i.price, i.freight_value,
         CAST(coalesce(i.price, 0) + coalesce(i.freight_value, 0) AS DECIMAL(18,2)) AS sales_amount
  FROM item i LEFT JOIN fof f ON i.order_id = f.order_id LEFT JOIN dp ON i.product_id = dp.product_id LEFT JOIN ds ON i.seller_id = ds.seller_id
)"""


def add(name: str, select: str, ctes: str = "") -> None:
    SQL[name] = f"WITH {BASE.strip()}{', ' + ctes.strip() if ctes else ''}\n{select.strip()}"


def plain(name: str, sql: str) -> None:
    SQL[name] = sql.strip()


def d(expr: str, alias: str | None = None) -> str:
    return f"CAST({expr} AS DOUBLE) AS {alias or expr.split('.')[-1]}"


def b(expr: str, alias: str | None = None) -> str:
    return f"CAST({expr} AS BIGINT) AS {alias or expr.split('.')[-1]}"


def s(expr: str, alias: str | None = None) -> str:
    return f"CAST({expr} AS VARCHAR) AS {alias or expr.split('.')[-1]}"


def cols(*items: str) -> str:
    return ", ".join(items)


HOURS = ["hours_to_approval", "hours_to_carrier", "hours_to_customer", "total_fulfillment_hours"]
ROLE_KEYS = ["order_purchase_date_key", "order_approved_date_key", "carrier_pickup_date_key", "delivered_date_key", "estimated_delivery_date_key"]
PRODUCT_INTS = ["product_name_length", "product_description_length", "product_photos_qty"]
PRODUCT_NUMBERS = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]

# --- A ---------------------------------------------------------------------------------------------------

plain("a1_csv_scan_reviews", """
SELECT 'r' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS review_id, CAST((event_id // 2) * 3 AS VARCHAR) AS order_id,
       CASE WHEN event_type <> 'error' THEN CAST(event_id % 5 + 1 AS VARCHAR) END AS review_score, props AS review_comment_message,
       strftime(ts, '%Y-%m-%d') || ' 00:00:00' AS review_creation_date,
       CASE WHEN epoch_us(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') ELSE rtrim(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '0') END AS review_answer_timestamp
FROM events""")
add("a2_extract_with_bom", "SELECT status AS order_status, count(*) AS orders, min(order_id) AS first_order FROM ord GROUP BY status")
plain("a6_full_refresh", """SELECT 'orders' AS table_name, count(*) AS total_rows FROM orders
UNION ALL SELECT 'order_payments', count(*) FROM lineitem UNION ALL SELECT 'sellers', count(*) FROM supplier""")
plain("a4_extract_row_counts", """
SELECT 'customers' AS table_name, count(*) AS total_rows FROM orders JOIN customer ON o_custkey = c_custkey
UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'order_items', count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
UNION ALL SELECT 'order_payments', count(*) FROM lineitem
UNION ALL SELECT 'order_reviews', 0
UNION ALL SELECT 'products', count(*) FROM part
UNION ALL SELECT 'sellers', count(*) FROM supplier
UNION ALL SELECT 'geolocation', count(*) FROM nation
UNION ALL SELECT 'product_category_name_translation', count(*) FROM (SELECT DISTINCT p_type, p_brand FROM part WHERE p_size % 17 <> 0 AND p_brand <> 'Brand#25')""")
add("a7_typed_tables", f"SELECT CAST(date_key // 100 AS BIGINT) AS purchase_month, count(*) AS total_rows, {d('sum(sales_amount)', 'sales_amount')} FROM fs GROUP BY date_key // 100")
add("a8_published_star", """
SELECT 'dim_date' AS table_name, count(*) AS total_rows FROM dd UNION ALL SELECT 'dim_customer', count(*) FROM dc UNION ALL SELECT 'dim_product', count(*) FROM dp
UNION ALL SELECT 'dim_seller', count(*) FROM ds UNION ALL SELECT 'fact_sales', count(*) FROM fs UNION ALL SELECT 'fact_order_fulfillment', count(*) FROM fof""")
add("a9_view_layer", f"SELECT status AS order_status, count(*) AS orders, count(pay.order_id) AS paid_orders, {d('sum(paid)', 'paid')} FROM ord LEFT JOIN pay ON ord.order_id = pay.order_id GROUP BY status")
add("a10_violation_rows", f"SELECT order_id, {b('carrier_pickup_date_key')}, {b('delivered_date_key')}, order_status FROM fof WHERE carrier_pickup_date_key > delivered_date_key")
add("a12_parameter_query", f"SELECT customer_state, count(*) AS orders, {d('sum(total_payment_value)', 'paid')} FROM fof JOIN dc ON fof.customer_key = dc.customer_key WHERE order_status = 'delivered' AND order_purchase_date_key >= 19970101 GROUP BY customer_state")

STAGING_TESTS = """
SELECT 'vw_customers_empty' AS test_name, CAST(count(*) = 0 AS BIGINT) AS failed_rows FROM person
UNION ALL SELECT 'vw_orders_empty', CAST(count(*) = 0 AS BIGINT) FROM ord
UNION ALL SELECT 'orders_null_order_id', count(*) FROM ord WHERE order_id IS NULL
UNION ALL SELECT 'duplicate_orders', count(*) FROM (SELECT order_id FROM ord GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'duplicate_order_items', count(*) FROM (SELECT order_id, order_item_id FROM item GROUP BY 1, 2 HAVING count(*) > 1)"""
add("a13_sql_suite", STAGING_TESTS)

# --- B ---------------------------------------------------------------------------------------------------

STAMPS = {"purchase": "order_purchase_timestamp", "approved": "order_approved_at", "carrier": "order_delivered_carrier_date",
          "delivered": "order_delivered_customer_date", "estimated": "order_estimated_delivery_date"}
add("b1_orders_typed", f"SELECT order_id, customer_id, status AS order_status, {cols(*[s(c, a) for c, a in STAMPS.items()])} FROM ord")
PRODUCT = f"product_id, category_name, category_name_english, {cols(*[b(c) for c in PRODUCT_INTS])}, {cols(*[d(c) for c in PRODUCT_NUMBERS])}"
add("b2_products_typed", f"SELECT {PRODUCT} FROM product")
add("b3_items_typed", f"SELECT order_id, {b('order_item_id')}, product_id, seller_id, {d('price')}, {d('freight_value')} FROM item")
add("b4_customers_trimmed", "SELECT customer_id, uid AS customer_unique_id, city AS customer_city, state AS customer_state, zip AS customer_zip_code_prefix FROM person")
add("b5_sellers_trimmed", "SELECT seller_id, seller_city, seller_state, zip AS seller_zip_code_prefix FROM seller")
add("b6_category_fallback", "SELECT category_name_english, count(*) AS products, count(category_name) AS named FROM product GROUP BY 1")
add("b7_null_safe_amount", f"SELECT order_id, {b('order_item_id')}, {d('coalesce(price, 0) + coalesce(freight_value, 0)', 'sales_amount')} FROM item")
add("b8_lifecycle_measures", f"SELECT order_id, {cols(*[d(h) for h in HOURS])}, {d('days_vs_estimate')}, is_on_time FROM fof")
add("b11_predicates", f"""SELECT order_status, {b('review_score')}, count(*) AS orders FROM fof WHERE review_score BETWEEN 1 AND 4 AND order_status IN ('delivered', 'shipped', 'lost')
AND order_id NOT IN ('3', '6') AND customer_key IS NOT NULL AND order_purchase_date_key >= 19960101 GROUP BY order_status, review_score""")
add("b12_null_safe_difference", f"SELECT price IS NULL AS price_missing, count(*) AS items, {d('sum(sales_amount)', 'sales_amount')} FROM fs WHERE price IS DISTINCT FROM sales_amount GROUP BY 1")
add("b13_status_label", "SELECT CASE WHEN is_on_time THEN 'On Time' ELSE 'Late' END AS delivery_status, count(*) AS orders FROM fof GROUP BY 1")
WEIGHT = "CASE WHEN product_weight_g < 1000 THEN '< 1kg' WHEN product_weight_g <= 5000 THEN '1-5kg' WHEN product_weight_g > 5000 THEN '> 5kg' ELSE 'unknown' END"
PHOTOS = "CASE WHEN product_photos_qty = 1 THEN '1 photo' WHEN product_photos_qty BETWEEN 2 AND 4 THEN '2-4 photos' WHEN product_photos_qty >= 5 THEN '5+ photos' ELSE 'unknown' END"
add("b14_size_buckets", f"SELECT {WEIGHT} AS weight, {PHOTOS} AS photos, count(*) AS products FROM dp GROUP BY 1, 2")

# --- C, D --------------------------------------------------------------------------------------------------

plain("c1_modal_row", """SELECT user_id, event_type FROM (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS rn
FROM events GROUP BY user_id, event_type) WHERE rn = 1""")
plain("c2_latest_row", """SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
plain("c3_duplicate_keys", "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS occurrences FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
add("d1_lookup_join", "SELECT product_id, category_name, category_name_english FROM product")
add("d2_key_resolution", f"""SELECT i.order_id, {b('i.order_item_id')}, c.customer_key FROM item i LEFT JOIN ord o ON i.order_id = o.order_id
LEFT JOIN person p ON o.customer_id = p.customer_id LEFT JOIN dc c ON p.uid = c.customer_unique_id""")
_ROLES = {"order_purchase_date_key": "purchase", "order_approved_date_key": "approved", "carrier_pickup_date_key": "carrier",
          "delivered_date_key": "delivered", "estimated_delivery_date_key": "estimated"}
add("d3_role_playing_join", "SELECT order_id, " + cols(*[b(f"{a}_d.date_key", r) for r, a in _ROLES.items()]) + " FROM ord " + " ".join(
    f"LEFT JOIN short_dd {a}_d ON {a}_d.full_date = CAST(ord.{a} AS DATE)" for a in _ROLES.values()),
    "short_dd AS (SELECT date_key, full_date FROM dd WHERE full_date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31')")
add("d4_fact_to_dimension", f"SELECT seller_state, {d('sum(sales_amount)', 'sales_amount')}, count(*) AS items FROM fs JOIN ds ON fs.seller_key = ds.seller_key GROUP BY seller_state")
plain("d7_anti_join", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem) ON o_orderkey = l_orderkey WHERE l_orderkey IS NULL")
add("d8_two_totals", "SELECT a.n AS on_time_orders, t.n AS total_orders FROM (SELECT count(*) AS n FROM fof WHERE is_on_time) a, (SELECT count(*) AS n FROM fof) t")
plain("d10_calendar_gaps", """WITH days AS (SELECT DISTINCT o_orderpriority AS priority, o_orderstatus AS status, CAST(o_orderdate AS DATE) AS day FROM orders),
ends AS (SELECT priority, status, min(day)::TIMESTAMP AS lo, max(day)::TIMESTAMP AS hi FROM days GROUP BY ALL),
expected AS (SELECT priority, status, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM ends)
SELECT priority, status, CAST(day AS VARCHAR) AS missing_date FROM (SELECT * FROM expected EXCEPT SELECT * FROM days)""")

# --- E -------------------------------------------------------------------------------------------------------

add("e1_global_aggregates", f"SELECT count(*) AS items, {d('sum(sales_amount)', 'total')}, {d('min(price)', 'lowest')}, {d('max(price)', 'highest')}, {mean('price', 2)} AS mean FROM fs")
add("e2_grouped_payments", f"SELECT order_id, {d('paid', 'total_payment_value')}, {b('payments', 'payment_count')} FROM pay")
add("e3_distinct_counts", f"SELECT {b('date_key')}, count(DISTINCT order_id) AS orders, count(DISTINCT product_key) AS products FROM fs GROUP BY date_key")
plain("e4_distinct_row_values", """SELECT sum(n) :: BIGINT AS total_rows, count(*) AS distinct_pairs FROM
(SELECT CASE WHEN l_returnflag <> 'N' THEN l_orderkey END AS a, l_linenumber AS b, count(*) AS n FROM lineitem GROUP BY 1, 2)""")
add("e5_filtered_aggregates", f"""SELECT order_status, count(*) FILTER (WHERE is_on_time) AS on_time, count(*) FILTER (WHERE NOT is_on_time) AS late,
{d('sum(total_payment_value) FILTER (WHERE is_on_time)', 'on_time_paid')} FROM fof GROUP BY order_status""")
add("e6_filtered_distinct", """SELECT count(DISTINCT customer_key) FILTER (WHERE order_status = 'delivered') AS delivered_customers,
count(DISTINCT customer_key) FILTER (WHERE order_status = 'canceled') AS canceled_customers FROM fof""")
add("e7_having", f"SELECT order_id, {d('sum(sales_amount)', 'total')}, count(*) AS items FROM fs GROUP BY order_id HAVING count(*) >= 5 AND sum(sales_amount) > 300000")
add("e8_group_by_expression", f"SELECT {ratio(cents('total_fulfillment_hours'), '2400', 0)} AS days, count(*) AS orders FROM fof WHERE total_fulfillment_hours IS NOT NULL GROUP BY 1")
PER_CUSTOMER = "per_customer AS (SELECT dc.customer_unique_id, count(DISTINCT fof.order_id) AS order_count FROM fof JOIN dc ON fof.customer_key = dc.customer_key GROUP BY 1)"
add("e9_orders_histogram", "SELECT CAST(order_count AS BIGINT) AS order_count, count(*) AS customers FROM per_customer GROUP BY 1", PER_CUSTOMER)
add("e13_status_counts", "SELECT order_status, count(*) AS order_count FROM fof GROUP BY 1")
add("e14_duration_percentiles", """SELECT order_status, count(*) AS order_count, quantile_cont(CAST(total_fulfillment_hours AS DOUBLE), 0.5) AS p50,
quantile_cont(CAST(total_fulfillment_hours AS DOUBLE), 0.9) AS p90 FROM fof WHERE total_fulfillment_hours IS NOT NULL GROUP BY 1""")
DELIVERED = "order_status = 'delivered' AND delivered_date_key IS NOT NULL"
add("e15_delay_score_correlation", f"SELECT round(corr(CAST(days_vs_estimate AS DOUBLE), CAST(review_score AS DOUBLE)), 6) AS corr_delay_score FROM fof WHERE {DELIVERED}")

# --- F, G ----------------------------------------------------------------------------------------------------

plain("f4_row_numbers", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) AS row_no FROM orders")
plain("f6_running_total", "SELECT o_orderkey, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) OVER (ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_total FROM orders")
plain("f8_ntile", "SELECT c_custkey, c_acctbal, CAST(ntile(5) OVER (ORDER BY c_acctbal, c_custkey) AS BIGINT) AS quintile FROM customer")
add("g1_null_order", f"SELECT CAST(rn AS BIGINT) AS rank_no, order_id, {d('days_vs_estimate')} FROM (SELECT *, row_number() OVER (ORDER BY days_vs_estimate DESC NULLS FIRST, order_id) AS rn FROM fof) WHERE rn <= 50")
ORDER_VALUES = f"order_values AS (SELECT f.order_id, f.total_payment_value, a.total_sales, a.item_count FROM fof f JOIN (SELECT order_id, sum(sales_amount) AS total_sales, count(*) AS item_count FROM fs GROUP BY 1) a ON f.order_id = a.order_id)"
VALUES_OUT = f"order_id, {d('total_payment_value')}, {d('total_sales')}, {b('item_count')}"
add("g3_top_orders", f"SELECT {VALUES_OUT} FROM (SELECT * FROM order_values ORDER BY total_sales DESC, order_id LIMIT 10)", ORDER_VALUES)
add("g4_violation_extract", f"SELECT order_id, {b('order_item_id')}, {d('price')} FROM fs WHERE price IS NULL")
CATEGORY = f"""category_perf AS (SELECT category_name_english AS category, coalesce(sum(sales_amount), 0) AS total_revenue, count(order_item_id) AS total_quantity
FROM dp JOIN fs ON dp.product_key = fs.product_key WHERE category_name_english IS NOT NULL GROUP BY 1)"""


def _ranked(name: str, source: str, order: str, out: str, ctes: str, k: int | None = None) -> None:
    limit = f" WHERE rank_no <= {k}" if k else ""
    add(name, f"SELECT CAST(rank_no AS BIGINT) AS rank_no, {out} FROM (SELECT *, row_number() OVER (ORDER BY {order}) AS rank_no FROM {source}){limit}", ctes)


CATEGORY_OUT = f"category, {d('total_revenue')}, {b('total_quantity')}"
_ranked("g5_categories_by_name", "category_perf", "category", CATEGORY_OUT, CATEGORY)
_ranked("g5_categories_by_quantity", "category_perf", "total_quantity DESC, category", CATEGORY_OUT, CATEGORY, 10)

# --- I ---------------------------------------------------------------------------------------------------------

TITLE = "array_to_string(list_transform(regexp_extract_all(lower({c}), '([a-z0-9]+|[^a-z0-9]+)'), lambda x: upper(x[1]) || x[2:]), '')"
add("i2_title_case", f"SELECT {TITLE.format(c='city')} AS city, count(*) AS records FROM person GROUP BY 1")
add("i11_place_labels", "SELECT seller_city || ' (' || seller_state || ')' AS label, count(*) AS sellers FROM ds GROUP BY 1")
plain("i12_number_or_zero", """SELECT event_type, sum(coalesce(TRY_CAST(v AS DOUBLE), 0)) AS total FROM
(SELECT event_type, CASE WHEN event_id % 10 = 0 THEN event_type ELSE regexp_extract(props, ': *([^}]*)[}]', 1) END AS v FROM events) GROUP BY 1""")
add("i13_guarded_division", f"""SELECT l_returnflag, {b('l_linenumber')}, CASE WHEN l_linenumber > 1 THEN {ratio(f"sum({cents('freight')})", f"sum({cents('price')})", 6)} END AS ratio
FROM line GROUP BY l_returnflag, l_linenumber""")
_PATTERNS = [("dim_customer", "zip_code_prefix", r"^\d{5}$", "dc", "zip"), ("dim_seller", "zip_code_prefix", r"^\d{5}$", "ds", "zip"),
             ("dim_customer", "customer_state", "^[A-Z]{2}$", "dc", "customer_state"), ("dim_seller", "seller_state", "^[A-Z]{2}$", "ds", "seller_state")]
add("i14_strict_formats", " UNION ALL ".join(
    f"SELECT 'Pattern {p}: {t}.{c}' AS name, count({col}) AS total_evaluated, count(*) FILTER (WHERE NOT regexp_matches({col}, '{p}')) AS failed_count, "
    f"CASE WHEN count(*) FILTER (WHERE NOT regexp_matches({col}, '{p}')) = 0 THEN 'PASS' ELSE 'WARNING' END AS status FROM {src}"
    for t, c, p, src, col in _PATTERNS))

# --- J ---------------------------------------------------------------------------------------------------------

DATE_OUT = cols(b("date_key"), s("full_date"), *[b(c) for c in ["year", "quarter", "month"]], "month_name", *[b(c) for c in ["week_of_year", "day_of_month", "day_of_week"]], "day_name", "is_weekend")
add("j1_dim_date", f"SELECT {DATE_OUT} FROM dd WHERE full_date BETWEEN (SELECT min(CAST(o_orderdate AS DATE)) FROM orders) AND (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)")
add("j2_dim_customer", "SELECT customer_key, customer_unique_id, customer_city, customer_state, zip AS zip_code_prefix FROM dc")
add("j3_dim_product", f"SELECT product_key, {PRODUCT} FROM dp")
add("j4_dim_seller", "SELECT seller_key, seller_id, seller_city, seller_state, zip AS zip_code_prefix FROM ds")
add("j6_surrogate_keys", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS total_rows, CAST(1 AS BIGINT) AS first_key, count(*) AS last_key, count(*) AS distinct_keys FROM {src}"
    for t, src in [("dim_customer", "dc"), ("dim_product", "dp"), ("dim_seller", "ds"), ("fact_sales", "fs"), ("fact_order_fulfillment", "fof")]))
plain("j6_row_keys", "SELECT count(*) AS total_rows, CAST(1 AS BIGINT) AS first_key, count(*) AS last_key, count(*) AS distinct_keys FROM lineitem")
add("j8_reviews_latest", f"SELECT order_id, {b('score', 'review_score')} FROM review")
SALES_OUT = cols("order_id", b("order_item_id"), "customer_key", "product_key", "seller_key", b("date_key"), d("price"), d("freight_value"), d("sales_amount"))
add("j9_fact_sales", f"SELECT {SALES_OUT} FROM fs")
FOF_OUT = cols("order_id", "customer_key", *[b(k) for k in ROLE_KEYS], *[d(h) for h in HOURS], d("days_vs_estimate"), b("review_score"), "order_status", "is_on_time", d("total_payment_value"), b("payment_count"))
add("j10_fact_order_fulfillment", f"SELECT {FOF_OUT} FROM fof")
add("j10_published_fulfillment", f"SELECT {FOF_OUT} FROM fof")

# --- K -----------------------------------------------------------------------------------------------------------

SOURCES = {"dim_customer": "dc", "dim_date": "dd", "dim_product": "dp", "dim_seller": "ds", "fact_sales": "fs", "fact_order_fulfillment": "fof"}


def _checks(name: str, category: str, rows: list[tuple[int, str, str, str]], notes: dict[int, str] | None = None) -> None:
    """rows: (number, check name, severity, SELECT giving evaluated and failed)."""
    notes = notes or {}
    parts = [
        f"SELECT CAST({no} AS BIGINT) AS check_no, '{category}' AS category, '{title}' AS name, evaluated AS total_evaluated, failed AS failed_count, '{severity}' AS severity, "
        f"CASE WHEN evaluated = 0 THEN 0.0 ELSE round(CAST(failed AS DOUBLE) / evaluated * 100, 6) END AS error_pct, "
        f"CASE WHEN failed = 0 THEN 'PASS' WHEN '{severity}' = 'CRITICAL' THEN 'FAIL' ELSE 'WARNING' END AS status, {notes.get(no, repr(''))} AS notes FROM ({sql})"
        for no, title, severity, sql in rows]
    add(name, "\nUNION ALL ".join(parts))


def _share(table: str, failed: str, evaluated: str = "TRUE") -> str:
    return f"SELECT count(*) FILTER (WHERE {evaluated}) AS evaluated, count(*) FILTER (WHERE {failed}) AS failed FROM {table}"


_KEYS = [("dim_customer", "customer_key"), ("dim_date", "date_key"), ("dim_product", "product_key"), ("dim_seller", "seller_key"), ("fact_sales", "sales_key"), ("fact_order_fulfillment", "fulfillment_key")]
_FKS = [("fact_sales", "customer_key", "dim_customer"), ("fact_sales", "product_key", "dim_product"), ("fact_sales", "seller_key", "dim_seller"), ("fact_sales", "date_key", "dim_date"),
        ("fact_order_fulfillment", "customer_key", "dim_customer"), *[("fact_order_fulfillment", k, "dim_date") for k in ROLE_KEYS]]
_PK_OF = dict(_KEYS)
_rows = [(i, f"PK Unique & Not Null: {t}.{k}", "CRITICAL",
          f"SELECT count(*) AS evaluated, CAST(0 AS BIGINT) AS failed FROM {SOURCES[t]}" if t.startswith("fact") else
          f"SELECT count(*) AS evaluated, count(*) - count(DISTINCT {k}) + count(*) FILTER (WHERE {k} IS NULL) AS failed FROM {SOURCES[t]}") for i, (t, k) in enumerate(_KEYS, start=1)]
_rows.append((7, "Fact Sales Grain Unique: (order_id, order_item_id)", "CRITICAL", "SELECT count(*) AS evaluated, count(*) - count(DISTINCT (order_id, order_item_id)) AS failed FROM fs"))
_rows += [(8 + i, f"FK Orphan: {f}.{k} -> {dim}.{_PK_OF[dim]}", "CRITICAL",
           f"SELECT count(f.{k}) AS evaluated, count(*) FILTER (WHERE f.{k} IS NOT NULL AND x.{_PK_OF[dim]} IS NULL) AS failed FROM {SOURCES[f]} f LEFT JOIN {SOURCES[dim]} x ON f.{k} = x.{_PK_OF[dim]}")
          for i, (f, k, dim) in enumerate(_FKS)]
_checks("k1_k3_key_checks", "1. Key & RI", _rows, {i: "'Dups: 0, Nulls: 0'" for i in range(1, 7)})

_ALL = {
    "dim_customer": ["customer_key", "customer_unique_id", "customer_city", "customer_state", "zip_code_prefix"],
    "dim_date": ["date_key", "full_date", "year", "quarter", "month", "month_name", "week_of_year", "day_of_month", "day_of_week", "day_name", "is_weekend"],
    "dim_product": ["product_key", "product_id", "category_name", "category_name_english", *PRODUCT_INTS, *PRODUCT_NUMBERS],
    "dim_seller": ["seller_key", "seller_id", "seller_city", "seller_state", "zip_code_prefix"],
    "fact_sales": ["sales_key", "order_id", "order_item_id", "customer_key", "product_key", "seller_key", "date_key", "price", "freight_value", "sales_amount"],
    "fact_order_fulfillment": ["fulfillment_key", "order_id", "customer_key", *ROLE_KEYS, *HOURS, "days_vs_estimate", "review_score", "order_status", "is_on_time", "total_payment_value", "payment_count"],
}
_MANDATORY = {
    "dim_customer": _ALL["dim_customer"][:2], "dim_date": _ALL["dim_date"], "dim_product": _ALL["dim_product"][:2], "dim_seller": _ALL["dim_seller"][:2],
    "fact_sales": _ALL["fact_sales"], "fact_order_fulfillment": ["fulfillment_key", "order_id", "customer_key", "order_purchase_date_key", "order_status"],
}
_TYPES = {
    **{c: "string" for c in ["customer_unique_id", "customer_city", "customer_state", "zip_code_prefix", "month_name", "day_name", "product_id", "category_name", "category_name_english",
                             "seller_id", "seller_city", "seller_state", "order_id", "order_status"]},
    **{c: "int" for c in ["date_key", *ROLE_KEYS, *PRODUCT_INTS]}, **{c: "bigint" for c in ["customer_key", "product_key", "seller_key", "sales_key", "fulfillment_key", "payment_count"]},
    **{c: "smallint" for c in ["year", "quarter", "month", "week_of_year", "day_of_month", "day_of_week", "order_item_id", "review_score"]},
    **{c: "decimal(8,2)" for c in [*HOURS, "days_vs_estimate", *PRODUCT_NUMBERS[1:]]}, **{c: "decimal(18,2)" for c in ["price", "freight_value", "sales_amount"]},
    "full_date": "date", "is_weekend": "boolean", "is_on_time": "boolean", "product_weight_g": "decimal(10,2)", "total_payment_value": "decimal(22,2)",
}


def _null_test(column: str) -> str:
    if column in ("sales_key", "fulfillment_key"):
        return "FALSE"
    return f"{'zip' if column == 'zip_code_prefix' else column} IS NULL"


_rows = []
for _t, _cs in _MANDATORY.items():
    for _c in _cs:
        _rows.append((18 + len(_rows), f"Mandatory Column Not Null: {_t}.{_c}", "CRITICAL", _share(SOURCES[_t], _null_test(_c))))
_checks("k4_mandatory_columns", "2. Null Checks", _rows)
add("k5_null_profile", "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{_TYPES[c]}' AS data_type, count(*) AS total_rows, count(*) FILTER (WHERE {_null_test(c)}) AS null_count, "
    f"{pct(f'count(*) FILTER (WHERE {_null_test(c)})', 'count(*)')} AS null_pct, {c in _MANDATORY[t]} AS is_mandatory FROM {SOURCES[t]}" for t, cs in _ALL.items() for c in cs))
_ANY_HOURS = " OR ".join(f"{h} IS NOT NULL" for h in HOURS)
_ALL_HOURS = " AND ".join(f"{h} IS NOT NULL" for h in HOURS)
_NEGATIVE = " OR ".join(f"{h} < 0" for h in HOURS)
_BOTH = "is_on_time IS NOT NULL AND days_vs_estimate IS NOT NULL"
STATUSES = "('delivered', 'shipped', 'canceled', 'unavailable', 'invoiced', 'processing', 'created', 'approved')"
_checks("k6_k12_business_rules", "3. Business Rules", [
    (50, "Non-negative values: price, freight, sales_amount", "CRITICAL", _share("fs", "price < 0 OR freight_value < 0 OR sales_amount < 0")),
    (51, "Sales Amount Match: sales_amount == price + freight (tol 0.01)", "CRITICAL", _share("fs", "abs(sales_amount - (price + freight_value)) > 0.01")),
    (52, "Non-negative hours in fact_order_fulfillment", "CRITICAL", _share("fof", _NEGATIVE, _ANY_HOURS)),
    (53, "Fulfillment Hours Additivity: total == sum(stages) (tol 0.05h)", "WARNING",
     _share("fof", f"{_ALL_HOURS} AND abs(total_fulfillment_hours - (hours_to_approval + hours_to_carrier + hours_to_customer)) > 0.05", _ALL_HOURS)),
    (54, "Review Score Range: 1 <= review_score <= 5", "WARNING", _share("fof", "review_score NOT BETWEEN 1 AND 5", "review_score IS NOT NULL")),
    (55, "Valid order_status Domain", "WARNING", _share("fof", f"order_status IS NULL OR order_status NOT IN {STATUSES}")),
    (56, "On-Time Consistency: is_on_time vs days_vs_estimate", "WARNING",
     _share("fof", f"{_BOTH} AND ((days_vs_estimate < -0.01 AND NOT is_on_time) OR (days_vs_estimate > 0.01 AND is_on_time))", _BOTH)),
    (57, "Payment Count >= 1 when total_payment_value > 0", "WARNING", _share("fof", "total_payment_value > 0 AND (payment_count IS NULL OR payment_count < 1)", "total_payment_value > 0")),
], {55: "'Distinct values: ' || (SELECT count(DISTINCT order_status) FROM fof) || ', with their counts in business_order_status_counts.csv'"})
_LATE_NOTES = {59: "'Known source logging anomaly (carrier dispatched before approval logged)'", 60: "'Known source logging anomaly (carrier scan logged post-delivery)'"}


def _later(early: str, late: str) -> str:
    return _share("fof", f"{early} > {late}", f"{early} IS NOT NULL AND {late} IS NOT NULL")


_checks("k16_date_order", "4. Date Logic", [
    (58, "Timeline: purchase_date_key <= approved_date_key", "CRITICAL", _later(ROLE_KEYS[0], ROLE_KEYS[1])),
    (59, "Timeline: approved_date_key <= carrier_date_key", "WARNING", _later(ROLE_KEYS[1], ROLE_KEYS[2])),
    (60, "Timeline: carrier_date_key <= delivered_date_key", "WARNING", _later(ROLE_KEYS[2], ROLE_KEYS[3])),
], _LATE_NOTES)
_checks("k17_k19_calendar", "5. Dim Date", [
    (61, "Date Key Format Match: date_key == YYYYMMDD(full_date)", "CRITICAL", _share("dd", "CAST(strftime(full_date, '%Y%m%d') AS INTEGER) <> date_key")),
    (62, "No Calendar Gaps in dim_date (full_date continuous)", "CRITICAL",
     "SELECT CAST(date_diff('day', min(full_date), max(full_date)) + 1 AS BIGINT) AS evaluated, CAST(date_diff('day', min(full_date), max(full_date)) + 1 - count(DISTINCT full_date) AS BIGINT) AS failed FROM dd"),
    (63, "Dim Date Range Covers Fact Dates", "CRITICAL",
     "SELECT CAST(1 AS BIGINT) AS evaluated, CAST(NOT (min(order_purchase_date_key) >= (SELECT min(date_key) FROM dd) AND max(order_purchase_date_key) <= (SELECT max(date_key) FROM dd)) AS BIGINT) AS failed FROM fof"),
], {63: "(SELECT 'Fact range: [' || min(order_purchase_date_key) || '..' || max(order_purchase_date_key) || '], Dim range: [' || (SELECT min(date_key) FROM dd) || '..' || (SELECT max(date_key) FROM dd) || ']' FROM fof)"})
_rows = [(64, "Zip Code Length == 5: dim_customer.zip_code_prefix", "CRITICAL", _share("dc", "length(trim(zip)) <> 5", "zip IS NOT NULL")),
         (65, "Zip Code Length == 5: dim_seller.zip_code_prefix", "CRITICAL", _share("ds", "length(trim(zip)) <> 5", "zip IS NOT NULL")),
         (66, "State Code Length == 2: dim_customer.customer_state", "CRITICAL", _share("dc", "length(trim(customer_state)) <> 2", "customer_state IS NOT NULL")),
         (67, "State Code Length == 2: dim_seller.seller_state", "CRITICAL", _share("ds", "length(trim(seller_state)) <> 2", "seller_state IS NOT NULL"))]
for _i, (_t, _c) in enumerate([("dim_customer", "customer_city"), ("dim_seller", "seller_city"), ("dim_product", "category_name"), ("dim_product", "category_name_english")]):
    _rows.append((68 + _i, f"No Untrimmed Spaces: {_t}.{_c}", "WARNING", _share(SOURCES[_t], f"{_c} <> trim({_c})", f"{_c} IS NOT NULL")))
_checks("k13_k15_formats", "6. Formatting", _rows)
RECON = """recon AS (SELECT f.order_id, order_status, total_sales_amount, total_payment_value, abs(total_sales_amount - total_payment_value) AS diff,
coalesce(total_payment_value > 0 AND abs(total_sales_amount - total_payment_value) * 100 > total_payment_value, FALSE) AS differs
FROM fof f JOIN (SELECT order_id, sum(sales_amount) AS total_sales_amount FROM fs GROUP BY 1) s ON f.order_id = s.order_id)"""
add("k20_reconciliation", """SELECT CAST(72 AS BIGINT) AS check_no, '7. Reconciliation' AS category, 'Order Sales vs Payment Discrepancy (> 1% diff)' AS name, count(*) AS total_evaluated,
count(*) FILTER (WHERE differs) AS failed_count, 'WARNING' AS severity, round(CAST(count(*) FILTER (WHERE differs) AS DOUBLE) / count(*) * 100, 6) AS error_pct,
CASE WHEN count(*) FILTER (WHERE differs) = 0 THEN 'PASS' ELSE 'WARNING' END AS status, 'Occurs due to voucher discounts and split installment adjustments in raw source' AS notes FROM recon""", RECON)
add("k20_reconciliation_rows", f"SELECT order_id, order_status, {d('total_sales_amount')}, {d('total_payment_value')}, {d('diff', 'diff_amount')}, {pct(cents('diff'), cents('total_payment_value'))} AS diff_percent FROM recon WHERE differs", RECON)
_PARTS = ["k1_k3_key_checks", "k4_mandatory_columns", "k6_k12_business_rules", "k13_k15_formats", "k16_date_order", "k17_k19_calendar", "k20_reconciliation"]
_BODY = "\nUNION ALL ".join(f"({SQL[p]})" for p in _PARTS)
plain("k21_verdict", f"""SELECT count(*) AS total_checks, count(*) FILTER (WHERE failed_count = 0) AS passed, count(*) FILTER (WHERE failed_count > 0 AND severity = 'WARNING') AS warnings,
count(*) FILTER (WHERE failed_count > 0 AND severity = 'CRITICAL') AS critical_failures FROM ({_BODY})""")
plain("a14_staged_run", f"SELECT check_no, name, total_evaluated, failed_count, status FROM ({_BODY})")
plain("k2_grain_of_lines", "SELECT count(*) AS total_evaluated, count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS failed_count FROM lineitem")
_conditions = [(i, f"not empty: {t}", f"SELECT count(*) AS n FROM {SOURCES[t]}", "n = 0") for i, t in enumerate(["dim_date", "dim_customer", "dim_product", "dim_seller", "fact_sales", "fact_order_fulfillment"], start=1)]
for _i, (_t, _k) in enumerate([("dim_customer", "customer_unique_id"), ("dim_product", "product_id"), ("dim_seller", "seller_id")], start=7):
    _conditions.append((_i, f"unique: {_t}.{_k}", f"SELECT count(*) AS n FROM (SELECT {_k} FROM {SOURCES[_t]} GROUP BY 1 HAVING count(*) > 1)", "n > 0"))
_conditions += [
    (10, "grain: fact_sales (order_id, order_item_id)", "SELECT count(*) AS n FROM (SELECT order_id, order_item_id FROM fs GROUP BY 1, 2 HAVING count(*) > 1)", "n > 0"),
    (11, "grain: fact_order_fulfillment (order_id)", "SELECT count(*) AS n FROM (SELECT order_id FROM fof GROUP BY 1 HAVING count(*) > 1)", "n > 0"),
    (12, "rows: fact_sales <= order_items", "SELECT count(*) AS n FROM fs", "n > (SELECT count(*) FROM item)"),
    (13, "rows: fact_order_fulfillment <= orders", "SELECT count(*) AS n FROM fof", "n > (SELECT count(*) FROM orders)"),
    *[(14 + i, f"no orphans: {f}.{k} -> {dim}", f"SELECT count(*) AS n FROM {SOURCES[f]} f LEFT JOIN {SOURCES[dim]} x ON f.{k} = x.{_PK_OF[dim]} WHERE f.{k} IS NOT NULL AND x.{_PK_OF[dim]} IS NULL", "n > 0")
      for i, (f, k, dim) in enumerate(_FKS[:6])],
    (20, "no negative durations", f"SELECT count(*) AS n FROM fof WHERE {_NEGATIVE}", "n > 0"),
    (21, "every eligible item is loaded", "SELECT (SELECT count(*) FROM item) - count(*) AS n FROM fs", "n <> 0"),
]
add("k22_k24_prepublish", "\nUNION ALL ".join(f"SELECT CAST({no} AS BIGINT) AS condition_no, '{name}' AS condition, n AS found, {test} AS failed FROM ({sql})" for no, name, sql, test in _conditions))
add("k25_source_reconciliation", """SELECT count(*) FILTER (WHERE o_orderkey IS NULL) AS orphan_orders,
count(*) FILTER (WHERE o_orderkey IS NOT NULL AND c_custkey IS NULL) AS orphan_customers,
count(*) FILTER (WHERE c_custkey IS NOT NULL AND o_orderkey % 499 = 0) AS orphan_dim_customer
FROM item LEFT JOIN orders ON item.order_id = CAST(o_orderkey AS VARCHAR) LEFT JOIN customer ON o_custkey = c_custkey""")


def _dups(name: str, table: str, keys: str) -> str:
    return f"SELECT '{name}' AS test_name, count(*) AS failed_rows FROM (SELECT {keys} FROM {table} GROUP BY {keys} HAVING count(*) > 1)"


def _where(name: str, table: str, condition: str) -> str:
    return f"SELECT '{name}' AS test_name, count(*) AS failed_rows FROM {table} WHERE {condition}"


_ORPHAN_TESTS = ["fact_sales_orphan_customer_key", "fact_sales_orphan_product_key", "fact_sales_orphan_seller_key", "fact_sales_orphan_date_key", "fulfillment_orphan_customer_key",
                 "fulfillment_orphan_purchase_date_key", "fulfillment_orphan_approved_date_key", "fulfillment_orphan_carrier_date_key", "fulfillment_orphan_delivered_date_key", "fulfillment_orphan_estimated_date_key"]
add("k26_warehouse_tests", "\nUNION ALL ".join([
    *[f"SELECT '{t}_empty' AS test_name, CAST(count(*) = 0 AS BIGINT) AS failed_rows FROM {src}" for t, src in SOURCES.items()],
    _dups("duplicate_dim_date_full_date", "dd", "full_date"), _dups("duplicate_customer_unique_id", "dc", "customer_unique_id"), _dups("duplicate_product_id", "dp", "product_id"),
    _dups("duplicate_seller_id", "ds", "seller_id"), _dups("duplicate_fact_sales_grain", "fs", "order_id, order_item_id"), _dups("duplicate_fulfillment_order_id", "fof", "order_id"),
    _where("fact_sales_null_business_key", "fs", "order_id IS NULL OR order_item_id IS NULL"), _where("fulfillment_null_order_id", "fof", "order_id IS NULL"),
    *[f"SELECT '{name}' AS test_name, count(*) AS failed_rows FROM {SOURCES[f]} f LEFT JOIN {SOURCES[dim]} x ON f.{k} = x.{_PK_OF[dim]} WHERE f.{k} IS NOT NULL AND x.{_PK_OF[dim]} IS NULL"
      for name, (f, k, dim) in zip(_ORPHAN_TESTS, _FKS)],
    _where("invalid_sales_amount", "fs", "sales_amount IS DISTINCT FROM coalesce(price, 0) + coalesce(freight_value, 0)"),
    _where("negative_sales_values", "fs", "price < 0 OR freight_value < 0 OR sales_amount < 0"), _where("negative_fulfillment_hours", "fof", _NEGATIVE),
    _where("invalid_review_score", "fof", "review_score IS NOT NULL AND review_score NOT BETWEEN 1 AND 5"), _where("negative_payment_values", "fof", "total_payment_value < 0 OR payment_count < 0"),
]))
add("k27_staging_tests", STAGING_TESTS)

# --- L, M -------------------------------------------------------------------------------------------------------------

add("l1_total_revenue", f"SELECT {d('coalesce(sum(sales_amount), 0)', 'total_revenue')} FROM fs")
add("l2_monthly_revenue", f"""SELECT CAST(m AS VARCHAR) AS month_start, strftime(m, '%Y-%m') AS year_month, {d('coalesce(v, 0)', 'total_revenue')}
FROM (SELECT DISTINCT CAST(date_trunc('month', full_date) AS DATE) AS m FROM dd)
LEFT JOIN (SELECT CAST(date_trunc('month', full_date) AS DATE) AS month, sum(sales_amount) AS v FROM fs JOIN dd ON fs.date_key = dd.date_key GROUP BY 1) ON m = month""")
add("l3_total_orders", "SELECT count(DISTINCT order_id) AS total_orders FROM fof")
_HIT = "count(*) FILTER (WHERE order_status = 'delivered')"
add("l4_delivery_success", f"SELECT count(*) AS total_orders, {_HIT} AS delivered_orders, {pct(_HIT, 'count(*)')} AS delivery_success_rate_pct FROM fof")
add("l5_orders_by_weekday", f"SELECT {b('day_of_week')}, day_name, count(DISTINCT order_id) AS total_orders FROM dd LEFT JOIN fs ON dd.date_key = fs.date_key GROUP BY day_of_week, day_name")
add("l6_top_categories", f"""SELECT category, {d('total_revenue')} FROM (SELECT category_name_english AS category, sum(sales_amount) AS total_revenue FROM dp JOIN fs ON dp.product_key = fs.product_key
GROUP BY 1 ORDER BY 2 DESC NULLS FIRST, 1 LIMIT 10)""")
add("l7_category_performance", f"SELECT {CATEGORY_OUT} FROM category_perf", CATEGORY)
add("l8_average_price", f"SELECT category_name_english AS category, {mean('price', 2)} AS avg_price FROM dp JOIN fs ON dp.product_key = fs.product_key WHERE category_name_english IS NOT NULL GROUP BY 1")
add("l9_total_customers", "SELECT count(DISTINCT customer_unique_id) AS total_customers FROM dc")
BY_STATE = "by_state AS (SELECT customer_state AS state, count(DISTINCT customer_unique_id) AS total_customers FROM dc WHERE customer_state IS NOT NULL GROUP BY 1)"
add("l10_customers_by_state", "SELECT state, total_customers FROM by_state", BY_STATE)
BY_CITY = f"by_city AS (SELECT {TITLE.format(c='customer_city')} AS city, customer_state AS state, total_customers FROM (SELECT customer_city, customer_state, count(DISTINCT customer_unique_id) AS total_customers FROM dc WHERE customer_city IS NOT NULL GROUP BY 1, 2))"
add("l11_customers_by_city", "SELECT city, state, total_customers FROM by_city", BY_CITY)
_ONE, _MORE = "count(*) FILTER (WHERE order_count = 1)", "count(*) FILTER (WHERE order_count > 1)"
add("l12_repeat_customers", f"SELECT {_ONE} AS one_time_customers, {_MORE} AS repeat_customers FROM per_customer", PER_CUSTOMER)
add("l13_average_review", f"SELECT {mean('review_score', 2)} AS avg_review_score FROM fof")
_ON_TIME = "count(*) FILTER (WHERE is_on_time)"
add("l14_on_time_rate", f"SELECT {pct(_ON_TIME, 'count(*)')} AS on_time_rate_pct FROM fof")
DAY_ROWS = f"""day_rows AS (SELECT CASE WHEN is_on_time THEN 'On Time' ELSE 'Late' END AS delivery_status, {ratio(cents('total_fulfillment_hours'), '2400', 0)} AS delivery_day,
{mean('review_score', 2)} AS avg_review_score, count(*) AS order_count FROM fof WHERE review_score IS NOT NULL AND total_fulfillment_hours IS NOT NULL AND total_fulfillment_hours >= 0 GROUP BY 1, 2)"""
add("l15_delivery_day_vs_review", "SELECT delivery_status, delivery_day, avg_review_score, order_count FROM day_rows", DAY_ROWS)
add("l16_transit_days_by_state", f"""SELECT customer_state, {mean('hours_to_customer', 2, 24)} AS avg_delivery_days, count(*) AS delivered_orders FROM fof JOIN dc ON fof.customer_key = dc.customer_key
WHERE order_status = 'delivered' AND hours_to_customer IS NOT NULL GROUP BY 1""")
add("m1_repeat_rate", f"SELECT {_ONE} AS one_time_customers, {_MORE} AS repeat_customers, coalesce({pct(_MORE, f'{_ONE} + {_MORE}')}, 0) AS repeat_rate_pct FROM per_customer", PER_CUSTOMER)
add("m2_segment_share", f"""SELECT 'One-time' AS segment, {_ONE} AS customers, {pct(_ONE, f'{_ONE} + {_MORE}')} AS share_pct FROM per_customer
UNION ALL SELECT 'Repeat', {_MORE}, {pct(_MORE, f'{_ONE} + {_MORE}')} FROM per_customer""", PER_CUSTOMER)
_ranked("m3_state_share", "by_state", "total_customers DESC, state", f"state, total_customers, {pct('total_customers', '(SELECT sum(total_customers) FROM by_state)')} AS share_pct", BY_STATE)
_ranked("m3_city_share", "by_city", "total_customers DESC, city, state", f"city, state, total_customers, {pct('total_customers', '(SELECT sum(total_customers) FROM by_city)')} AS share_pct, city || ' (' || state || ')' AS city_label", BY_CITY, 10)
add("m4_on_time_vs_late", f"""SELECT delivery_status, CAST(sum(order_count) AS BIGINT) AS order_count, {pct('sum(order_count)', '(SELECT sum(order_count) FROM day_rows)')} AS share_pct,
{ratio('sum(CAST(delivery_day AS HUGEINT) * order_count)', 'sum(order_count)', 1)} AS avg_delivery_day,
{ratio('sum(CAST(round(avg_review_score * 100) AS HUGEINT) * order_count)', 'sum(order_count) * 100', 2)} AS avg_review_score FROM day_rows GROUP BY delivery_status""", DAY_ROWS)
add("m5_trend_line", """SELECT x AS review_score, round(slope * x + intercept, 6) AS delivery_day FROM (SELECT regr_slope(delivery_day, avg_review_score) AS slope, regr_intercept(delivery_day, avg_review_score) AS intercept
FROM day_rows), (SELECT CAST(unnest([1.0, 5.0]) AS DOUBLE) AS x)""", DAY_ROWS)
_ranked("m6_top_by_revenue", "category_perf", "total_revenue DESC, category", CATEGORY_OUT, CATEGORY, 10)

# --- N ---------------------------------------------------------------------------------------------------------------------

add("n1_monthly_trend", f"""SELECT {b('year')}, {b('month')}, month_name, count(DISTINCT order_id) AS total_orders, count(*) AS total_items_sold, {d('sum(price)', 'total_product_revenue')},
{d('sum(freight_value)', 'total_freight_value')}, {d('sum(sales_amount)', 'total_sales_amount')}, {mean('price', 2)} AS avg_item_price FROM fs JOIN dd ON fs.date_key = dd.date_key GROUP BY year, month, month_name""")
add("n2_sla_by_state", f"""SELECT customer_state, count(*) AS total_delivered_orders, {mean('total_fulfillment_hours', 1)} AS avg_lead_time_hours, {mean('total_fulfillment_hours', 1, 24)} AS avg_lead_time_days,
{mean('days_vs_estimate', 1)} AS avg_days_vs_estimate, {pct(_ON_TIME, 'count(*)')} AS on_time_delivery_rate_pct, {mean('review_score', 2)} AS avg_review_score
FROM fof JOIN dc ON fof.customer_key = dc.customer_key WHERE {DELIVERED} GROUP BY 1 HAVING count(*) >= 100""")


def _value(excluded: str) -> str:
    return f"""value_rows AS (SELECT customer_unique_id, customer_state, count(DISTINCT order_id) AS frequency, sum(total_payment_value) AS monetary, min(full_date) AS first_day, max(full_date) AS last_day
FROM fof JOIN dc ON fof.customer_key = dc.customer_key JOIN dd ON order_purchase_date_key = date_key WHERE order_status NOT IN ({excluded}) GROUP BY 1, 2)"""


add("n3_purchase_segments", f"""SELECT CASE WHEN frequency = 1 THEN '1. One-time Buyer' WHEN frequency = 2 THEN '2. Repeat Buyer (2 orders)' ELSE '3. Loyal Buyer (3+ orders)' END AS customer_segment,
count(*) AS customer_count, {mean('monetary', 2)} AS avg_spending_per_customer, {d('sum(monetary)', 'total_revenue_contribution')} FROM value_rows GROUP BY 1""", _value("'canceled', 'unavailable'"))
add("n4_category_reviews", f"""SELECT category_name_english, order_count, {d('total_sales')}, avg_order_review_score FROM (SELECT category_name_english, count(DISTINCT f.order_id) AS order_count, sum(v) AS total_sales,
{mean('review_score', 2)} AS avg_order_review_score FROM fof f JOIN (SELECT order_id, category_name_english, sum(sales_amount) AS v FROM fs JOIN dp ON fs.product_key = dp.product_key GROUP BY 1, 2) i
ON f.order_id = i.order_id WHERE order_status = 'delivered' GROUP BY 1 ORDER BY total_sales DESC, 1 LIMIT 20)""")
add("n5_order_values", f"SELECT {VALUES_OUT} FROM order_values", ORDER_VALUES)
_LATE = "count(*) FILTER (WHERE NOT is_on_time)"
_SLA = f"""count(*) AS delivered_orders, {_ON_TIME} AS on_time_orders, {_LATE} AS delayed_orders, {pct(_ON_TIME, 'count(*)')} AS on_time_rate_pct, {mean('total_fulfillment_hours', 2, 24)} AS avg_lead_time_days,
{mean('hours_to_customer', 2, 24)} AS avg_transit_days, {mean('days_vs_estimate', 2)} AS avg_days_vs_estimate, {mean('review_score', 2)} AS avg_review_score,
{mean('review_score', 2, keep='is_on_time')} AS csat_on_time, {mean('review_score', 2, keep='NOT is_on_time')} AS csat_delayed"""
_S = {side: (f"coalesce(sum(review_score) FILTER (WHERE {keep}), 0)", f"count(review_score) FILTER (WHERE {keep})") for side, keep in (("hit", "is_on_time"), ("miss", "NOT is_on_time"))}
_PENALTY = ratio(f"{_S['hit'][0]} * {_S['miss'][1]} - {_S['miss'][0]} * {_S['hit'][1]}", f"{_S['hit'][1]} * {_S['miss'][1]}", 2) + " AS csat_penalty"
add("n6_delivery_sla", f"SELECT {_SLA}, {_PENALTY} FROM fof WHERE {DELIVERED}")
add("n6_delivery_sla_by_state", f"SELECT customer_state, {_SLA}, {_PENALTY} FROM fof JOIN dc ON fof.customer_key = dc.customer_key WHERE {DELIVERED} GROUP BY 1")
add("n6_delivery_sla_by_month", f"""SELECT {b('year')}, {b('month')}, {_SLA}, {_PENALTY} FROM fof JOIN dd ON order_purchase_date_key = date_key
WHERE {DELIVERED} GROUP BY year, month""")
add("n7_score_distribution", f"SELECT is_on_time, {cols(*[f'count(*) FILTER (WHERE review_score = {i}) AS score_{i}' for i in range(1, 6)])} FROM fof WHERE {DELIVERED} AND is_on_time IS NOT NULL GROUP BY 1")
for _name, _role in [("purchase", "order_purchase_date_key"), ("delivery", "delivered_date_key")]:
    add(f"n7_on_time_by_{_name}_month", f"""SELECT {b('year')}, {b('month')}, count(*) AS delivered_orders, {_ON_TIME} AS on_time_orders, {pct(_ON_TIME, 'count(*)')} AS on_time_rate_pct
FROM fof JOIN dd ON {_role} = date_key WHERE {DELIVERED} GROUP BY year, month""")
_SALES = f"""count(DISTINCT order_id) AS total_orders, count(*) AS total_items, sum(price) AS gmv, sum(freight_value) AS freight, sum(sales_amount) AS total_sales, {mean('price', 2)} AS avg_price,
{mean('freight_value', 2)} AS avg_freight, {pct(f"sum({cents('freight_value')})", f"sum({cents('price')})")} AS freight_ratio_pct"""
_SALES_OUT = f"total_orders, total_items, {d('gmv')}, {d('freight')}, {d('total_sales')}, avg_price, avg_freight, freight_ratio_pct"


def _sales_by(group: str) -> str:
    return f"sales AS (SELECT {group}, {_SALES} FROM fs JOIN dd ON fs.date_key = dd.date_key GROUP BY {group})"


add("n8_sales_growth", f"""SELECT {b('s.year', 'year')}, {b('s.month', 'month')}, {_SALES_OUT}, {pct(cents('total_sales - previous'), cents('previous'))} AS mom_growth_pct,
{pct(cents('total_sales - year_before'), cents('year_before'))} AS yoy_growth_pct FROM (SELECT s.*, p.total_sales AS previous, y.total_sales AS year_before
FROM sales s LEFT JOIN sales y ON y.year = s.year - 1 AND y.month = s.month LEFT JOIN sales p ON p.year * 12 + p.month = s.year * 12 + s.month - 1) s""", _sales_by("year, month"))
add("n8_sales_by_year", f"SELECT {b('year')}, {_SALES_OUT} FROM sales", _sales_by("year"))
add("n8_sales_by_day", f"SELECT {s('full_date')}, {_SALES_OUT} FROM sales", _sales_by("full_date"))
add("n8_sales_by_quarter", f"SELECT {b('year')}, {b('quarter')}, {_SALES_OUT} FROM sales", _sales_by("year, quarter"))
add("n8_sales_by_weekend", f"SELECT is_weekend, {_SALES_OUT} FROM sales", _sales_by("is_weekend"))
PEAKS = "peaks AS (SELECT {g}, sum(sales_amount) AS total_sales, count(*) AS total_items FROM fs JOIN dd ON fs.date_key = dd.date_key GROUP BY ALL)"
_ranked("n8_peak_days", "peaks", "total_sales DESC, full_date", f"{s('full_date')}, {d('total_sales')}, total_items", PEAKS.format(g="full_date"), 10)
_ranked("n8_peak_weeks", "peaks", "total_sales DESC, iso_year, week_of_year", f"{b('iso_year')}, {b('week_of_year')}, {d('total_sales')}, total_items", PEAKS.format(g="isoyear(full_date) AS iso_year, week_of_year"), 10)
_VALUE = _value("'canceled'")
add("n9_customer_value", f"SELECT customer_unique_id, customer_state, frequency, {d('monetary')}, {s('first_day', 'first_purchase_date')}, {s('last_day', 'last_purchase_date')} FROM value_rows", _VALUE)
_AGAIN = "count(*) FILTER (WHERE frequency >= 2)"
add("n9_customer_summary", f"SELECT count(*) AS total_customers, {pct(_AGAIN, 'count(*)')} AS repeat_purchase_rate_pct, {mean('monetary', 2)} AS avg_clv FROM value_rows", _VALUE)
RFM = _VALUE + """, rfm AS (SELECT customer_unique_id, customer_state, recency_days, frequency, monetary, ntile(5) OVER (ORDER BY recency_days DESC, customer_unique_id) AS r_score,
ntile(5) OVER (ORDER BY frequency, customer_unique_id) AS f_score, ntile(5) OVER (ORDER BY monetary, customer_unique_id) AS m_score
FROM (SELECT customer_unique_id, customer_state, date_diff('day', last_day, (SELECT max(full_date) FROM fof JOIN dd ON order_purchase_date_key = date_key)) AS recency_days, frequency, coalesce(monetary, 0) AS monetary FROM value_rows))"""
add("n9_rfm_scores", f"SELECT customer_unique_id, customer_state, {b('recency_days')}, frequency, {d('monetary')}, {b('r_score')}, {b('f_score')}, {b('m_score')} FROM rfm", RFM)
STATE_VALUE = _VALUE + ", state_value AS (SELECT customer_state, sum(monetary) AS revenue, count(*) AS customers FROM value_rows GROUP BY 1)"
_ranked("n9_revenue_by_state", "state_value", "revenue DESC, customer_state", f"customer_state, {d('revenue')}, customers", STATE_VALUE, 5)
CITY_VALUE = _VALUE + """, city_value AS (SELECT customer_city, v.customer_state, sum(monetary) AS revenue, count(*) AS customers
FROM value_rows v JOIN dc USING (customer_unique_id) GROUP BY 1, 2)"""
_ranked("n9_revenue_by_city", "city_value", "revenue DESC NULLS LAST, customer_city, customer_state", f"customer_city, customer_state, {d('revenue')}, customers", CITY_VALUE, 10)
_PRODUCT_SUMS = f"""count(*) AS items_sold, sum(price) AS gmv, sum(sales_amount) AS total_revenue, {mean('price', 2)} AS avg_price, {mean('freight_value', 2)} AS avg_freight,
{pct(f"sum({cents('freight_value')})", f"sum({cents('price')})")} AS freight_ratio_pct"""
_PRODUCT_OUT = f"items_sold, {d('gmv')}, {d('total_revenue')}, avg_price, avg_freight, freight_ratio_pct"
add("n10_category_pareto", f"""SELECT category_name_english, {_PRODUCT_OUT}, rank_no, {pct(cents('running'), cents('whole'))} AS cumulative_pct FROM (SELECT *, row_number() OVER w AS rank_no,
sum(total_revenue) OVER (w ROWS UNBOUNDED PRECEDING) AS running, sum(total_revenue) OVER () AS whole FROM (SELECT category_name_english, {_PRODUCT_SUMS} FROM fs JOIN dp ON fs.product_key = dp.product_key GROUP BY 1)
WINDOW w AS (ORDER BY total_revenue DESC, category_name_english))""")
add("n10_weight_buckets", f"SELECT bucket, {_PRODUCT_OUT} FROM (SELECT {WEIGHT} AS bucket, {_PRODUCT_SUMS} FROM fs JOIN dp ON fs.product_key = dp.product_key GROUP BY 1)")
add("n10_photo_buckets", f"SELECT bucket, {_PRODUCT_OUT} FROM (SELECT {PHOTOS} AS bucket, {_PRODUCT_SUMS} FROM fs JOIN dp ON fs.product_key = dp.product_key GROUP BY 1)")
add("n10_product_correlations", """SELECT round(corr(CAST(product_photos_qty AS DOUBLE), n), 6) AS corr_photos_items, round(corr(CAST(product_description_length AS DOUBLE), n), 6) AS corr_description_items,
round(corr(CAST(product_weight_g AS DOUBLE), f), 6) AS corr_weight_freight FROM (SELECT product_key, CAST(count(*) AS DOUBLE) AS n, CAST(sum(freight_value) AS DOUBLE) / count(freight_value) AS f FROM fs GROUP BY 1) x
JOIN dp ON x.product_key = dp.product_key""")
PAIRS = """pairs AS (SELECT a.*, f.hours_to_carrier, f.total_fulfillment_hours, f.review_score, ds.seller_id, ds.seller_state, ds.seller_state = dc.customer_state AS same_state
FROM (SELECT order_id, seller_key, sum(price) AS gmv, sum(freight_value) AS freight, count(*) AS items FROM fs GROUP BY 1, 2) a
LEFT JOIN fof f ON a.order_id = f.order_id LEFT JOIN dc ON f.customer_key = dc.customer_key JOIN ds ON a.seller_key = ds.seller_key)"""
_SAME = "count(*) FILTER (WHERE same_state)"
add("n11_seller_performance", f"""SELECT seller_id, seller_state, {d('gmv', 'total_gmv')}, total_orders, total_items, avg_dispatch_hours, avg_dispatch_days, same_state_rate_pct, avg_csat,
CASE WHEN gmv > 100000 THEN 'Tier 1' WHEN gmv >= 20000 THEN 'Tier 2' ELSE 'Tier 3' END AS tier FROM (SELECT seller_id, seller_state, sum(gmv) AS gmv, count(*) AS total_orders, CAST(sum(items) AS BIGINT) AS total_items,
{mean('hours_to_carrier', 2)} AS avg_dispatch_hours, {mean('hours_to_carrier', 2, 24)} AS avg_dispatch_days, {pct(_SAME, 'count(*)')} AS same_state_rate_pct, {mean('review_score', 2)} AS avg_csat FROM pairs GROUP BY 1, 2)""", PAIRS)
add("n11_sellers_by_state", f"""SELECT seller_state, active_sellers, {d('gmv', 'total_gmv')}, avg_dispatch_hours, {pct('active_sellers', '(SELECT count(DISTINCT seller_id) FROM pairs)')} AS seller_share_pct
FROM (SELECT seller_state, count(DISTINCT seller_id) AS active_sellers, sum(gmv) AS gmv, {mean('hours_to_carrier', 2)} AS avg_dispatch_hours FROM pairs GROUP BY 1)""", PAIRS)
add("n11_sellers_by_city", f"""SELECT seller_state, seller_city, active_sellers, {d('gmv', 'total_gmv')}, avg_dispatch_hours, {pct('active_sellers', '(SELECT count(DISTINCT seller_id) FROM pairs)')} AS seller_share_pct
FROM (SELECT p.seller_state, ds.seller_city, count(DISTINCT p.seller_id) AS active_sellers, sum(gmv) AS gmv, {mean('hours_to_carrier', 2)} AS avg_dispatch_hours FROM pairs p JOIN ds USING (seller_key) GROUP BY 1, 2)""", PAIRS)
add("n11_route_comparison", f"""SELECT CASE WHEN same_state THEN 'Intra-state' ELSE 'Inter-state' END AS route, count(*) AS seller_orders, {mean('total_fulfillment_hours', 2)} AS avg_fulfillment_hours,
{mean('freight', 2)} AS avg_freight FROM pairs WHERE same_state IS NOT NULL GROUP BY 1""", PAIRS)
add("n12_average_order_value", f"SELECT count(DISTINCT order_id) AS total_orders, {d('sum(total_payment_value)', 'total_payments')}, {ratio(f"sum({cents('total_payment_value')})", 'count(DISTINCT order_id) * 100', 2)} AS avg_order_value FROM fof")
add("n13_seller_concentration", f"""SELECT rank_no, seller_id, {d('v', 'total_gmv')}, {pct(cents('running'), cents('whole'))} AS cumulative_gmv_pct, {pct('rank_no', 'sellers')} AS seller_pct
FROM (SELECT *, row_number() OVER w AS rank_no, sum(v) OVER (w ROWS UNBOUNDED PRECEDING) AS running, sum(v) OVER () AS whole, count(*) OVER () AS sellers
FROM (SELECT seller_id, coalesce(sum(price), 0) AS v FROM fs JOIN ds ON fs.seller_key = ds.seller_key GROUP BY 1) WINDOW w AS (ORDER BY v DESC, seller_id))""")
add("n14_cohorts", """SELECT CAST(first_month AS VARCHAR) AS cohort_month, CAST(date_diff('month', first_month, month) AS BIGINT) AS month_offset, count(*) AS customers
FROM (SELECT *, min(month) OVER (PARTITION BY customer_key) AS first_month FROM active) GROUP BY 1, 2""",
    "active AS (SELECT DISTINCT customer_key, CAST(date_trunc('month', full_date) AS DATE) AS month FROM fof JOIN dd ON order_purchase_date_key = date_key WHERE order_status <> 'canceled' AND customer_key IS NOT NULL)")
add("n15_rfm_segments", f"""SELECT segment, count(*) AS customers, {d('sum(monetary)', 'revenue')}, {pct(f"sum({cents('monetary')})", f"(SELECT sum({cents('monetary')}) FROM rfm)")} AS revenue_share_pct
FROM (SELECT *, CASE WHEN r_score >= 4 AND f_score >= 4 THEN 'Champions' WHEN r_score >= 3 THEN 'Loyal Customers' WHEN r_score = 2 OR f_score >= 4 THEN 'At Risk' ELSE 'Lost' END AS segment FROM rfm) GROUP BY 1""", RFM)
_PSI = """SELECT CAST(bucket AS BIGINT) AS bucket, base_n, current_n, round((c - b) * ln(c / b), 9) AS psi_part FROM (SELECT *, greatest(CAST(base_n AS DOUBLE), 0.5) / sum(base_n) OVER () AS b,
greatest(CAST(current_n AS DOUBLE), 0.5) / sum(current_n) OVER () AS c FROM (SELECT bucket, count(*) FILTER (WHERE k < 19980701) AS base_n, count(*) FILTER (WHERE k >= 19980701) AS current_n FROM v GROUP BY 1))"""
add("n16_price_drift", _PSI, "v AS (SELECT CASE WHEN price < 0 THEN 0 WHEN price >= 100000 THEN 11 ELSE CAST(floor(CAST(price AS DOUBLE) * 10 / 100000) AS BIGINT) + 1 END AS bucket, date_key AS k FROM fs WHERE price IS NOT NULL AND date_key IS NOT NULL)")
add("n16_score_drift", _PSI, "v AS (SELECT review_score AS bucket, order_purchase_date_key AS k FROM fof WHERE review_score IS NOT NULL AND order_purchase_date_key IS NOT NULL)")
