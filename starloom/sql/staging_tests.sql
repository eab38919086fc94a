-- Tests over the clean views; a test passes with 0 failed rows.
WITH customer_counts AS (
  SELECT count(*) AS n FROM vw_customers
), order_counts AS (
  SELECT count(*) AS n, count_if(order_id IS NULL) AS without_id FROM vw_orders
), repeated_orders AS (
  SELECT count(*) AS n FROM (SELECT order_id FROM vw_orders GROUP BY order_id HAVING count(*) > 1)
), repeated_items AS (
  SELECT count(*) AS n
  FROM (SELECT order_id, order_item_id FROM vw_order_items GROUP BY order_id, order_item_id HAVING count(*) > 1)
)
SELECT 'vw_customers_empty' AS test_name, CAST(if(n = 0, 1, 0) AS BIGINT) AS failed_rows FROM customer_counts
UNION ALL
SELECT stack(2, 'vw_orders_empty', CAST(if(n = 0, 1, 0) AS BIGINT), 'orders_null_order_id', without_id) FROM order_counts
UNION ALL
SELECT 'duplicate_orders', n FROM repeated_orders
UNION ALL
SELECT 'duplicate_order_items', n FROM repeated_items
ORDER BY test_name
