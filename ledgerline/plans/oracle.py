"""DuckDB SQL stating what each registered query must return.

The driver runs each string next to the Spark query on the same parquet
views. The source-shaped tables of ``sources/testdata.py`` are restated
as CTEs here (``RAW_ORDERS`` ...), so the oracle does not share code with
the Spark side.
"""

from __future__ import annotations

# Fixed values shared with sources/testdata.py.
ORDERS_V0_EXTRACTED_AT = "2001-09-05 02:00:00"
ORDERS_V1_EXTRACTED_AT = "2001-09-06 02:00:00"
CUSTOMERS_V0_EXTRACTED_AT = "2001-09-04 02:00:00"
CUSTOMERS_V1_EXTRACTED_AT = "2001-09-05 02:00:00"
PRODUCTS_EXTRACTED_AT = "2001-09-06 14:00:00"
CUSTOMERS_CREATED_AT = "1992-01-01 00:00:00"
PRODUCTS_CREATED_AT = "1992-01-01 00:00:00"
AS_OF = "2001-09-06 20:00:00"
CHANGED_SINCE_AS_OF = "2001-08-20 00:00:00"
FIRST_RUN_CUTOFF = "1998-06-30 00:00:00"
LOAD_RUN1_AT = "2001-09-05 02:00:00"
LOAD_RUN2_AT = "2001-09-06 02:00:00"
INTERVAL_START = "2000-01-01 00:00:00"
OVERLAP_STARTS = ("2000-01-01 00:00:00", "2001-01-01 00:00:00")
BACKFILL_MONTHS = ("1996-01-01", "1996-12-01")
SKEWED_PRODUCT = 1
STATE_AS_OF = "1996-06-01 00:00:00"
CONSUMER_POSITIONS = (("warehouse_sink", "2024-01-20 00:00:00"), ("search_index", "2024-01-29 00:00:00"))
PAYMENT_PROVIDERS = (("card", "card_network", "0.0290"), ("bank_transfer", "bank", "0.0050"),
                     ("wallet", "wallet_provider", "0.0150"), ("cash", "cash_desk", "0.0000"))

_ORDERS_COLS = """
    order_ref, customer_id, status, order_total,
    CAST(order_total * CAST(0.08 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS tax_amount,
    CAST(0 AS DECIMAL(18,2)) AS discount_amount, 'USD' AS currency, created_at, updated_at"""

_ORDERS_V = """
  SELECT {id} AS order_id, 'ORD-' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS order_ref,
         o_custkey AS customer_id,
         CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN {o_status} WHEN 'P' THEN {p_status} END AS status,
         CAST({total} AS DECIMAL(18,2)) AS order_total,
         o_orderdate AS created_at,
         {updated} AS updated_at,
         {ver} AS ver, TIMESTAMP '{ext}' AS _extracted_at
  FROM orders {where}"""


def _orders_branch(ver: int, where: str = "") -> str:
    base_total = "CAST(o_totalprice AS DECIMAL(18,2))"
    return _ORDERS_V.format(
        id="CAST(NULL AS BIGINT)" if ver == 2 else "o_orderkey",
        o_status="'shipped'" if ver == 1 else "'processing'",
        p_status="'cancelled'" if ver == 1 else "'pending'",
        total=f"{base_total} + 10" if ver == 1 else base_total,
        updated="o_orderdate + to_days(31)" if ver == 1
        else "o_orderdate + to_days(CAST(o_orderkey % 30 AS INTEGER))",
        ver=ver,
        ext=ORDERS_V0_EXTRACTED_AT if ver == 0 else ORDERS_V1_EXTRACTED_AT,
        where=where,
    )


RAW_ORDERS = f"""raw_orders AS (
  SELECT order_id, {_ORDERS_COLS}, ver, _extracted_at FROM (
    {_orders_branch(0)}
    UNION ALL {_orders_branch(1, "WHERE o_orderkey % 3 = 0")}
    UNION ALL {_orders_branch(2, "WHERE o_orderkey % 97 = 0")}
  ) b
)"""

SOURCE_ORDERS = f"""source_orders AS (
  SELECT order_id, {_ORDERS_COLS} FROM (
    {_orders_branch(0, "WHERE o_orderkey % 3 <> 0")}
    UNION ALL {_orders_branch(1, "WHERE o_orderkey % 3 = 0")}
  ) b
)"""

_UUID = ("substr(md5(CAST(c_custkey AS VARCHAR)),1,8) || '-' || substr(md5(CAST(c_custkey AS VARCHAR)),9,4) || '-' || "
         "substr(md5(CAST(c_custkey AS VARCHAR)),13,4) || '-' || substr(md5(CAST(c_custkey AS VARCHAR)),17,4) || '-' || "
         "substr(md5(CAST(c_custkey AS VARCHAR)),21,12)")


def _customers_branch(ver: int, where: str = "") -> str:
    created = f"TIMESTAMP '{CUSTOMERS_CREATED_AT}'"
    ext_id = f"upper({_UUID})" if ver == 1 else \
        f"CASE WHEN c_custkey % 50 = 0 THEN 'legacy-' || CAST(c_custkey AS VARCHAR) ELSE {_UUID} END"
    segment = "'enterprise'" if ver == 1 else (
        "CASE WHEN c_mktsegment IN ('BUILDING','MACHINERY') THEN 'enterprise' "
        "WHEN c_mktsegment IN ('AUTOMOBILE') THEN 'smb' ELSE 'consumer' END")
    updated = f"{created} + to_days(31)" if ver == 1 else \
        f"{created} + to_days(CAST(c_custkey % 30 AS INTEGER))"
    ext = CUSTOMERS_V1_EXTRACTED_AT if ver == 1 else CUSTOMERS_V0_EXTRACTED_AT
    return f"""
  SELECT c_custkey AS customer_id, {ext_id} AS external_id,
         'customer' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
         c_name AS full_name,
         '+' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '-' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS phone,
         {segment} AS segment,
         lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS country_code,
         'City ' || CAST(c_nationkey AS VARCHAR) AS city,
         c_acctbal >= 0 AS is_active,
         {created} AS created_at, {updated} AS updated_at,
         {ver} AS ver, TIMESTAMP '{ext}' AS _extracted_at
  FROM customer {where}"""


RAW_CUSTOMERS = f"""raw_customers AS (
  {_customers_branch(0)}
  UNION ALL {_customers_branch(1, "WHERE c_custkey % 5 = 0")}
)"""

SOURCE_CUSTOMERS = f"""source_customers AS (
  SELECT * EXCLUDE (ver, _extracted_at) FROM (
  {_customers_branch(0, "WHERE c_custkey % 5 <> 0")}
  UNION ALL {_customers_branch(1, "WHERE c_custkey % 5 = 0")}
  ) b
)"""


def _products_branch(ver: int, where: str = "") -> str:
    created = f"TIMESTAMP '{PRODUCTS_CREATED_AT}'"
    price = "CAST(p_retailprice AS DECIMAL(18,4))"
    unit = f"CAST({price} * CAST(0.9 AS DECIMAL(2,1)) AS DECIMAL(18,4))" if ver == 1 else price
    updated = f"{created} + to_days(31)" if ver == 1 else \
        f"{created} + to_days(CAST(p_partkey % 30 AS INTEGER))"
    return f"""
  SELECT p_partkey AS product_id, 'P-' || CAST(p_partkey AS VARCHAR) AS sku, p_name AS name,
         p_type AS category, p_brand AS sub_category, {unit} AS unit_price,
         CASE WHEN p_size > 45 THEN CAST(NULL AS DECIMAL(18,4))
              ELSE CAST({price} * CAST(0.6 AS DECIMAL(2,1)) AS DECIMAL(18,4)) END AS cost_price,
         'USD' AS currency, CAST(p_size AS DECIMAL(8,3)) AS weight_kg, TRUE AS is_active,
         {created} AS created_at, {updated} AS updated_at,
         {ver} AS ver, TIMESTAMP '{PRODUCTS_EXTRACTED_AT}' AS _extracted_at
  FROM part {where}"""


RAW_PRODUCTS = f"""raw_products AS (
  {_products_branch(0)}
  UNION ALL {_products_branch(1, "WHERE p_partkey % 7 = 0")}
)"""

SOURCE_PRODUCTS = f"""source_products AS (
  SELECT * EXCLUDE (ver, _extracted_at) FROM (
  {_products_branch(0, "WHERE p_partkey % 7 <> 0")}
  UNION ALL {_products_branch(1, "WHERE p_partkey % 7 = 0")}
  ) b
)"""

SOURCE_ORDER_ITEMS = """source_order_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_partkey AS product_id,
         l_suppkey AS supplier_id, CAST(l_quantity AS INTEGER) AS quantity,
         CAST(p_retailprice AS DECIMAL(18,4)) AS unit_price,
         CAST(CAST(l_discount AS DECIMAL(5,2)) * 100 AS DECIMAL(5,2)) AS discount_pct,
         CAST(round(CAST(l_quantity AS INTEGER) * CAST(p_retailprice AS DECIMAL(18,4))
               * (1 - CAST(l_discount AS DECIMAL(5,2))), 2) AS DECIMAL(18,2)) AS line_total,
         l_shipdate AS created_at
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""

SOURCE_PAYMENTS = """source_payments AS (
  SELECT o_orderkey AS payment_id, o_orderkey AS order_id,
         CASE o_orderkey % 4 WHEN 0 THEN 'card' WHEN 1 THEN 'bank_transfer' WHEN 2 THEN 'wallet'
                             WHEN 3 THEN 'cash' END AS payment_method,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount, 'USD' AS currency,
         CASE o_orderkey % 6 WHEN 0 THEN 'pending' WHEN 1 THEN 'authorised' WHEN 2 THEN 'captured'
                             WHEN 3 THEN 'failed' WHEN 4 THEN 'refunded' WHEN 5 THEN 'disputed' END AS status,
         o_orderdate AS created_at, o_orderdate + to_days(1) AS updated_at
  FROM orders
)"""

CHANGE_EVENTS = """change_events AS (
  SELECT user_id AS key, event_id AS seq, ts,
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
         props AS payload
  FROM events
)"""

STG_ORDERS = """stg_orders AS (
  SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id,
         CAST(order_total AS DECIMAL(18,2)) AS order_total_usd,
         CAST(tax_amount AS DECIMAL(18,2)) AS tax_amount_usd,
         created_at, updated_at, _extracted_at, _row_num
  FROM (SELECT *, CAST(row_number() OVER (PARTITION BY order_id
                       ORDER BY updated_at DESC NULLS FIRST, _extracted_at DESC NULLS LAST) AS BIGINT) AS _row_num
        FROM raw_orders WHERE order_id IS NOT NULL) r
  WHERE _row_num = 1
)"""

LATEST_ORDERS = """latest_orders AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_id
                       ORDER BY updated_at DESC NULLS FIRST, _extracted_at DESC NULLS LAST) AS _rn
        FROM raw_orders WHERE order_id IS NOT NULL) r
  WHERE _rn = 1
)"""

STG_CUSTOMERS = """stg_customers AS (
  SELECT CAST(customer_id AS VARCHAR) AS customer_id,
         CASE WHEN regexp_full_match(lower(trim(external_id)),
                   '[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}')
              THEN lower(trim(external_id)) END AS external_id,
         substr(email, 1, 255) AS email, substr(full_name, 1, 255) AS full_name,
         substr(phone, 1, 50) AS phone, substr(segment, 1, 50) AS segment,
         rpad(substr(country_code, 1, 2), 2, ' ') AS country_code, substr(city, 1, 100) AS city,
         CAST(is_active AS BOOLEAN) AS is_active, created_at, updated_at, _row_num
  FROM (SELECT *, CAST(row_number() OVER (PARTITION BY customer_id
                       ORDER BY updated_at DESC NULLS FIRST, _extracted_at DESC NULLS LAST) AS BIGINT) AS _row_num
        FROM raw_customers WHERE customer_id IS NOT NULL) r
  WHERE _row_num = 1
)"""

FCT_ORDERS = """fct_orders AS (
  SELECT o.order_id, o.customer_id, o.order_total_usd, o.tax_amount_usd,
         o.order_total_usd - o.tax_amount_usd AS net_revenue_usd,
         o.created_at, CAST(date_trunc('month', o.created_at) AS TIMESTAMP) AS order_month
  FROM stg_orders o LEFT JOIN stg_customers c USING (customer_id)
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


ORACLE: dict[str, str] = {}

ORACLE["stg_orders"] = with_(RAW_ORDERS, STG_ORDERS) + "SELECT * FROM stg_orders"
ORACLE["stg_customers"] = with_(RAW_CUSTOMERS, STG_CUSTOMERS) + "SELECT * FROM stg_customers"
ORACLE["fct_orders"] = with_(RAW_ORDERS, STG_ORDERS, RAW_CUSTOMERS, STG_CUSTOMERS, FCT_ORDERS) + \
    "SELECT * FROM fct_orders"

_SRC = (SOURCE_CUSTOMERS, SOURCE_PRODUCTS, SOURCE_ORDERS, SOURCE_ORDER_ITEMS, SOURCE_PAYMENTS)
_FCT = (RAW_ORDERS, STG_ORDERS, RAW_CUSTOMERS, STG_CUSTOMERS, FCT_ORDERS)

ORACLE["dedup_latest"] = """
SELECT * EXCLUDE (_rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC NULLS FIRST, l_partkey ASC, l_suppkey ASC) AS _rn
  FROM lineitem) t
WHERE _rn = 1"""

ORACLE["fct_orders_daily"] = with_(*_FCT) + """
SELECT CAST(created_at AS DATE) AS created_date, count(*) AS order_count,
       CAST(sum(order_total_usd) AS DECIMAL(38,2)) AS total_usd,
       CAST(sum(net_revenue_usd) AS DECIMAL(38,2)) AS net_revenue_usd
FROM fct_orders GROUP BY 1"""

ORACLE["row_counts"] = with_(*_SRC) + """
SELECT 'customers' AS tbl, count(*) AS rows FROM source_customers
UNION ALL SELECT 'products', count(*) FROM source_products
UNION ALL SELECT 'orders', count(*) FROM source_orders
UNION ALL SELECT 'order_items', count(*) FROM source_order_items
UNION ALL SELECT 'payments', count(*) FROM source_payments
ORDER BY tbl"""

ORACLE["orders_by_status"] = with_(SOURCE_ORDERS) + """
SELECT status, count(*) AS order_count, CAST(round(sum(order_total), 2) AS DECIMAL(38,2)) AS total_revenue
FROM source_orders GROUP BY status
ORDER BY order_count DESC, status"""

ORACLE["revenue_by_customer"] = with_(SOURCE_CUSTOMERS, SOURCE_ORDERS) + """
SELECT c.full_name, c.segment, count(DISTINCT o.order_id) AS orders,
       CAST(round(sum(o.order_total), 2) AS DECIMAL(38,2)) AS lifetime_value
FROM source_customers c JOIN source_orders o ON o.customer_id = c.customer_id
WHERE o.status NOT IN ('cancelled', 'refunded')
GROUP BY c.full_name, c.segment
ORDER BY lifetime_value DESC, full_name, segment"""

ORACLE["latest_update"] = with_(SOURCE_CUSTOMERS, SOURCE_PRODUCTS, SOURCE_ORDERS, SOURCE_PAYMENTS) + """
SELECT table_name, max(updated_at) AS latest_update FROM (
  SELECT 'customers' AS table_name, updated_at FROM source_customers
  UNION ALL SELECT 'products', updated_at FROM source_products
  UNION ALL SELECT 'orders', updated_at FROM source_orders
  UNION ALL SELECT 'payments', updated_at FROM source_payments) t
GROUP BY table_name
ORDER BY table_name"""

ORACLE["watermark_simulation"] = with_(SOURCE_ORDERS, SOURCE_CUSTOMERS) + f"""
SELECT 'orders' AS tbl, count(*) AS rows_since_yesterday, min(updated_at) AS min_wm, max(updated_at) AS max_wm
FROM source_orders WHERE updated_at > TIMESTAMP '{CHANGED_SINCE_AS_OF}' - INTERVAL 1 DAY
UNION ALL
SELECT 'customers', count(*), min(updated_at), max(updated_at)
FROM source_customers WHERE updated_at > TIMESTAMP '{CHANGED_SINCE_AS_OF}' - INTERVAL 1 DAY"""

ORACLE["fk_orphans"] = with_(SOURCE_ORDERS, SOURCE_ORDER_ITEMS, SOURCE_PAYMENTS) + """
SELECT 'orphaned_items' AS check_name, count(*) AS violations
FROM source_order_items i LEFT JOIN source_orders o ON o.order_id = i.order_id WHERE o.order_id IS NULL
UNION ALL
SELECT 'orphaned_payments', count(*)
FROM source_payments p LEFT JOIN source_orders o ON o.order_id = p.order_id WHERE o.order_id IS NULL"""

ORACLE["three_way_join"] = with_(SOURCE_ORDER_ITEMS, SOURCE_ORDERS, SOURCE_PRODUCTS) + """
SELECT i.order_id, i.line_number, i.product_id, i.supplier_id, o.customer_id, o.status,
       p.name AS product_name, p.category, i.quantity, i.unit_price, i.discount_pct, i.line_total
FROM source_order_items i
JOIN source_orders o ON o.order_id = i.order_id
JOIN source_products p ON p.product_id = i.product_id"""

ORACLE["skewed_three_way_join"] = with_(SOURCE_ORDER_ITEMS, SOURCE_ORDERS, SOURCE_PRODUCTS) + f""",
items AS (SELECT * REPLACE (CASE WHEN (order_id + line_number) % 3 = 0 THEN {SKEWED_PRODUCT} ELSE product_id END AS product_id)
          FROM source_order_items)
SELECT i.order_id, i.line_number, i.product_id, i.supplier_id, o.customer_id, o.status,
       p.name AS product_name, p.category, i.quantity, i.unit_price, i.discount_pct, i.line_total
FROM items i
JOIN source_orders o ON o.order_id = i.order_id
JOIN source_products p ON p.product_id = i.product_id"""

ORACLE["line_total"] = with_(SOURCE_ORDER_ITEMS) + "SELECT * FROM source_order_items"

ORACLE["dq_not_null"] = with_(*_FCT) + """
SELECT 'not_null_order_id' AS check_name, 'raw.orders' AS table_name,
       count(*) FILTER (WHERE order_id IS NULL) AS failing_rows, 'error' AS severity FROM raw_orders
UNION ALL SELECT 'not_null_customer_id', 'raw.orders', count(*) FILTER (WHERE customer_id IS NULL), 'error' FROM raw_orders
UNION ALL SELECT 'not_null_order_total', 'raw.orders', count(*) FILTER (WHERE order_total IS NULL), 'error' FROM raw_orders
UNION ALL SELECT 'not_null_order_id', 'fct_orders', count(*) FILTER (WHERE order_id IS NULL), 'error' FROM fct_orders
UNION ALL SELECT 'not_null_customer_id', 'fct_orders', count(*) FILTER (WHERE customer_id IS NULL), 'error' FROM fct_orders
UNION ALL SELECT 'not_null_order_total_usd', 'fct_orders', count(*) FILTER (WHERE order_total_usd IS NULL), 'error' FROM fct_orders
UNION ALL SELECT 'not_null_created_at', 'fct_orders', count(*) FILTER (WHERE created_at IS NULL), 'error' FROM fct_orders"""

ORACLE["dq_unique"] = with_(*_FCT) + """
SELECT 'unique_order_id' AS check_name, 'raw.orders' AS table_name, CAST(order_id AS VARCHAR) AS key_value,
       count(*) AS failing_rows
FROM raw_orders WHERE order_id IS NOT NULL GROUP BY order_id HAVING count(*) > 1
UNION ALL
SELECT 'unique_order_id', 'fct_orders', order_id, count(*)
FROM fct_orders WHERE order_id IS NOT NULL GROUP BY order_id HAVING count(*) > 1
UNION ALL
SELECT 'unique_l_orderkey_l_linenumber', 'lineitem',
       CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR), count(*)
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""

ORACLE["dq_expression"] = with_(*_FCT, SOURCE_ORDER_ITEMS) + """
SELECT 'expression_order_total_usd_ge_0' AS check_name, 'fct_orders' AS table_name,
       count(*) FILTER (WHERE NOT (order_total_usd >= 0)) AS failing_rows, 'error' AS severity FROM fct_orders
UNION ALL SELECT 'expression_updated_after_created', 'stg_orders',
       count(*) FILTER (WHERE NOT (updated_at >= created_at)), 'error' FROM stg_orders
UNION ALL SELECT 'expression_line_total_le_gross', 'order_items',
       count(*) FILTER (WHERE NOT (line_total <= quantity * unit_price)), 'error' FROM source_order_items"""

ORACLE["dq_positive_total"] = with_(*_FCT) + "SELECT order_id FROM fct_orders WHERE order_total_usd <= 0"

ORACLE["dq_check_constraints"] = with_(*_SRC) + """
SELECT 'products_price_check' AS check_name, 'products' AS table_name,
       count(*) FILTER (WHERE NOT (unit_price >= 0)) AS failing_rows, 'error' AS severity FROM source_products
UNION ALL SELECT 'products_cost_check', 'products', count(*) FILTER (WHERE NOT (cost_price IS NULL OR cost_price >= 0)), 'error' FROM source_products
UNION ALL SELECT 'orders_total_check', 'orders', count(*) FILTER (WHERE NOT (order_total >= 0)), 'error' FROM source_orders
UNION ALL SELECT 'orders_tax_check', 'orders', count(*) FILTER (WHERE NOT (tax_amount >= 0)), 'error' FROM source_orders
UNION ALL SELECT 'orders_discount_check', 'orders', count(*) FILTER (WHERE NOT (discount_amount >= 0)), 'error' FROM source_orders
UNION ALL SELECT 'order_items_qty_check', 'order_items', count(*) FILTER (WHERE NOT (quantity > 0)), 'error' FROM source_order_items
UNION ALL SELECT 'order_items_price_check', 'order_items', count(*) FILTER (WHERE NOT (unit_price >= 0)), 'error' FROM source_order_items
UNION ALL SELECT 'order_items_disc_check', 'order_items', count(*) FILTER (WHERE NOT (discount_pct BETWEEN 0 AND 100)), 'error' FROM source_order_items
UNION ALL SELECT 'payments_amount_check', 'payments', count(*) FILTER (WHERE NOT (amount > 0)), 'error' FROM source_payments"""

ORACLE["dq_accepted_values"] = with_(SOURCE_CUSTOMERS, SOURCE_ORDERS, SOURCE_PAYMENTS) + """
SELECT 'accepted_values_segment' AS check_name, 'customers' AS table_name,
       count(*) FILTER (WHERE NOT (segment IN ('enterprise','smb','consumer'))) AS failing_rows,
       'error' AS severity FROM source_customers
UNION ALL SELECT 'accepted_values_status', 'orders', count(*) FILTER (WHERE NOT (status IN
       ('pending','confirmed','processing','shipped','delivered','cancelled','refunded'))), 'error' FROM source_orders
UNION ALL SELECT 'accepted_values_payment_method', 'payments', count(*) FILTER (WHERE NOT (payment_method IN
       ('card','bank_transfer','wallet','cash'))), 'error' FROM source_payments
UNION ALL SELECT 'accepted_values_status', 'payments', count(*) FILTER (WHERE NOT (status IN
       ('pending','authorised','captured','failed','refunded','disputed'))), 'error' FROM source_payments"""

ORACLE["dq_relationships"] = with_(*_SRC) + """
SELECT 'relationships_orders_customer_id_to_customers' AS check_name, 'orders' AS table_name,
       count(*) AS failing_rows, 'error' AS severity
FROM source_orders c WHERE c.customer_id IS NOT NULL
 AND NOT EXISTS (SELECT 1 FROM source_customers p WHERE p.customer_id = c.customer_id)
UNION ALL
SELECT 'relationships_order_items_order_id_to_orders', 'order_items', count(*), 'error'
FROM source_order_items c WHERE c.order_id IS NOT NULL
 AND NOT EXISTS (SELECT 1 FROM source_orders p WHERE p.order_id = c.order_id)
UNION ALL
SELECT 'relationships_order_items_product_id_to_products', 'order_items', count(*), 'error'
FROM source_order_items c WHERE c.product_id IS NOT NULL
 AND NOT EXISTS (SELECT 1 FROM source_products p WHERE p.product_id = c.product_id)
UNION ALL
SELECT 'relationships_payments_order_id_to_orders', 'payments', count(*), 'error'
FROM source_payments c WHERE c.order_id IS NOT NULL
 AND NOT EXISTS (SELECT 1 FROM source_orders p WHERE p.order_id = c.order_id)"""

ORACLE["dq_suite_summary"] = with_(*_FCT) + """,
checks AS (
  SELECT 'not_null_order_id' AS check_name, 'raw.orders' AS table_name,
         count(*) FILTER (WHERE order_id IS NULL) AS failing_rows, 'warn' AS severity FROM raw_orders
  UNION ALL SELECT 'not_null_customer_id', 'raw.orders', count(*) FILTER (WHERE customer_id IS NULL), 'warn' FROM raw_orders
  UNION ALL SELECT 'not_null_order_total', 'raw.orders', count(*) FILTER (WHERE order_total IS NULL), 'warn' FROM raw_orders
  UNION ALL SELECT 'unique_order_id', 'raw.orders', CAST(coalesce(sum(n), 0) AS BIGINT), 'warn'
    FROM (SELECT count(*) AS n FROM raw_orders WHERE order_id IS NOT NULL GROUP BY order_id HAVING count(*) > 1) d
  UNION ALL SELECT 'expression_order_total_usd_ge_0', 'fct_orders',
    count(*) FILTER (WHERE NOT (order_total_usd >= 0)), 'error' FROM fct_orders
  UNION ALL SELECT 'not_null_order_id', 'fct_orders', count(*) FILTER (WHERE order_id IS NULL), 'error' FROM fct_orders
  UNION ALL SELECT 'not_null_customer_id', 'fct_orders', count(*) FILTER (WHERE customer_id IS NULL), 'error' FROM fct_orders
  UNION ALL SELECT 'not_null_order_total_usd', 'fct_orders', count(*) FILTER (WHERE order_total_usd IS NULL), 'error' FROM fct_orders
  UNION ALL SELECT 'not_null_created_at', 'fct_orders', count(*) FILTER (WHERE created_at IS NULL), 'error' FROM fct_orders
  UNION ALL SELECT 'unique_order_id', 'fct_orders', CAST(coalesce(sum(n), 0) AS BIGINT), 'error'
    FROM (SELECT count(*) AS n FROM fct_orders WHERE order_id IS NOT NULL GROUP BY order_id HAVING count(*) > 1) d
)
SELECT check_name, table_name, failing_rows, severity,
       CASE WHEN failing_rows = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status
FROM checks"""

ORACLE["source_freshness"] = with_(RAW_ORDERS, RAW_CUSTOMERS, RAW_PRODUCTS) + f""",
m AS (
  SELECT 'orders' AS source_name, max(_extracted_at) AS max_loaded_at FROM raw_orders
  UNION ALL SELECT 'customers', max(_extracted_at) FROM raw_customers
  UNION ALL SELECT 'products', max(_extracted_at) FROM raw_products
)
SELECT source_name, max_loaded_at,
       CAST(CAST(epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(max_loaded_at) AS DOUBLE) / 3600000000 AS DECIMAL(18,2)) AS age_hours,
       CASE WHEN max_loaded_at IS NULL THEN 'error'
            WHEN CAST(CAST(epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(max_loaded_at) AS DOUBLE) / 3600000000 AS DECIMAL(18,2)) > 24 THEN 'error'
            WHEN CAST(CAST(epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(max_loaded_at) AS DOUBLE) / 3600000000 AS DECIMAL(18,2)) > 12 THEN 'warn'
            ELSE 'pass' END AS status
FROM m"""

ORACLE["int_orders_enriched"] = with_(*_FCT) + """
SELECT f.*, c.segment, c.country_code, c.is_active,
       CAST(date_diff('day', CAST(f.created_at AS DATE), CAST(o.updated_at AS DATE)) AS INTEGER) AS days_to_last_update
FROM fct_orders f
LEFT JOIN stg_orders o ON o.order_id = f.order_id
LEFT JOIN stg_customers c ON c.customer_id = f.customer_id"""

ORACLE["customer_lifetime_value"] = with_(RAW_ORDERS, LATEST_ORDERS) + """
SELECT CAST(customer_id AS VARCHAR) AS customer_id, count(*) AS order_count,
       CAST(sum(order_total) AS DECIMAL(38,2)) AS lifetime_value_usd,
       min(created_at) AS first_order_at, max(created_at) AS last_order_at
FROM latest_orders WHERE status NOT IN ('cancelled', 'refunded')
GROUP BY customer_id"""

ORACLE["dim_customers"] = with_(RAW_CUSTOMERS, STG_CUSTOMERS) + """
SELECT md5(concat_ws('-', coalesce(CAST(customer_id AS VARCHAR), '__null__'))) AS customer_sk,
       customer_id, external_id, email, full_name, segment, country_code, city, is_active,
       created_at, updated_at
FROM stg_customers"""

ORACLE["dim_products"] = with_(RAW_PRODUCTS) + """
SELECT md5(concat_ws('-', coalesce(CAST(product_id AS VARCHAR), '__null__'))) AS product_sk,
       CAST(product_id AS VARCHAR) AS product_id, sku, name, category, sub_category, unit_price,
       cost_price, is_active, updated_at
FROM (SELECT *, row_number() OVER (PARTITION BY product_id
             ORDER BY updated_at DESC NULLS FIRST, _extracted_at DESC NULLS LAST) AS _rn
      FROM raw_products WHERE product_id IS NOT NULL) t
WHERE _rn = 1"""

ORACLE["surrogate_key"] = with_(RAW_ORDERS) + """
SELECT order_ref, ver,
       md5(concat_ws('-', coalesce(CAST(order_id AS VARCHAR), '__null__'),
                          coalesce(CAST(ver AS VARCHAR), '__null__'))) AS order_sk
FROM raw_orders"""

ORACLE["safe_divide"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN l_discount IS NULL OR l_discount = 0 THEN NULL
            ELSE CAST(l_tax AS DOUBLE) / CAST(l_discount AS DOUBLE) END AS tax_per_discount
FROM lineitem"""

ORACLE["cast_uuid"] = with_(RAW_CUSTOMERS) + """
SELECT customer_id, ver, external_id AS external_id_raw,
       CASE WHEN regexp_full_match(lower(trim(external_id)),
                 '[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}')
            THEN lower(trim(external_id)) END AS external_id,
       regexp_full_match(lower(trim(external_id)),
                 '[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}') AS is_valid
FROM raw_customers"""

ORACLE["mask_pii"] = with_(SOURCE_CUSTOMERS) + r"""
SELECT customer_id, sha256(full_name) AS full_name_hash,
       regexp_replace(email, '^(.)[^@]*', '\1***') AS email_masked,
       regexp_replace(phone, '[0-9]', '#', 'g') AS phone_masked, country_code
FROM source_customers"""

ORACLE["row_level_filter"] = with_(SOURCE_CUSTOMERS) + """,
grants AS (
  SELECT lower(replace(r_name, ' ', '_')) || '_analyst' AS reader_role,
         lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS country_code
  FROM nation JOIN region ON n_regionkey = r_regionkey
)
SELECT * FROM source_customers c
WHERE c.country_code IN (SELECT country_code FROM grants WHERE reader_role = 'europe_analyst')"""

ORACLE["flatten_events_json"] = """
SELECT event_id, ts, user_id, event_type, value, CAST(json_extract(props, '$.k') AS BIGINT) AS k
FROM events"""

# -- ingest ----------------------------------------------------------------------
ORACLE["extract_full"] = with_(SOURCE_ORDERS) + \
    f"SELECT *, TIMESTAMP '{LOAD_RUN1_AT}' AS _extracted_at FROM source_orders"

ORACLE["extract_incremental_gt"] = with_(SOURCE_ORDERS) + f"""
SELECT *, TIMESTAMP '{LOAD_RUN2_AT}' AS _extracted_at FROM source_orders
WHERE updated_at > (SELECT max(updated_at) FROM source_orders
                    WHERE updated_at <= TIMESTAMP '{FIRST_RUN_CUTOFF}')"""

ORACLE["extract_interval_ge"] = with_(SOURCE_ORDERS) + f"""
SELECT *, TIMESTAMP '{LOAD_RUN1_AT}' AS _extracted_at FROM source_orders
WHERE updated_at >= TIMESTAMP '{INTERVAL_START}'"""

ORACLE["load_append_overlap"] = with_(SOURCE_ORDERS) + f"""
SELECT * EXCLUDE (_rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id
            ORDER BY updated_at DESC NULLS FIRST, _extracted_at DESC NULLS LAST) AS _rn
  FROM (SELECT *, TIMESTAMP '{LOAD_RUN1_AT}' AS _extracted_at, CAST(1 AS BIGINT) AS _batch_id
        FROM source_orders WHERE updated_at >= TIMESTAMP '{OVERLAP_STARTS[0]}'
        UNION ALL
        SELECT *, TIMESTAMP '{LOAD_RUN2_AT}', CAST(2 AS BIGINT)
        FROM source_orders WHERE updated_at >= TIMESTAMP '{OVERLAP_STARTS[1]}') u
) t WHERE _rn = 1"""


def _two_run_cte(table: str) -> str:
    return f"""
{table}_r1 AS (SELECT max(updated_at) AS wm, count(*) AS n, min(updated_at) AS lo
               FROM source_{table} WHERE updated_at <= TIMESTAMP '{FIRST_RUN_CUTOFF}'),
{table}_r2 AS (SELECT max(updated_at) AS wm, count(*) AS n, min(updated_at) AS lo
               FROM source_{table} WHERE updated_at > (SELECT wm FROM {table}_r1))"""


_LOAD_TABLES = ("orders", "customers", "products")
_LOAD_CTES = with_(SOURCE_ORDERS, SOURCE_CUSTOMERS, SOURCE_PRODUCTS) + "," + \
    ",".join(_two_run_cte(t) for t in _LOAD_TABLES)

ORACLE["watermark_state"] = _LOAD_CTES + "\n" + "\nUNION ALL\n".join(f"""
SELECT '{t}' AS table_name,
       CASE WHEN r2.n > 0 THEN r2.wm ELSE r1.wm END AS watermark,
       CASE WHEN r2.n > 0 THEN r2.n ELSE r1.n END AS row_count,
       CAST(CASE WHEN r2.n > 0 THEN 2 ELSE 1 END AS BIGINT) AS batch_id,
       CAST(NULL AS VARCHAR) AS watermark_key
FROM {t}_r1 r1, {t}_r2 r2""" for t in _LOAD_TABLES)

ORACLE["load_audit"] = _LOAD_CTES + "\n" + "\nUNION ALL\n".join(f"""
SELECT '{t}' AS table_name, CAST(1 AS BIGINT) AS batch_id, 'full' AS load_mode, n AS row_count,
       lo AS min_watermark, wm AS max_watermark, CASE WHEN n > 0 THEN 'loaded' ELSE 'empty' END AS status
FROM {t}_r1
UNION ALL
SELECT '{t}', CAST(2 AS BIGINT), 'incremental', n, lo, wm, CASE WHEN n > 0 THEN 'loaded' ELSE 'empty' END
FROM {t}_r2""" for t in _LOAD_TABLES)

# -- table DML -------------------------------------------------------------------
ORACLE["insert_select"] = with_(SOURCE_PAYMENTS, SOURCE_ORDERS) + """
SELECT p.payment_id, o.order_id, p.payment_method, o.order_total AS amount, o.currency, p.status, p.created_at
FROM source_payments p
JOIN source_orders o ON o.order_ref = 'ORD-' || lpad(CAST(p.order_id AS VARCHAR), 10, '0')"""

ORACLE["insert_ignore"] = with_(RAW_CUSTOMERS) + """,
target AS (SELECT * FROM raw_customers WHERE ver = 0 AND is_active),
first_versions AS (
  SELECT * EXCLUDE (_rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id
              ORDER BY updated_at ASC NULLS LAST, _extracted_at ASC NULLS LAST) AS _rn
    FROM raw_customers) f WHERE _rn = 1)
SELECT * FROM target
UNION ALL
SELECT * FROM first_versions f WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.customer_id = f.customer_id)"""

ORACLE["insert_defaults"] = with_(RAW_ORDERS) + f""",
target AS (SELECT order_id, order_ref, customer_id, status, order_total, tax_amount, discount_amount,
                  currency, created_at, updated_at FROM raw_orders WHERE ver = 0)
SELECT * FROM target
UNION ALL
SELECT (SELECT max(order_id) FROM target) + row_number() OVER (ORDER BY order_ref) AS order_id,
       order_ref, customer_id, 'pending', order_total, CAST(0 AS DECIMAL(18,2)), CAST(0 AS DECIMAL(18,2)),
       'USD', TIMESTAMP '{AS_OF}', TIMESTAMP '{AS_OF}'
FROM raw_orders WHERE order_id IS NULL"""

ORACLE["update_where"] = with_(SOURCE_ORDERS) + f"""
SELECT order_id, order_ref, customer_id,
       CASE WHEN status = 'processing' THEN 'shipped' ELSE status END AS status,
       order_total, tax_amount, discount_amount, currency, created_at,
       CASE WHEN status = 'processing' THEN TIMESTAMP '{AS_OF}' ELSE updated_at END AS updated_at
FROM source_orders"""

ORACLE["upsert_by_key"] = with_(RAW_ORDERS, LATEST_ORDERS) + "SELECT * EXCLUDE (_rn) FROM latest_orders"

ORACLE["incremental_model"] = ORACLE["fct_orders"]

_FCT_V0 = FCT_ORDERS.replace("fct_orders AS", "fct_v0 AS").replace("stg_orders o", "stg_orders_v0 o")
_STG_V0 = STG_ORDERS.replace("stg_orders AS", "stg_orders_v0 AS").replace(
    "FROM raw_orders WHERE order_id IS NOT NULL",
    f"FROM raw_orders WHERE order_id IS NOT NULL AND _extracted_at <= TIMESTAMP '{ORDERS_V0_EXTRACTED_AT}'")
ORACLE["backfill_partition"] = with_(*_FCT, _STG_V0, _FCT_V0) + f"""
SELECT * FROM fct_orders
WHERE date_trunc('month', created_at) BETWEEN TIMESTAMP '{BACKFILL_MONTHS[0]}' AND TIMESTAMP '{BACKFILL_MONTHS[1]}'
UNION ALL
SELECT * FROM fct_v0
WHERE NOT (date_trunc('month', created_at) BETWEEN TIMESTAMP '{BACKFILL_MONTHS[0]}' AND TIMESTAMP '{BACKFILL_MONTHS[1]}')"""

ORACLE["seed_values_join"] = with_(SOURCE_PAYMENTS) + """,
ref(payment_method, payment_provider, fee_rate) AS (VALUES """ + ", ".join(
    f"('{m}', '{p}', CAST('{r}' AS DECIMAL(5,4)))" for m, p, r in PAYMENT_PROVIDERS) + """)
SELECT p.payment_id, p.order_id, p.payment_method, r.payment_provider, p.amount,
       CAST(p.amount * r.fee_rate AS DECIMAL(18,2)) AS fee_usd
FROM source_payments p JOIN ref r ON r.payment_method = p.payment_method"""

# -- history ---------------------------------------------------------------------
_CUST_VERSIONS = """cust_versions AS (
  SELECT * EXCLUDE (_rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id, updated_at
              ORDER BY _extracted_at DESC NULLS LAST) AS _rn
    FROM raw_customers WHERE updated_at IS NOT NULL) v WHERE _rn = 1)"""

ORACLE["scd2_timestamp"] = with_(RAW_CUSTOMERS, _CUST_VERSIONS) + """
SELECT customer_id, segment, email, is_active, updated_at AS valid_from,
       lead(updated_at) OVER (PARTITION BY customer_id ORDER BY updated_at) AS valid_to,
       lead(updated_at) OVER (PARTITION BY customer_id ORDER BY updated_at) IS NULL AS is_current
FROM cust_versions"""

ORACLE["scd2_check"] = with_(RAW_CUSTOMERS, _CUST_VERSIONS) + """,
kept AS (
  SELECT customer_id, segment, updated_at FROM (
    SELECT *, lag(segment) OVER (PARTITION BY customer_id ORDER BY updated_at) AS prev_segment,
              row_number() OVER (PARTITION BY customer_id ORDER BY updated_at) AS pos
    FROM cust_versions) x
  WHERE pos = 1 OR segment IS DISTINCT FROM prev_segment)
SELECT customer_id, segment, updated_at AS valid_from,
       lead(updated_at) OVER (PARTITION BY customer_id ORDER BY updated_at) AS valid_to,
       lead(updated_at) OVER (PARTITION BY customer_id ORDER BY updated_at) IS NULL AS is_current
FROM kept"""

_ORDER_VERSIONS = """order_versions AS (
  SELECT * EXCLUDE (_rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id, updated_at
              ORDER BY _extracted_at DESC NULLS LAST, order_ref DESC NULLS LAST) AS _rn
    FROM raw_orders WHERE updated_at IS NOT NULL) v WHERE _rn = 1)"""

ORACLE["scd2_incremental"] = with_(RAW_ORDERS, _ORDER_VERSIONS) + """
SELECT order_id, status, order_total, updated_at AS valid_from,
       lead(updated_at) OVER (PARTITION BY order_id ORDER BY updated_at) AS valid_to,
       lead(updated_at) OVER (PARTITION BY order_id ORDER BY updated_at) IS NULL AS is_current
FROM order_versions"""

ORACLE["scd2_check_incremental"] = with_(RAW_ORDERS, _ORDER_VERSIONS) + """,
kept AS (
  SELECT order_id, status, order_total, updated_at FROM (
    SELECT *, lag(status) OVER (PARTITION BY order_id ORDER BY updated_at) AS prev_status,
              row_number() OVER (PARTITION BY order_id ORDER BY updated_at) AS pos
    FROM order_versions) x
  WHERE pos = 1 OR status IS DISTINCT FROM prev_status)
SELECT order_id, status, order_total, updated_at AS valid_from,
       lead(updated_at) OVER (PARTITION BY order_id ORDER BY updated_at) AS valid_to,
       lead(updated_at) OVER (PARTITION BY order_id ORDER BY updated_at) IS NULL AS is_current
FROM kept"""

# -- streaming (batch statements of what the streams must leave behind) ----------
ORACLE["cdc_apply"] = with_(CHANGE_EVENTS) + """
SELECT key, seq, ts, op, CAST(json_extract(payload, '$.k') AS BIGINT) AS k FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts DESC NULLS LAST, seq DESC NULLS LAST) AS _rn
  FROM change_events) t
WHERE _rn = 1 AND op <> 'd'"""

_ORDER_CHANGES = f"""order_changes AS (
  SELECT o_orderkey AS order_id, ver, CASE ver WHEN 0 THEN 'c' WHEN 1 THEN 'u' ELSE 'd' END AS op,
         o_orderkey * 10 + ver AS seq,
         CASE ver WHEN 0 THEN o_orderdate + to_days(CAST(o_orderkey % 30 AS INTEGER))
                  WHEN 1 THEN o_orderdate + to_days(31)
                  ELSE o_orderdate + to_days(CASE WHEN o_orderkey % 2 = 0 THEN 40 ELSE 15 END) END AS ts,
         'ORD-' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS order_ref, o_custkey AS customer_id,
         CASE o_orderstatus WHEN 'F' THEN 'delivered'
              WHEN 'O' THEN CASE WHEN ver = 1 THEN 'shipped' ELSE 'processing' END
              WHEN 'P' THEN CASE WHEN ver = 1 THEN 'cancelled' ELSE 'pending' END END AS status,
         CASE WHEN ver = 1 AND o_orderkey % 13 = 0 THEN NULL
              ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN ver = 1 THEN 10 ELSE 0 END AS DECIMAL(18,2)) END
              AS order_total,
         CASE WHEN o_orderkey % 7 <> 0 THEN 'USD' END AS currency
  FROM orders, (VALUES (0), (1), (3)) v(ver)
  WHERE ver = 0 OR (ver = 1 AND o_orderkey % 3 = 0) OR (ver = 3 AND o_orderkey % 11 = 0)
)"""


def _orders_at(where: str) -> str:
    return with_(_ORDER_CHANGES) + f"""
SELECT order_id, order_ref, customer_id, status, order_total, currency, ts AS updated_at, op, seq, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY ts DESC, seq DESC) AS _rn
  FROM order_changes {where}) t
WHERE _rn = 1 AND op <> 'd'"""


ORACLE["cdc_orders_state"] = _orders_at("")
ORACLE["cdc_state_as_of"] = _orders_at(f"WHERE ts <= TIMESTAMP '{STATE_AS_OF}'")

ORACLE["cdc_customers_state"] = with_(RAW_CUSTOMERS) + f""",
changes AS (
  SELECT customer_id, external_id, email, full_name, segment, is_active, ver, updated_at AS ts FROM raw_customers
  UNION ALL
  SELECT c_custkey, NULL, NULL, NULL, NULL, NULL, 3,
         TIMESTAMP '{CUSTOMERS_CREATED_AT}' + to_days(CASE WHEN c_custkey % 2 = 0 THEN 35 ELSE 10 END)
  FROM customer WHERE c_custkey % 17 = 0)
SELECT customer_id, external_id, email, full_name, segment, is_active,
       CASE ver WHEN 0 THEN 'c' ELSE 'u' END AS op, customer_id * 10 + ver AS seq, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY ts DESC, ver DESC) AS _rn FROM changes) t
WHERE _rn = 1 AND ver <> 3"""

ORACLE["cdc_drift"] = with_(_ORDER_CHANGES) + """,
n AS (SELECT count(*) FILTER (WHERE ver <> 3 AND order_id % 5 = 0) AS channel,
             count(*) FILTER (WHERE ver <> 3 AND currency IS NULL) AS currency,
             count(*) FILTER (WHERE ver = 1 AND order_id % 13 = 0) AS total FROM order_changes)
SELECT 'orders' AS table_name, 'channel' AS field, 'added' AS problem, NULL AS declared_type, 'STRING' AS seen_type,
       channel AS n_records FROM n
UNION ALL SELECT 'orders', 'currency', 'missing', 'string', NULL, currency FROM n
UNION ALL SELECT 'orders', 'order_total', 'type', 'decimal(18,2)', 'STRING', total FROM n WHERE total > 0
UNION ALL SELECT 'regions', NULL, 'table', NULL, NULL, count(*) FROM region
UNION ALL SELECT NULL, NULL, 'record', NULL, NULL, count(*) FROM nation"""

ORACLE["stream_dedup"] = "SELECT * FROM events"

ORACLE["stream_dedup_late"] = """
SELECT * FROM events
UNION ALL
SELECT * REPLACE (CAST(NULL AS BIGINT) AS event_id) FROM events WHERE event_id % 50 = 0"""

ORACLE["events_tumbling_count"] = """
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
       event_type, count(*) AS event_count
FROM events GROUP BY 1, 2, 3"""

ORACLE["pipeline_lag"] = """
WITH committed(consumer_name, committed_ts) AS (VALUES """ + ", ".join(
    f"('{c}', TIMESTAMP '{t}')" for c, t in CONSUMER_POSITIONS) + """)
SELECT c.consumer_name, c.committed_ts,
       count(e.ts) AS pending_events, max(e.ts) AS newest_event_ts, count(e.ts) > 10000 AS alert
FROM committed c LEFT JOIN events e ON e.ts > c.committed_ts
GROUP BY c.consumer_name, c.committed_ts"""

ORACLE["dq_failures"] = with_(*_FCT) + """
SELECT 'not_null_order_id' AS check_name, 'raw.orders' AS table_name, order_ref AS key_value,
       CAST(1 AS BIGINT) AS failing_rows FROM raw_orders WHERE order_id IS NULL
UNION ALL SELECT 'not_null_customer_id', 'raw.orders', order_ref, 1 FROM raw_orders WHERE customer_id IS NULL
UNION ALL SELECT 'not_null_order_total', 'raw.orders', order_ref, 1 FROM raw_orders WHERE order_total IS NULL
UNION ALL SELECT 'unique_order_id', 'raw.orders', CAST(order_id AS VARCHAR), count(*)
  FROM raw_orders WHERE order_id IS NOT NULL GROUP BY order_id HAVING count(*) > 1
UNION ALL SELECT 'expression_order_total_usd_ge_0', 'fct_orders', order_id, 1 FROM fct_orders WHERE NOT (order_total_usd >= 0)
UNION ALL SELECT 'not_null_order_id', 'fct_orders', order_id, 1 FROM fct_orders WHERE order_id IS NULL
UNION ALL SELECT 'not_null_customer_id', 'fct_orders', order_id, 1 FROM fct_orders WHERE customer_id IS NULL
UNION ALL SELECT 'not_null_order_total_usd', 'fct_orders', order_id, 1 FROM fct_orders WHERE order_total_usd IS NULL
UNION ALL SELECT 'not_null_created_at', 'fct_orders', order_id, 1 FROM fct_orders WHERE created_at IS NULL
UNION ALL SELECT 'unique_order_id', 'fct_orders', order_id, count(*)
  FROM fct_orders WHERE order_id IS NOT NULL GROUP BY order_id HAVING count(*) > 1"""

ORACLE["full_refresh_model"] = ORACLE["fct_orders"]
ORACLE["catalog_fct_orders"] = ORACLE["fct_orders"]
ORACLE["catalog_orders_by_day"] = with_(*_FCT) + """
SELECT CAST(created_at AS DATE) AS order_day, count(*) AS orders, CAST(sum(order_total_usd) AS DECIMAL(38,2)) AS total_usd
FROM fct_orders GROUP BY CAST(created_at AS DATE)"""

# -- checks over broken rows ------------------------------------------------------
_BAD = ("""bad_customers AS (SELECT * REPLACE (
  CASE WHEN customer_id % 61 = 0 THEN 'vip' WHEN customer_id % 67 = 0 THEN NULL ELSE segment END AS segment)
  FROM source_customers)""", """bad_products AS (SELECT * REPLACE (
  CASE WHEN product_id % 59 = 0 THEN -unit_price ELSE unit_price END AS unit_price,
  CASE WHEN product_id % 53 = 0 THEN -1 ELSE cost_price END AS cost_price)
  FROM source_products)""", """bad_orders AS (SELECT * REPLACE (
  CASE WHEN order_id % 101 = 0 THEN -order_total WHEN order_id % 109 = 0 THEN 0 ELSE order_total END AS order_total,
  CASE WHEN order_id % 103 = 0 THEN -1 ELSE tax_amount END AS tax_amount,
  CASE WHEN order_id % 107 = 0 THEN -0.01 ELSE discount_amount END AS discount_amount,
  CASE WHEN order_id % 79 = 0 THEN 'lost' ELSE status END AS status,
  CASE WHEN order_id % 89 = 0 THEN customer_id + 1000000000 WHEN order_id % 83 = 0 THEN NULL ELSE customer_id END
       AS customer_id)
  FROM source_orders)""", """bad_order_items AS (SELECT * REPLACE (
  CASE WHEN order_id % 71 = 0 THEN 0 ELSE quantity END AS quantity,
  CASE WHEN order_id % 73 = 0 THEN 100.01 ELSE discount_pct END AS discount_pct,
  CASE WHEN order_id % 97 = 0 THEN -order_id WHEN (order_id + line_number) % 113 = 0 THEN NULL ELSE order_id END
       AS order_id,
  CASE WHEN (order_id + line_number) % 127 = 0 THEN -product_id ELSE product_id END AS product_id,
  CASE WHEN (order_id + line_number) % 131 = 0 THEN line_total * 100 ELSE line_total END AS line_total)
  FROM source_order_items)""", """bad_payments AS (SELECT * REPLACE (
  CASE WHEN payment_id % 43 = 0 THEN 0 ELSE amount END AS amount,
  CASE WHEN payment_id % 41 = 0 THEN 'barter' ELSE payment_method END AS payment_method,
  CASE WHEN payment_id % 47 = 0 THEN order_id + 1000000000 WHEN payment_id % 37 = 0 THEN NULL ELSE order_id END
       AS order_id)
  FROM source_payments)""")
_BAD_FCT = """bad_fct_orders AS (SELECT * REPLACE (
  CASE WHEN CAST(order_id AS BIGINT) % 101 = 0 THEN -order_total_usd
       WHEN CAST(order_id AS BIGINT) % 109 = 0 THEN 0 ELSE order_total_usd END AS order_total_usd,
  CASE WHEN CAST(order_id AS BIGINT) % 83 = 0 THEN NULL ELSE customer_id END AS customer_id)
  FROM fct_orders)"""
_BAD_STG = """bad_stg_orders AS (SELECT * REPLACE (
  CASE WHEN CAST(order_id AS BIGINT) % 103 = 0 THEN created_at - INTERVAL 1 DAY ELSE updated_at END AS updated_at)
  FROM stg_orders)"""


def _over_bad(key: str, *ctes: str) -> str:
    """The statement of ``key`` over the broken tables instead."""
    body = ORACLE[key].removeprefix(with_(*ctes))
    return with_(*_SRC, *_FCT, *_BAD, _BAD_FCT, _BAD_STG) + body.replace("source_", "bad_").replace(
        " FROM fct_orders", " FROM bad_fct_orders").replace(" FROM stg_orders", " FROM bad_stg_orders")


ORACLE["fk_orphans_failing"] = _over_bad("fk_orphans", SOURCE_ORDERS, SOURCE_ORDER_ITEMS, SOURCE_PAYMENTS)
ORACLE["dq_check_constraints_failing"] = _over_bad("dq_check_constraints", *_SRC)
ORACLE["dq_accepted_values_failing"] = _over_bad("dq_accepted_values", SOURCE_CUSTOMERS, SOURCE_ORDERS, SOURCE_PAYMENTS)
ORACLE["dq_relationships_failing"] = _over_bad("dq_relationships", *_SRC)
ORACLE["dq_expression_failing"] = _over_bad("dq_expression", *_FCT, SOURCE_ORDER_ITEMS)
ORACLE["dq_positive_total_failing"] = _over_bad("dq_positive_total", *_FCT)

ORACLE["gate_blocks_publish"] = with_(*_FCT, _BAD_FCT) + """,
candidate AS (SELECT * FROM bad_fct_orders
              UNION ALL SELECT * FROM fct_orders WHERE CAST(order_id AS BIGINT) % 151 = 0),
failed AS (
  SELECT 'expression_order_total_usd_ge_0' AS check_name, count(*) FILTER (WHERE NOT (order_total_usd >= 0)) AS n FROM candidate
  UNION ALL SELECT 'not_null_customer_id', count(*) FILTER (WHERE customer_id IS NULL) FROM candidate
  UNION ALL SELECT 'unique_order_id', CAST(coalesce(sum(n), 0) AS BIGINT)
    FROM (SELECT count(*) AS n FROM candidate GROUP BY order_id HAVING count(*) > 1) d)
SELECT check_name, 'fct_orders' AS table_name, n AS rows FROM failed WHERE n > 0
UNION ALL SELECT 'published', 'fct_orders', count(*) FROM fct_orders WHERE order_total_usd > 0"""

ORACLE["snapshot_diff"] = with_(RAW_ORDERS, SOURCE_ORDERS) + """,
old AS (SELECT * EXCLUDE (ver, _extracted_at) FROM raw_orders WHERE ver = 0 AND order_id % 17 <> 0),
new AS (SELECT * FROM source_orders WHERE order_id % 13 <> 0)
SELECT order_id, 'c' AS op FROM new WHERE order_id NOT IN (SELECT order_id FROM old)
UNION ALL SELECT order_id, 'd' FROM old WHERE order_id NOT IN (SELECT order_id FROM new)
UNION ALL SELECT order_id, 'u' FROM (SELECT * FROM new EXCEPT SELECT * FROM old) x
          WHERE order_id IN (SELECT order_id FROM old)"""

ORACLE["snapshot_diff_apply"] = with_(RAW_ORDERS, SOURCE_ORDERS) + f""",
old AS (SELECT * EXCLUDE (ver, _extracted_at) FROM raw_orders WHERE ver = 0 AND order_id % 17 <> 0),
new AS (SELECT * FROM source_orders WHERE order_id % 13 <> 0),
same AS (SELECT order_id FROM (SELECT * FROM new INTERSECT SELECT * FROM old) x)
SELECT order_id, order_ref, customer_id, status, order_total, currency, updated_at,
       CASE WHEN order_id IN (SELECT order_id FROM same) THEN 'r'
            WHEN order_id IN (SELECT order_id FROM old) THEN 'u' ELSE 'c' END AS op,
       CAST(0 AS BIGINT) AS seq,
       CASE WHEN order_id IN (SELECT order_id FROM same) THEN TIMESTAMP '{LOAD_RUN1_AT}'
            ELSE TIMESTAMP '{LOAD_RUN2_AT}' END AS ts
FROM new"""

ORACLE["insert_by_email"] = with_(SOURCE_ORDERS, SOURCE_CUSTOMERS) + """
SELECT o.order_ref, c.customer_id, o.order_total
FROM source_orders o JOIN source_customers c ON c.email = 'customer' || CAST(o.customer_id AS VARCHAR) || '@example.com'"""

ORACLE["colocated_join"] = with_(SOURCE_ORDERS, SOURCE_ORDER_ITEMS) + """
SELECT o.order_id, o.status, o.order_total, count(*) AS lines, CAST(sum(i.line_total) AS DECIMAL(28,2)) AS lines_total
FROM source_order_items i JOIN source_orders o ON o.order_id = i.order_id
GROUP BY o.order_id, o.status, o.order_total"""

_ASIA = """countries AS (
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code FROM nation JOIN region ON n_regionkey = r_regionkey
  WHERE r_name = 'ASIA')"""

ORACLE["policy_analyst"] = with_(SOURCE_CUSTOMERS, _ASIA) + r"""
SELECT * REPLACE (sha256(full_name) AS full_name, regexp_replace(email, '^(.)[^@]*', '\1***') AS email,
                  regexp_replace(phone, '[0-9]', '#', 'g') AS phone)
FROM source_customers WHERE country_code IN (SELECT code FROM countries)"""

ORACLE["policy_support"] = with_(SOURCE_CUSTOMERS) + r"""
SELECT customer_id, email, regexp_replace(phone, '[0-9]', '#', 'g') AS phone, CAST(NULL AS VARCHAR) AS full_name
FROM source_customers WHERE is_active"""

ORACLE["events_counts_late"] = """
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
       event_type, count(*) AS event_count
FROM (SELECT * REPLACE (CASE WHEN event_id % 40 <> 0 THEN ts END AS ts) FROM events) e GROUP BY 1, 2, 3"""

ORACLE["stream_progress"] = """
SELECT event_id % 3 AS batch_id, count(*) AS input_rows FROM events GROUP BY 1"""
