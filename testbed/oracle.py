"""The registered queries as DuckDB SQL, written against the test tables."""

from __future__ import annotations

from testbed.fixtures import KEYS, TABLES

_TITLE = (
    "array_to_string(list_transform(string_split(lower(trim({c})), ' '), "
    "lambda w: upper(w[1]) || w[2:]), ' ')"
)


def _title(c: str) -> str:
    return _TITLE.format(c=c)


T0 = "timestamp '1995-01-01 00:00:00'"

# Raw entities.
_RAW_CUSTOMERS = f"""
cust_base AS (
  SELECT c_custkey AS k, '  ' || c_name || ' ' AS name, ' ' || lower(c_mktsegment) AS city,
         lower(n_name) || ' ' AS state,
         {T0} + to_days(CAST(c_custkey % 365 AS INTEGER)) AS signup_date,
         {T0} + to_days(CAST(c_custkey % 365 + c_custkey % 30 AS INTEGER)) AS updated_at
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
raw_customers AS (
  SELECT CAST(k AS VARCHAR) AS customer_id, name, city, state, signup_date, signup_date AS created_at, updated_at
  FROM cust_base
  UNION ALL
  SELECT CAST(k AS VARCHAR), name, ' relocated  city ', state, signup_date, signup_date, updated_at + to_days(10)
  FROM cust_base WHERE k % 7 = 0
  UNION ALL
  SELECT NULL, name, city, state, signup_date, signup_date, updated_at FROM cust_base WHERE k % 100 = 1
  UNION ALL
  SELECT 'bad-' || CAST(k AS VARCHAR), name, city, state, signup_date, signup_date, updated_at
  FROM cust_base WHERE k % 100 = 2)"""

_RAW_PRODUCTS = f"""
raw_products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, ' ' || p_name || ' ' AS product_name,
         lower(p_type) AS category, CAST(p_retailprice AS VARCHAR) AS price,
         {T0} + to_days(CAST(p_partkey % 365 AS INTEGER)) AS created_at,
         {T0} + to_days(CAST(p_partkey % 365 + p_partkey % 30 AS INTEGER)) AS updated_at
  FROM part)"""

_RAW_ORDERS = """
raw_orders AS (
  SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 53 = 0 THEN NULL WHEN o_orderkey % 47 = 0 THEN -o_custkey ELSE o_custkey END AS customer_id,
         o_orderdate AS order_date,
         ' ' || lower(o_orderstatus) AS order_status, o_totalprice AS total_amount, o_orderdate AS created_at,
         o_orderdate + to_days(CAST(o_orderkey % 30 AS INTEGER)) AS updated_at
  FROM orders
  UNION ALL
  SELECT o_orderkey, CASE WHEN o_orderkey % 53 = 0 THEN NULL WHEN o_orderkey % 47 = 0 THEN -o_custkey ELSE o_custkey END, o_orderdate, ' x ', o_totalprice, o_orderdate,
         o_orderdate + to_days(CAST(o_orderkey % 30 AS INTEGER)) + to_days(40)
  FROM orders WHERE o_orderkey % 10 = 0)"""

_RAW_ITEMS = """
raw_order_items AS (
  SELECT l_orderkey * 10 + l_linenumber AS order_item_id, l_orderkey AS order_id,
         CASE WHEN l_orderkey % 59 = 0 THEN NULL WHEN l_orderkey % 43 = 0 THEN -l_partkey ELSE l_partkey END AS product_id,
         l_quantity AS quantity, l_extendedprice AS price, l_shipdate AS created_at, l_shipdate AS updated_at
  FROM lineitem)"""

# Cleaned entities.
_CLEAN_CUSTOMERS = f"""
clean_customers AS (
  SELECT TRY_CAST(customer_id AS BIGINT) AS customer_id, trim(name) AS name, {_title("city")} AS city,
         upper(trim(state)) AS state, signup_date, created_at, updated_at
  FROM raw_customers WHERE TRY_CAST(customer_id AS BIGINT) IS NOT NULL)"""
_CLEAN_PRODUCTS = f"""
clean_products AS (
  SELECT TRY_CAST(product_id AS BIGINT) AS product_id, trim(product_name) AS product_name,
         {_title("category")} AS category, TRY_CAST(price AS DOUBLE) AS price, created_at, updated_at
  FROM raw_products WHERE TRY_CAST(product_id AS BIGINT) IS NOT NULL)"""
_CLEAN_ORDERS = """
clean_orders AS (
  SELECT order_id, customer_id, order_date, upper(trim(order_status)) AS order_status,
         CAST(total_amount AS DOUBLE) AS total_amount, created_at, updated_at
  FROM raw_orders WHERE order_id IS NOT NULL)"""
_CLEAN_ITEMS = """
clean_order_items AS (
  SELECT order_item_id, order_id, product_id, CAST(trunc(quantity) AS INTEGER) AS quantity,
         CAST(price AS DOUBLE) AS price, created_at, updated_at
  FROM raw_order_items WHERE order_item_id IS NOT NULL)"""


def _latest(name: str, source: str, keys: str, order: str, where: str = "true") -> str:
    return f"""
{name} AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM {source} WHERE {where})
  WHERE rn = 1)"""


def _newest(*cols: str) -> str:
    return ", ".join(f"{c} DESC NULLS LAST" for c in cols)


_BY_CUSTOMER = _newest("updated_at", "created_at", "name", "city", "state", "signup_date")
_BY_PRODUCT = _newest("updated_at", "created_at", "product_name", "category", "price")
_BY_ORDER = _newest("updated_at", "created_at", "customer_id", "order_date", "order_status", "total_amount")
_BY_ITEM = _newest("updated_at", "created_at", "product_id", "order_id", "quantity", "price")

_CUSTOMERS = [_RAW_CUSTOMERS, _CLEAN_CUSTOMERS, _latest("customers_s", "clean_customers", "customer_id", _BY_CUSTOMER)]
_PRODUCTS = [_RAW_PRODUCTS, _CLEAN_PRODUCTS, _latest("products_s", "clean_products", "product_id", _BY_PRODUCT)]
_ORDERS = [_RAW_ORDERS, _CLEAN_ORDERS, _latest("orders_s", "clean_orders", "order_id", _BY_ORDER)]
_ITEMS = [_RAW_ITEMS, _CLEAN_ITEMS, _latest("order_items_s", "clean_order_items", "order_item_id", _BY_ITEM)]


def _joined(name: str, orders: str) -> str:
    return f"""
{name} AS (
  SELECT i.order_item_id, i.order_id, o.customer_id, i.product_id, o.order_date, o.order_status,
         c.name AS customer_name, c.city, c.state, p.product_name, p.category, i.quantity,
         i.price AS unit_price, i.quantity * i.price AS sales_amount, o.total_amount AS order_total_amount,
         o.created_at AS order_created_at, o.updated_at AS order_updated_at
  FROM order_items_s i JOIN {orders} o ON i.order_id = o.order_id
  LEFT JOIN customers_s c ON o.customer_id = c.customer_id
  LEFT JOIN products_s p ON i.product_id = p.product_id)"""


_FACT = """
fact AS (
  SELECT *, CAST(order_date AS DATE) AS order_date_only, CAST(year(order_date) AS INTEGER) AS order_year,
         CAST(month(order_date) AS INTEGER) AS order_month, CAST(day(order_date) AS INTEGER) AS order_day
  FROM enriched)"""

_ALL = [*_CUSTOMERS, *_PRODUCTS, *_ORDERS, *_ITEMS]
_SALES = [*_ALL, _joined("enriched", "orders_s"), _FACT]

_REVENUE = "CAST(round(sum(CAST(sales_amount AS DECIMAL(24,6))), 2) AS DOUBLE)"
_UNITS = "CAST(sum(quantity) AS BIGINT)"

_BY_STATE = f"""SELECT state, {_REVENUE} AS total_revenue, count(DISTINCT order_id) AS total_orders,
  count(DISTINCT customer_id) AS total_customers FROM enriched GROUP BY state"""
_TOP_PRODUCTS = f"""SELECT product_id, product_name, category, {_UNITS} AS units_sold, {_REVENUE} AS revenue
  FROM enriched GROUP BY product_id, product_name, category"""
_DAILY = f"""SELECT order_date_only, {_REVENUE} AS daily_revenue, count(DISTINCT order_id) AS daily_orders,
  count(DISTINCT customer_id) AS daily_customers FROM fact GROUP BY order_date_only"""
_MONTHLY = f"""SELECT order_year, order_month, {_REVENUE} AS monthly_revenue,
  count(DISTINCT order_id) AS monthly_orders, count(DISTINCT customer_id) AS monthly_customers
  FROM fact GROUP BY order_year, order_month"""
_CATEGORY = f"""SELECT category, {_REVENUE} AS category_revenue, {_UNITS} AS units_sold
  FROM enriched GROUP BY category"""

# Batches of orders, by updated_at, each reduced to the latest row per order.
_BATCH_OF = """CASE WHEN updated_at < timestamp '1999-01-01' THEN 0
  WHEN updated_at < timestamp '2000-07-01' THEN 1 ELSE 2 END"""
_VERSIONED = [
    _RAW_ORDERS, _CLEAN_ORDERS,
    f"tagged AS (SELECT *, CAST({_BATCH_OF} AS INTEGER) AS _version FROM clean_orders)",
    _latest("reduced", "tagged", "order_id, _version", _BY_ORDER),
    """versions AS (SELECT *, timestamp '2024-01-01' + to_days(_version) AS _commit_ts,
  CASE WHEN _version = 2 AND order_id % 17 = 0 THEN 'DELETE' ELSE 'WRITE' END AS _op FROM reduced)""",
]


def _batch(name: str, numbers: str) -> str:
    return _latest(name, "tagged", "order_id", _BY_ORDER, f"_version IN ({numbers})")


_KEYLESS = "CASE WHEN order_id % 101 <> 0 THEN order_id END AS order_id"
_MERGE = [
    *_VERSIONED,
    _batch("t_all", "0, 2"), _batch("s_all", "0, 1"),
    f"t AS (SELECT * EXCLUDE (_version) REPLACE ({_KEYLESS}), 1 AS there FROM t_all)",
    f"""s AS (SELECT * EXCLUDE (_version) REPLACE ({_KEYLESS}, 'S' AS order_status,
  updated_at + to_days(CASE WHEN order_id % 2 = 0 THEN 2000 ELSE -2000 END) AS updated_at), 1 AS there FROM s_all)""",
]


def _sql(parts: list[str], final: str) -> str:
    return "WITH " + ",".join(p.strip() for p in parts) + "\n" + final


_O = "order_id, customer_id, order_date, order_status, total_amount, created_at, updated_at"
_O_STATE = "SELECT " + _O + " FROM "
_MARK = "timestamp '2000-01-01'"

_MARKS = [
    _RAW_CUSTOMERS, _RAW_PRODUCTS, _RAW_ORDERS, _RAW_ITEMS,
    """loaded AS (
  SELECT 'customers' AS table_name, max(updated_at) AS last_run_ts FROM raw_customers
  UNION ALL SELECT 'products', max(updated_at) FROM raw_products
  UNION ALL SELECT 'orders', max(updated_at) FROM raw_orders
  UNION ALL SELECT 'order_items', max(updated_at) FROM raw_order_items)""",
]

_RUN_LOG = """
runs AS (
  SELECT o_orderstatus || '-' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS run_id,
         CASE o_orderstatus WHEN 'F' THEN 'GOLD' WHEN 'O' THEN 'OPTIMIZE' ELSE 'VACUUM' END AS layer_name,
         'orders' AS table_name, 'SUCCESS' AS run_status, count(*) AS row_count, o_orderdate AS run_start_ts
  FROM orders GROUP BY o_orderdate, o_orderstatus)"""

_TEXT_ORDERS = """
text_orders AS (
  SELECT order_id, order_status, TRY_CAST(CAST(order_date AS VARCHAR) AS TIMESTAMP) AS order_date,
         TRY_CAST(CASE WHEN order_id % 11 = 3 THEN 'unknown' ELSE CAST(updated_at AS VARCHAR) END AS TIMESTAMP) AS updated_at
  FROM raw_orders)"""

_CHANGED = f"changed AS (SELECT * FROM orders_s WHERE updated_at > {_MARK} OR created_at > {_MARK})"

_OLD_MARK = "timestamp '1996-01-01'"


def _since(a: str = "") -> str:
    return f"({a}updated_at > {_OLD_MARK} OR {a}created_at > {_OLD_MARK})"


_STATE_1 = f"""SELECT {_O} FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY _version DESC) AS rn FROM versions WHERE _version <= 1)
  WHERE rn = 1"""

_WORKED = """SELECT table_name, last_run_ts, 'run-1' AS last_run_id,
  CASE table_name WHEN 'products' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  CASE table_name WHEN 'products' THEN timestamp '2024-01-01 07:00:00'
       ELSE timestamp '2024-01-01 06:00:00' END AS updated_at
  FROM loaded WHERE table_name <> 'orders'
  UNION ALL SELECT name, timestamp '1900-01-01', NULL, 'RUNNING', timestamp '2024-01-01 07:00:00'
  FROM (VALUES ('orders'), ('silver_orders')) AS started(name)"""

# Stretches of 32,768 ids, as the bitmaps are cut: those above zero, and the others towards zero.
_BUCKET_OF = "CASE WHEN {c} > 0 THEN 1 + ({c} - 1) // 32768 ELSE -(-{c} // 32768) END"


def _ids_per_day(what: str, column: str) -> str:
    return f"""SELECT order_date_only, '{what}' AS counted, CAST({_BUCKET_OF.format(c=column)} AS BIGINT) AS bucket,
  count(DISTINCT {column}) AS ids, NULL::DOUBLE AS amount FROM fact WHERE {column} IS NOT NULL GROUP BY ALL"""


_INTERVALS = """SELECT *, CAST(coalesce(lead(_version) OVER following, 2147483647) AS INTEGER) AS _to,
  coalesce(lead(_commit_ts) OVER following, timestamp '9999-12-31') AS _to_ts
  FROM versions WINDOW following AS (PARTITION BY order_id ORDER BY _version)"""

ORACLE: dict[str, str] = {
    "clean_customers": _sql([_RAW_CUSTOMERS, _CLEAN_CUSTOMERS], "SELECT * FROM clean_customers"),
    "clean_products": _sql([_RAW_PRODUCTS, _CLEAN_PRODUCTS], "SELECT * FROM clean_products"),
    "clean_orders": _sql([_RAW_ORDERS, _CLEAN_ORDERS], "SELECT * FROM clean_orders"),
    "clean_order_items": _sql([_RAW_ITEMS, _CLEAN_ITEMS], "SELECT * FROM clean_order_items"),
    "clean_rejects": _sql([_RAW_CUSTOMERS], """SELECT *,
  CASE WHEN customer_id IS NULL THEN 'missing key' ELSE 'unreadable key' END AS reject_reason
  FROM raw_customers WHERE TRY_CAST(customer_id AS BIGINT) IS NULL"""),
    "standardize_timestamps": _sql([_RAW_ORDERS, _TEXT_ORDERS], "SELECT * FROM text_orders"),
    "dedup_latest": _sql([_RAW_ITEMS, _latest("one", "raw_order_items", "order_item_id", _BY_ITEM)], "SELECT * FROM one"),
    "sales_enriched": _sql(_SALES, "SELECT * FROM enriched"),
    "dim_customers": _sql(_CUSTOMERS, "SELECT * FROM customers_s"),
    "dim_products": _sql(_PRODUCTS, "SELECT * FROM products_s"),
    "fact_sales": _sql(_SALES, "SELECT * FROM fact"),
    "partitioned_fact": _sql(_SALES, "SELECT * FROM fact"),
    "revenue_by_state": _sql(_SALES, _BY_STATE),
    "daily_parts": _sql(_SALES, f"""{_ids_per_day("orders", "order_id")} UNION ALL {_ids_per_day("customers", "customer_id")}
  UNION ALL SELECT order_date_only, 'amount', NULL, NULL, CAST(sum(CAST(sales_amount AS DECIMAL(24,6))) AS DOUBLE) FROM fact GROUP BY ALL"""),
    "revenue_by_state_from_parts": _sql(_SALES, _BY_STATE),
    "daily_sales_from_parts": _sql(_SALES, _DAILY),
    "monthly_sales_from_parts": _sql(_SALES, _MONTHLY),
    "sales_from_merged_deliveries": _sql(_SALES, _BY_STATE),
    "aggregates_in_one_scan": _sql(_SALES, f"""SELECT 'agg_revenue_by_state' AS aggregate, * FROM ({_BY_STATE})
  UNION ALL BY NAME SELECT 'agg_top_products' AS aggregate, * FROM ({_TOP_PRODUCTS})
  UNION ALL BY NAME SELECT 'agg_daily_sales' AS aggregate, * FROM ({_DAILY})
  UNION ALL BY NAME SELECT 'agg_monthly_sales' AS aggregate, * FROM ({_MONTHLY})
  UNION ALL BY NAME SELECT 'agg_category_sales' AS aggregate, * FROM ({_CATEGORY})"""),
    "top_products_agg": _sql(_SALES, _TOP_PRODUCTS),
    "daily_sales": _sql(_SALES, _DAILY),
    "monthly_sales": _sql(_SALES, _MONTHLY),
    "category_sales": _sql(_SALES, _CATEGORY),
    "report_revenue_by_state": _sql(_SALES, _BY_STATE + " ORDER BY total_revenue DESC"),
    "report_top10_products": _sql(_SALES, f"""SELECT product_name, category, units_sold, revenue FROM ({_TOP_PRODUCTS})
  ORDER BY revenue DESC, product_id ASC NULLS LAST LIMIT 10"""),
    "report_daily_trend": _sql(_SALES, f"""SELECT order_date_only AS sales_date, daily_revenue, daily_orders, daily_customers
  FROM ({_DAILY}) ORDER BY sales_date"""),
    "report_monthly_trend": _sql(_SALES, _MONTHLY + " ORDER BY order_year, order_month"),
    "report_category_revenue": _sql(_SALES, _CATEGORY + " ORDER BY category_revenue DESC"),
    "report_avg_order_value": _sql(_SALES, """SELECT order_year, order_month,
  round(CAST(sum(CAST(sales_amount AS DECIMAL(24,6))) AS DOUBLE) / count(DISTINCT order_id), 2) AS avg_order_value
  FROM fact GROUP BY order_year, order_month ORDER BY order_year, order_month"""),
    "sql_category_revenue": _sql(_SALES, _CATEGORY + " ORDER BY category_revenue DESC"),
    "merge_insert_only": _sql(_MERGE, f"""SELECT {_O} FROM t
  UNION ALL SELECT {_O} FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.order_id = s.order_id)"""),
    "merge_partial_update": _sql(_MERGE, """SELECT
  CASE WHEN t.there IS NULL THEN s.order_id ELSE t.order_id END AS order_id, t.customer_id, t.order_date,
  CASE WHEN s.there IS NULL THEN t.order_status ELSE s.order_status END AS order_status, t.total_amount,
  CASE WHEN t.there IS NULL THEN s.created_at ELSE t.created_at END AS created_at,
  CASE WHEN s.there IS NULL THEN t.updated_at ELSE s.updated_at END AS updated_at
  FROM t FULL JOIN s ON t.order_id = s.order_id"""),
    "merge_upsert_all": _sql(_MERGE, f"""SELECT {_O} FROM s
  UNION ALL SELECT {_O} FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.order_id = t.order_id)"""),
    "merge_upsert_newer": _sql(_MERGE, f"""SELECT {_O} FROM t
  WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.order_id = t.order_id AND s.updated_at > t.updated_at)
  UNION ALL SELECT {_O} FROM s
  WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.order_id = s.order_id AND s.updated_at <= t.updated_at)"""),
    "conditional_update": _sql(_ORDERS, """SELECT * REPLACE (
    CASE WHEN order_status = 'O' AND updated_at < timestamp '1998-01-01' THEN 'LATE' ELSE order_status END AS order_status,
    CASE WHEN order_status = 'O' AND updated_at < timestamp '1998-01-01' THEN updated_at + to_days(1) ELSE updated_at END AS updated_at)
  FROM orders_s"""),
    "incremental_filter": _sql([_RAW_ORDERS], f"SELECT * FROM raw_orders WHERE updated_at > {_MARK}"),
    "incremental_chosen_column": _sql([_RAW_ORDERS], f"SELECT * FROM raw_orders WHERE created_at > {_MARK}"),
    "unmarked_rows": _sql([_RAW_ORDERS, _TEXT_ORDERS], "SELECT * FROM text_orders WHERE updated_at IS NULL"),
    "next_watermark": _sql(_VERSIONED[:3], """SELECT _version AS batch,
  greatest(max(created_at), max(updated_at)) AS next_mark FROM tagged GROUP BY _version"""),
    "last_watermark": _sql(_MARKS, """SELECT * FROM loaded
  UNION ALL SELECT 'never_loaded', timestamp '1900-01-01'"""),
    "mark_lifecycle": _sql(_MARKS, _WORKED),
    "silver_marks": _sql(_MARKS, f"SELECT * FROM ({_WORKED}) WHERE table_name LIKE '%ord_r%'"),
    "changed_orders": _sql([*_ORDERS, _CHANGED], "SELECT * FROM changed"),
    "affected_orders": _sql(_ALL, f"""SELECT * FROM orders_s o WHERE {_since("o.")}
  OR EXISTS (SELECT 1 FROM order_items_s i WHERE i.order_id = o.order_id AND {_since("i.")})
  OR EXISTS (SELECT 1 FROM customers_s c WHERE c.customer_id = o.customer_id AND {_since("c.")})
  OR EXISTS (SELECT 1 FROM order_items_s i JOIN products_s p ON i.product_id = p.product_id
             WHERE i.order_id = o.order_id AND {_since("p.")})"""),
    "semi_join_items": _sql([*_ORDERS, *_ITEMS, _CHANGED], """SELECT * FROM order_items_s
  WHERE order_id IN (SELECT order_id FROM changed)"""),
    "incremental_enriched": _sql([*_ALL, _CHANGED, _joined("enriched", "changed")], "SELECT * FROM enriched"),
    "row_counts": _sql(_SALES, """SELECT 'brz_customers_raw' AS table_name, count(*) AS cnt FROM raw_customers
  UNION ALL SELECT 'brz_products_raw', count(*) FROM raw_products
  UNION ALL SELECT 'brz_orders_raw', count(*) FROM raw_orders
  UNION ALL SELECT 'brz_order_items_raw', count(*) FROM raw_order_items
  UNION ALL SELECT 'slv_customers', count(*) FROM customers_s
  UNION ALL SELECT 'slv_products', count(*) FROM products_s
  UNION ALL SELECT 'slv_orders', count(*) FROM orders_s
  UNION ALL SELECT 'slv_order_items', count(*) FROM order_items_s
  UNION ALL SELECT 'slv_sales_enriched', count(*) FROM enriched
  UNION ALL SELECT 'gld_fact_sales', count(*) FROM fact"""),
    "file_row_counts": "\nUNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS cnt FROM {t}" for t in TABLES),
    "file_column_bounds": "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, min({c})::BIGINT AS low, max({c})::BIGINT AS high, count({c}) AS known FROM {t}"
        for t, cols in KEYS.items() for c in cols),
    "duplicate_keys": _sql(_ALL, """SELECT 'customers' AS table_name, customer_id AS key, count(*) AS cnt
  FROM clean_customers GROUP BY customer_id HAVING count(*) > 1
  UNION ALL SELECT 'products', product_id, count(*) FROM clean_products GROUP BY product_id HAVING count(*) > 1
  UNION ALL SELECT 'orders', order_id, count(*) FROM clean_orders GROUP BY order_id HAVING count(*) > 1
  UNION ALL SELECT 'order_items', order_item_id, count(*) FROM clean_order_items
  GROUP BY order_item_id HAVING count(*) > 1"""),
    "cast_failures": _sql([_RAW_CUSTOMERS, _RAW_PRODUCTS, _RAW_ORDERS, _RAW_ITEMS], """SELECT * FROM (
  SELECT 'customers' AS table_name, unnest(['customer_id', 'signup_date', 'created_at', 'updated_at']) AS column_name,
         unnest([count(*) FILTER (customer_id IS NOT NULL AND TRY_CAST(customer_id AS BIGINT) IS NULL),
                 count(*) FILTER (customer_id LIKE '%7'), 0, 0]) AS failed FROM raw_customers
  UNION ALL SELECT 'products', unnest(['product_id', 'price', 'created_at', 'updated_at']),
         unnest([0, count(*) FILTER (CAST(product_id AS BIGINT) % 13 = 5), 0, 0]) FROM raw_products
  UNION ALL SELECT 'orders', unnest(['order_id', 'customer_id', 'order_date', 'total_amount', 'created_at', 'updated_at']),
         unnest([0, 0, 0, count(*) FILTER (order_id % 97 = 5), 0, 0]) FROM raw_orders
  UNION ALL SELECT 'order_items', unnest(['order_item_id', 'order_id', 'product_id', 'quantity', 'price', 'created_at', 'updated_at']),
         unnest([0, 0, 0, count(*) FILTER (order_item_id % 31 = 2), 0, 0, 0]) FROM raw_order_items)"""),
    "check_constraint": _sql([_RAW_ORDERS, _CLEAN_ORDERS], """SELECT * FROM clean_orders
  WHERE NOT coalesce(order_status IN ('O', 'F', 'P'), false)"""),
    "recent_runs": _sql([_RUN_LOG], """SELECT * FROM runs WHERE layer_name = 'GOLD'
  ORDER BY run_start_ts DESC, run_id LIMIT 20"""),
    "recent_layout_runs": _sql([_RUN_LOG], """SELECT * FROM runs WHERE layer_name IN ('OPTIMIZE', 'VACUUM')
  ORDER BY run_start_ts DESC, run_id LIMIT 30"""),
    "as_of_version": _sql(_VERSIONED, _STATE_1),
    "as_of_timestamp": _sql(_VERSIONED, f"SELECT {_O} FROM versions WHERE _version = 0"),
    "current_state": _sql(_VERSIONED, f"""SELECT {_O} FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY _version DESC) AS rn FROM versions)
  WHERE rn = 1 AND _op <> 'DELETE'"""),
    "version_increment": _sql(_VERSIONED, f"SELECT {_O} FROM versions WHERE _version = 2 AND _op <> 'DELETE'"),
    "expire_snapshots": _sql(_VERSIONED, f"SELECT {_O}, _version, _commit_ts, _op FROM versions WHERE _version >= 1"),
    "version_history": _sql(_VERSIONED, """SELECT _version AS version, min(_commit_ts) AS commit_ts,
  count(*) FILTER (_op = 'WRITE') AS rows_written, count(*) FILTER (_op = 'DELETE') AS rows_deleted FROM versions GROUP BY _version"""),
    "expire_versions": _sql([*_VERSIONED, f"state AS ({_STATE_1})"], f"""SELECT {_O}, CAST(1 AS INTEGER) AS _version,
  timestamp '2024-01-02' AS _commit_ts, 'WRITE' AS _op FROM state
  UNION ALL SELECT {_O}, _version, _commit_ts, _op FROM versions WHERE _version = 2"""),
    "fact_as_of_timestamp": _sql(
        [*_CUSTOMERS, *_PRODUCTS, *_ITEMS, *_VERSIONED, f"state AS ({_STATE_1})", _joined("enriched", "state"), _FACT],
        "SELECT * FROM fact"),
    "order_intervals": _sql(_VERSIONED, f"SELECT {_O}, _version, _commit_ts, _op, _to, _to_ts FROM ({_INTERVALS})"),
    "order_intervals_extended": _sql(_VERSIONED, f"SELECT {_O}, _version, _commit_ts, _op, _to, _to_ts FROM ({_INTERVALS})"),
    "interval_as_of_version": _sql(_VERSIONED, _STATE_1),
    "interval_as_of_timestamp": _sql(_VERSIONED, f"SELECT {_O} FROM versions WHERE _version = 0"),
    "interval_expire": _sql(_VERSIONED, f"""SELECT {_O}, CAST(greatest(_version, 1) AS INTEGER) AS _version,
  greatest(_commit_ts, timestamp '2024-01-02') AS _commit_ts, _op, _to, _to_ts FROM ({_INTERVALS})
  WHERE _to > 1 AND NOT (_version <= 1 AND _op = 'DELETE')"""),
    "refreshed_fact": _sql(_SALES, "SELECT * FROM fact"),
    "zorder_rewrite": _sql([_RAW_ORDERS], "SELECT * FROM raw_orders"),
}
# Other ways to the same rows.
ORACLE["merge_upsert_bucketed"] = ORACLE["merge_upsert_all"]
ORACLE["merge_upsert_bucketed_newer"] = ORACLE["merge_upsert_newer"]
ORACLE["interval_current_state"] = ORACLE["current_state"]
