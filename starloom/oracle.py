"""For each registered query, the same result as SQL over the test tables (DuckDB)."""

from __future__ import annotations

_STAMP = "'%Y-%m-%d %H:%M:%S'"

_STG_ORDERS = f"""
stg_orders AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
         CAST(o_custkey AS VARCHAR) AS customer_id,
         o_orderstatus AS order_status,
         strftime(o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)), {_STAMP})
           AS order_purchase_timestamp,
         CAST(NULL AS VARCHAR) AS order_approved_at,
         CAST(NULL AS VARCHAR) AS order_delivered_carrier_date,
         CASE WHEN o_orderstatus <> 'P' THEN strftime(shipped, {_STAMP}) END
           AS order_delivered_customer_date,
         strftime(o_orderdate, {_STAMP}) AS order_estimated_delivery_date
  FROM orders
  LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS shipped FROM lineitem GROUP BY l_orderkey) s
    ON s.l_orderkey = o_orderkey
)"""

_ITEM_COLUMNS = """
         CAST(l_partkey AS VARCHAR) AS product_id,
         CAST(l_suppkey AS VARCHAR) AS seller_id,
         CAST(NULL AS VARCHAR) AS shipping_limit_date,
         CASE WHEN l_orderkey % 97 = 0 THEN '   '
              ELSE ' ' || CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) || ' ' END AS price,
         CASE WHEN l_orderkey % 89 <> 0
              THEN CAST(CAST(l_quantity AS DECIMAL(12,2)) AS VARCHAR) END AS freight_value
  FROM lineitem
)"""

_STG_RAW_ITEMS = f"""
stg_order_items AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
         CAST(l_linenumber AS VARCHAR) AS order_item_id,{_ITEM_COLUMNS}"""

_STG_ITEMS = f"""
stg_order_items AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
         CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey,
           l_suppkey, l_shipdate, l_extendedprice) AS VARCHAR) AS order_item_id,{_ITEM_COLUMNS}"""

_STG_CUSTOMERS = """
stg_customers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
         c_name AS customer_unique_id,
         lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
         '  ' || lower(replace(r_name, ' ', '-')) || ' d''' || lower(n_name) AS customer_city,
         lower(substring(r_name, 1, 2)) || ' ' AS customer_state
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

_STG_PRODUCTS = """
stg_products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id,
         replace(p_name, ' ', '_') AS product_category_name,
         CAST(NULL AS VARCHAR) AS product_name_lenght,
         CAST(NULL AS VARCHAR) AS product_description_lenght,
         CAST(NULL AS VARCHAR) AS product_photos_qty,
         CASE WHEN p_partkey % 13 = 0 THEN ' ' ELSE CAST(p_size AS VARCHAR) END AS product_weight_g,
         CAST(NULL AS VARCHAR) AS product_length_cm,
         CAST(NULL AS VARCHAR) AS product_height_cm,
         CAST(NULL AS VARCHAR) AS product_width_cm
  FROM part
)"""

_STAGED = (_STG_ORDERS, _STG_ITEMS, _STG_CUSTOMERS, _STG_PRODUCTS)
_RAW = (_STG_ORDERS, _STG_RAW_ITEMS, _STG_CUSTOMERS, _STG_PRODUCTS)


def _gapped(ctes: tuple[str, ...]) -> tuple[str, ...]:
    """The feeds with every 50th customer and every 40th product under another id."""
    orders, items, customers, products = ctes

    def renamed(table: str, column: str, every: int) -> str:
        return (
            f"{table} AS (SELECT * REPLACE (CASE WHEN CAST({column} AS BIGINT) % {every} = 0"
            f" THEN 'other-' || {column} ELSE {column} END AS {column}) FROM all_{table})"
        )

    return (
        orders,
        items,
        customers.replace("stg_customers AS", "all_stg_customers AS"),
        products.replace("stg_products AS", "all_stg_products AS"),
        renamed("stg_customers", "customer_id", 50),
        renamed("stg_products", "product_id", 40),
    )


def _title(text: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all(lower({text}), "
        r"'[\p{L}\p{N}]+|[^\p{L}\p{N}]+'), "
        "lambda t: CASE WHEN t[1] = 'ß' THEN t ELSE upper(t[1]) || t[2:] END), '')"
    )


_DIM_CUSTOMERS = f"""
dim_customers AS (
  SELECT row_number() OVER (ORDER BY customer_id) AS customer_key,
         customer_id, customer_unique_id,
         customer_zip_code_prefix AS zip_code_prefix,
         {_title("trim(customer_city)")} AS city,
         upper(trim(customer_state)) AS state
  FROM stg_customers WHERE customer_id IS NOT NULL
)"""


def _measure(column: str) -> str:
    return f"CAST(NULLIF(trim({column}), '') AS DECIMAL(38,18))"


_DIM_PRODUCTS = f"""
dim_products AS (
  SELECT row_number() OVER (ORDER BY product_id) AS product_key,
         product_id,
         {_title("replace(trim(product_category_name), '_', ' ')")} AS category_name,
         CAST(NULL AS VARCHAR) AS category_name_en,
         {_measure("product_weight_g")} AS weight_g,
         {_measure("product_length_cm")} AS length_cm,
         {_measure("product_height_cm")} AS height_cm,
         {_measure("product_width_cm")} AS width_cm
  FROM stg_products WHERE product_id IS NOT NULL
)"""

_DIM_TIME = """
dim_time AS (
  SELECT row_number() OVER (ORDER BY d) AS time_key,
         d AS full_date,
         CAST(extract(year FROM d) AS SMALLINT) AS year,
         CAST(extract(quarter FROM d) AS SMALLINT) AS quarter,
         CAST(extract(month FROM d) AS SMALLINT) AS month,
         rpad(monthname(d), 9, ' ') AS month_name,
         CAST(extract(week FROM d) AS SMALLINT) AS week_of_year,
         CAST(extract(day FROM d) AS SMALLINT) AS day_of_month,
         CAST(extract(isodow FROM d) AS SMALLINT) AS day_of_week,
         rpad(dayname(d), 9, ' ') AS day_name,
         extract(isodow FROM d) IN (6, 7) AS is_weekend
  FROM (SELECT DISTINCT CAST(CAST(order_purchase_timestamp AS TIMESTAMP) AS DATE) AS d
        FROM stg_orders WHERE order_purchase_timestamp IS NOT NULL)
)"""


def _money(column: str) -> str:
    return f"CAST(NULLIF(trim({column}), '') AS DECIMAL(10,2))"


_DAYS = """CASE WHEN order_delivered_customer_date IS NOT NULL
              AND order_purchase_timestamp IS NOT NULL
              THEN CAST(date_sub('day', CAST(order_purchase_timestamp AS TIMESTAMP),
                   CAST(order_delivered_customer_date AS TIMESTAMP)) AS INTEGER) END"""

_FACT = f"""
fact AS (
  SELECT i.order_id,
         CAST(i.order_item_id AS INTEGER) AS order_item_id,
         customer_key, product_key, time_key,
         {_money("price")} AS price,
         {_money("freight_value")} AS freight_value,
         CAST({_money("price")} + {_money("freight_value")} AS DECIMAL(10,2)) AS total_revenue,
         order_status,
         CAST(order_purchase_timestamp AS TIMESTAMP) AS purchase_timestamp,
         CAST(order_delivered_customer_date AS TIMESTAMP) AS delivery_timestamp,
         CAST(CAST(CAST(order_estimated_delivery_date AS TIMESTAMP) AS DATE) AS TIMESTAMP)
           AS estimated_delivery_date,
         {_DAYS} AS delivery_days
  FROM stg_order_items i
  JOIN stg_orders o ON i.order_id = o.order_id
  JOIN dim_products p ON i.product_id = p.product_id
  JOIN dim_customers c ON o.customer_id = c.customer_id
  JOIN dim_time t ON CAST(CAST(order_purchase_timestamp AS TIMESTAMP) AS DATE) = t.full_date
  WHERE i.order_id IS NOT NULL AND i.product_id IS NOT NULL
)"""

_DIMS = (_DIM_CUSTOMERS, _DIM_PRODUCTS, _DIM_TIME)


def _with(ctes: tuple[str, ...], body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


_FACT_ORDERS = "SELECT row_number() OVER (ORDER BY order_id, order_item_id) AS order_item_key, * FROM fact"

_REVENUE = """
SELECT t.year AS year, t.month AS month, p.category_name AS category_name,
       count(*) AS item_count,
       CAST(sum(f.total_revenue) AS DECIMAL(38,2)) AS revenue,
       CAST(sum(f.delivery_days) AS DOUBLE) / NULLIF(count(f.delivery_days), 0)
         AS avg_delivery_days
FROM fact f JOIN dim_time t ON f.time_key = t.time_key
JOIN dim_products p ON f.product_key = p.product_key
GROUP BY t.year, t.month, p.category_name"""

_SURROGATE_KEYS = _union(
    [
        f"SELECT '{table}' AS table_name, CAST({natural} AS VARCHAR) AS natural_key,"
        f" {key} AS surrogate_key FROM {table}"
        for table, natural, key in (
            ("dim_customers", "customer_id", "customer_key"),
            ("dim_products", "product_id", "product_key"),
            ("dim_time", "full_date", "time_key"),
        )
    ]
)

_JOIN_TIME = f"""
WITH {_STG_ORDERS.replace("stg_orders AS", "all_orders AS")},
stg_orders AS (
  SELECT order_id, CASE WHEN CAST(order_id AS BIGINT) % 5 <> 0 THEN order_purchase_timestamp END
    AS order_purchase_timestamp
  FROM all_orders
),{_DIM_TIME}
SELECT order_id, full_date, time_key
FROM stg_orders JOIN dim_time
  ON CAST(CAST(order_purchase_timestamp AS TIMESTAMP) AS DATE) = full_date"""

_LOSS_JOINS = (
    ("items", ""),
    ("orders", " JOIN stg_orders o ON i.order_id = o.order_id"),
    ("products", " JOIN dim_products p ON i.product_id = p.product_id"),
    ("customers", " JOIN dim_customers c ON o.customer_id = c.customer_id"),
    (
        "time",
        " JOIN dim_time t"
        " ON CAST(CAST(order_purchase_timestamp AS TIMESTAMP) AS DATE) = t.full_date",
    ),
)


def _join_losses() -> str:
    parts, joins = [], ""
    for step, join in _LOSS_JOINS:
        joins += join
        parts.append(
            f"SELECT '{step}' AS step, count(*) AS kept_rows FROM stg_order_items i{joins}"
        )
    return _union(parts)


_FN_TRIM_NULLIF = f"""
SELECT order_id, order_item_id, product_id,
       NULLIF(trim(price), '') AS price_text,
       {_money("price")} AS price,
       CAST({_money("price")} + {_money("freight_value")} AS DECIMAL(10,2)) AS total_revenue
FROM stg_order_items"""

_FN_INITCAP = f"""
SELECT 'customer' AS kind, customer_id AS id, {_title("trim(customer_city)")} AS title
FROM stg_customers
UNION ALL
SELECT 'document' AS kind, CAST(doc_id AS VARCHAR) AS id, {_title("text")} AS title
FROM documents"""

_FN_DATES = """
SELECT order_id, purchase_timestamp, estimated_delivery_date, d AS full_date,
       CAST(extract(week FROM d) AS INTEGER) AS week_of_year,
       CAST(extract(isodow FROM d) AS INTEGER) AS day_of_week,
       rpad(monthname(d), 9, ' ') AS month_name,
       rpad(dayname(d), 9, ' ') AS day_name
FROM (
  SELECT order_id,
         CAST(order_purchase_timestamp AS TIMESTAMP) AS purchase_timestamp,
         CAST(CAST(CAST(order_estimated_delivery_date AS TIMESTAMP) AS DATE) AS TIMESTAMP)
           AS estimated_delivery_date,
         CAST(CAST(order_purchase_timestamp AS TIMESTAMP) AS DATE) AS d
  FROM stg_orders
)"""

_FILTER_NOT_NULL = """
SELECT 'stg_orders' AS table_name,
       count(*) FILTER (WHERE CAST(order_id AS BIGINT) % 31 <> 0) AS kept_rows,
       count(*) FILTER (WHERE CAST(order_id AS BIGINT) % 31 = 0) AS dropped_rows
FROM stg_orders
UNION ALL
SELECT 'stg_order_items',
       count(*) FILTER (WHERE CAST(order_id AS BIGINT) % 53 <> 0
                          AND CAST(product_id AS BIGINT) % 47 <> 0),
       count(*) FILTER (WHERE CAST(order_id AS BIGINT) % 53 = 0
                           OR CAST(product_id AS BIGINT) % 47 = 0)
FROM stg_order_items
UNION ALL
SELECT 'stg_customers',
       count(*) FILTER (WHERE CAST(customer_id AS BIGINT) % 50 <> 0),
       count(*) FILTER (WHERE CAST(customer_id AS BIGINT) % 50 = 0)
FROM stg_customers
UNION ALL
SELECT 'stg_products',
       count(*) FILTER (WHERE CAST(product_id AS BIGINT) % 40 <> 0),
       count(*) FILTER (WHERE CAST(product_id AS BIGINT) % 40 = 0)
FROM stg_products"""

# The declared feeds, stated here anew so that an error in the engine's own declaration shows.
_FEEDS = {
    "stg_orders": {
        "columns": "order_id customer_id order_status order_purchase_timestamp order_approved_at"
        " order_delivered_carrier_date order_delivered_customer_date order_estimated_delivery_date",
        "required": "order_id customer_id order_status order_purchase_timestamp",
        "key": "order_id",
    },
    "stg_order_items": {
        "columns": "order_id order_item_id product_id seller_id shipping_limit_date price freight_value",
        "required": "order_id order_item_id product_id price",
        "key": "order_id order_item_id",
    },
    "stg_customers": {
        "columns": "customer_id customer_unique_id customer_zip_code_prefix customer_city customer_state",
        "required": "customer_id customer_unique_id",
        "key": "customer_id",
    },
    "stg_products": {
        "columns": "product_id product_category_name product_name_lenght product_description_lenght"
        " product_photos_qty product_weight_g product_length_cm product_height_cm product_width_cm",
        "required": "product_id",
        "key": "product_id",
    },
}

_ROW_COUNTS = _union(
    [f"SELECT '{table}' AS table_name, count(*) AS row_count FROM {table}" for table in _FEEDS]
)

_NULLS = _union(
    [
        f"SELECT '{table}' AS table_name, '{c}' AS column_name,"
        f" count(*) FILTER (WHERE {c} IS NULL) AS null_rows FROM {table}"
        for table, feed in _FEEDS.items()
        for c in feed["columns"].split()
    ]
)


def _duplicates(table: str, key: tuple[str, ...]) -> str:
    listed = ", ".join(key)
    return (
        f"SELECT {listed}, count(*) AS cnt FROM {table} GROUP BY {listed} HAVING count(*) > 1"
    )


_ITEM_DUPLICATES = _duplicates("stg_order_items", ("order_id", "order_item_id"))


def _report_rows(table: str, feed: dict[str, str], position: int) -> list[str]:
    key = feed["key"].split()
    checks = [("row_count", "CAST(NULL AS VARCHAR)", "count(*)", "count(*) > 0", table)]
    for c in feed["required"].split():
        bad = f"count(*) FILTER (WHERE {c} IS NULL)"
        checks.append(("not_null", f"'{c}'", bad, f"{bad} = 0", table))
    groups = f"({_duplicates(table, tuple(key))})"
    checks.append(("unique", f"'{', '.join(key)}'", "count(*)", "count(*) = 0", groups))
    return [
        f"SELECT {position + i} AS position, 'staging.{table}' AS table_name, '{check}' AS check_name,"
        f" {column} AS column_name, {measured} AS measured, {passed} AS passed FROM {source}"
        for i, (check, column, measured, passed, source) in enumerate(checks)
    ]


def _report() -> str:
    parts: list[str] = []
    for table, feed in _FEEDS.items():
        parts += _report_rows(table, feed, len(parts))
    return _union(parts)


def _constraints() -> str:
    not_null = {
        "dim_customers": ("customer_id",),
        "dim_products": ("product_id",),
        "dim_time": (
            "full_date",
            "year",
            "quarter",
            "month",
            "month_name",
            "week_of_year",
            "day_of_month",
            "day_of_week",
            "day_name",
            "is_weekend",
        ),
        "fact_orders": ("order_id", "order_item_id"),
    }
    unique = {
        "dim_customers": ("customer_id",),
        "dim_products": ("product_id",),
        "dim_time": ("full_date",),
        "fact_orders": ("order_id", "order_item_id"),
    }
    references = {
        "customer_key": "dim_customers",
        "product_key": "dim_products",
        "time_key": "dim_time",
    }

    def rule(table: str, name: str, body: str) -> str:
        return f"SELECT '{table}' AS table_name, '{name}' AS rule, count(*) AS bad_rows FROM {body}"

    def stored(table: str) -> str:
        return "fact" if table == "fact_orders" else table

    parts = [
        rule(table, f"not_null({c})", f"{stored(table)} WHERE {c} IS NULL")
        for table, columns in not_null.items()
        for c in columns
    ]
    parts.append(rule("dim_customers", "max_length(state)", "dim_customers WHERE length(state) > 2"))
    parts += [
        rule(table, f"unique({', '.join(key)})", f"({_duplicates(stored(table), key)})")
        for table, key in unique.items()
    ]
    keys = {
        "dim_customers": "customer_key",
        "dim_products": "product_key",
        "dim_time": "time_key",
    }
    parts += [
        rule(table, f"primary_key({key})", f"({_duplicates(table, (key,))})") for table, key in keys.items()
    ]
    numbered = "(SELECT row_number() OVER (ORDER BY order_id, order_item_id) AS key FROM fact) f"
    parts.append(
        rule("fact_orders", "primary_key(order_item_key)", f"({_duplicates(numbered, ('key',))})")
    )
    parts += [
        rule(
            "fact_orders",
            f"references({key})",
            f"fact WHERE {key} IS NOT NULL AND {key} NOT IN (SELECT {key} FROM {table})",
        )
        for key, table in references.items()
    ]
    return _union(parts)


def _orphans() -> str:
    links = (
        ("stg_order_items", "order_id", "stg_orders"),
        ("stg_order_items", "product_id", "stg_products"),
        ("stg_orders", "customer_id", "stg_customers"),
    )
    return _union(
        [
            f"SELECT '{child}.{column} in {parent}' AS rule, count(*) AS orphan_rows,"
            f" count(DISTINCT {column}) AS orphan_values FROM {child}"
            f" WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {column} FROM {parent})"
            for child, column, parent in links
        ]
    )


_MARKED_CUSTOMERS = """
SELECT customer_id, customer_unique_id, customer_zip_code_prefix,
       CASE WHEN CAST(customer_id AS BIGINT) % 3 = 0 THEN customer_city END AS customer_city,
       customer_state
FROM stg_customers"""

def _load_row_counts() -> str:
    """Rows by stage and table: what is staged, checked, and built."""
    staged, built = list(_FEEDS), ["dim_customers", "dim_products", "dim_time", "fact"]
    names = {"ingest": staged, "validate": staged, "transform": built}
    return " UNION ALL ".join(
        f"SELECT 1::BIGINT AS load, '{stage}' AS stage, '{'fact_orders' if t == 'fact' else t}' AS table_name,"
        f" count(*) AS row_count FROM {t}"
        for stage, tables in names.items()
        for t in tables
    )


ORACLE_SQL: dict[str, str] = {
    "revenue_by_month_category": _with((*_STAGED, *_DIMS, _FACT), _REVENUE),
    "dim_customers": _with((_STG_CUSTOMERS, _DIM_CUSTOMERS), "SELECT * FROM dim_customers"),
    "dim_products": _with((_STG_PRODUCTS, _DIM_PRODUCTS), "SELECT * FROM dim_products"),
    "dim_time": _with((_STG_ORDERS, _DIM_TIME), "SELECT * FROM dim_time"),
    "fact_orders": _with((*_STAGED, *_DIMS, _FACT), _FACT_ORDERS),
    "fact_orders_with_gaps": _with((*_gapped(_STAGED), *_DIMS, _FACT), _FACT_ORDERS),
    "surrogate_keys": _with((_STG_ORDERS, _STG_CUSTOMERS, _STG_PRODUCTS, *_DIMS), _SURROGATE_KEYS),
    "join_items_orders": _with(
        (_STG_ORDERS, _STG_ITEMS),
        "SELECT i.order_id, order_item_id, product_id, customer_id, order_status"
        " FROM stg_order_items i JOIN stg_orders o ON i.order_id = o.order_id",
    ),
    "join_products": _with(
        (*_gapped(_STAGED), _DIM_PRODUCTS),
        "SELECT order_id, order_item_id, product_key"
        " FROM stg_order_items i JOIN dim_products p ON i.product_id = p.product_id",
    ),
    "join_customers": _with(
        (*_gapped(_RAW), _DIM_CUSTOMERS),
        "SELECT o.customer_id, order_id, customer_key"
        " FROM stg_orders o JOIN dim_customers c ON o.customer_id = c.customer_id",
    ),
    "join_time": _JOIN_TIME,
    "join_losses": _with((*_gapped(_RAW), *_DIMS), _join_losses()),
    "fn_trim_nullif": _with((_STG_RAW_ITEMS,), _FN_TRIM_NULLIF),
    "fn_initcap": _with((_STG_CUSTOMERS,), _FN_INITCAP),
    "fn_dates": _with((_STG_ORDERS,), _FN_DATES),
    "delivery_days": _with(
        (_STG_ORDERS,), f"SELECT order_id, {_DAYS} AS delivery_days FROM stg_orders"
    ),
    "filter_not_null": _with(_RAW, _FILTER_NOT_NULL),
    "dq_row_count": _with(_RAW, _ROW_COUNTS),
    "dq_nulls": _with(_RAW, _NULLS),
    "dq_duplicates": _with((_STG_RAW_ITEMS,), _ITEM_DUPLICATES),
    "dq_duplicates_top": _with((_STG_RAW_ITEMS,), f"{_ITEM_DUPLICATES} ORDER BY cnt DESC"),
    "dq_report": _with(_RAW, _report()),
    "constraint_report": _with((*_RAW, *_DIMS, _FACT), _constraints()),
    "fk_orphans": _with(_gapped(_RAW), _orphans()),
    "csv_scan": "SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, text FROM documents",
    "csv_missing_markers": _with((_STG_CUSTOMERS,), _MARKED_CUSTOMERS),
    "csv_line_ends": _with((_STG_CUSTOMERS,), "SELECT * FROM stg_customers"),
    "stage_project": _with((_STG_CUSTOMERS,), "SELECT * FROM stg_customers"),
    "stage_row_counts": _with(_RAW, _ROW_COUNTS),
    "stage_orders": _with((_STG_ORDERS,), "SELECT * FROM stg_orders"),
    "stage_order_items": _with((_STG_RAW_ITEMS,), "SELECT * FROM stg_order_items"),
    "stage_customers": _with((_STG_CUSTOMERS,), "SELECT * FROM stg_customers"),
    "stage_products": _with((_STG_PRODUCTS,), "SELECT * FROM stg_products"),
    "full_load": _with((*_STAGED, *_DIMS, _FACT), _FACT_ORDERS),
    "load_row_counts": _with((*_gapped(_STAGED), *_DIMS, _FACT), _load_row_counts()),
    "reload_dim_customers": _with(
        (_STG_CUSTOMERS, _DIM_CUSTOMERS), "SELECT * FROM dim_customers"
    ),
}
