"""Independent DuckDB SQL restatement of the fixture, staging and marts.

Used as the correctness oracle: every registered Spark query has a SQL twin
built from these CTEs over the driver's tables (``lineitem``, ``orders``,
``customer``, ``nation``, ``part``, ``supplier``, ``events`` views).

``with_ctes(sql, extra)`` prepends every CTE the query references, with
their dependencies, in dependency order. Faulty variants use the ``f_`` prefix.
"""

from __future__ import annotations

import re

SELECTED = "20260101T000000Z"
SECOND = "20260201T000000Z"
X = {  # extract instants per (batch, table family)
    (SELECTED, "sales"): "TIMESTAMP '2001-06-01 00:00:00'",
    (SELECTED, "events"): "TIMESTAMP '2024-01-29 00:00:00'",
    (SECOND, "sales"): "TIMESTAMP '2001-07-01 00:00:00'",
    (SECOND, "events"): "TIMESTAMP '2024-01-30 00:00:00'",
}
TABLE_KEYS = {"distribution_centers": "id", "events": "id", "inventory_items": "id",
              "order_items": "id", "orders": "order_id", "products": "id", "users": "id"}
TABLES = tuple(sorted(TABLE_KEYS))

SRC = {
    "lines": """
SELECT *, row_number() OVER (
    ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS item_id
FROM lineitem""",
    "src_order_items": """
SELECT item_id AS id, l_orderkey AS order_id, o.o_custkey AS user_id, l_partkey AS product_id,
       item_id AS inventory_item_id, st AS status, ship AS created_at,
       CASE WHEN st IN ('Shipped', 'Complete', 'Returned') THEN ship + INTERVAL 1 DAY END AS shipped_at,
       CASE WHEN st IN ('Complete', 'Returned') THEN ship + INTERVAL 3 DAY END AS delivered_at,
       CASE WHEN st = 'Returned' THEN ship + INTERVAL 10 DAY END AS returned_at,
       l_extendedprice AS sale_price
FROM (SELECT *, CAST(l_shipdate AS TIMESTAMP) AS ship,
             CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'Complete'
                  WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'Shipped'
                  WHEN l_returnflag = 'R' THEN 'Returned'
                  WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'Cancelled'
                  WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'Processing' END AS st
      FROM lines) l
LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey""",
    "src_orders": """
SELECT o_orderkey AS order_id, o_custkey AS user_id, st AS status,
       CASE WHEN o_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
       created AS created_at, CAST(NULL AS TIMESTAMP) AS returned_at,
       CASE WHEN st IN ('Complete', 'Shipped') THEN created + INTERVAL 2 DAY END AS shipped_at,
       CASE WHEN st = 'Complete' THEN created + INTERVAL 5 DAY END AS delivered_at,
       CAST(coalesce(n.n_items, 0) AS BIGINT) AS num_of_item
FROM (SELECT *, CAST(o_orderdate AS TIMESTAMP) + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS created,
             CASE o_orderstatus WHEN 'F' THEN 'Complete' WHEN 'O' THEN 'Shipped'
                                WHEN 'P' THEN 'Processing' END AS st
      FROM orders) o
LEFT JOIN (SELECT l_orderkey, count(*) AS n_items FROM lineitem GROUP BY l_orderkey) n
       ON n.l_orderkey = o.o_orderkey""",
    "src_inventory_items": """
SELECT item_id AS id, l_partkey AS product_id,
       CAST(l_shipdate AS TIMESTAMP) - INTERVAL 30 DAY AS created_at,
       CAST(l_shipdate AS TIMESTAMP) AS sold_at,
       l_extendedprice * (1.0 - l_discount) AS cost,
       p_type AS product_category, p_name AS product_name,
       CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE p_brand END AS product_brand,
       p_retailprice AS product_retail_price,
       CASE WHEN p_size % 2 = 0 THEN 'Women' ELSE 'Men' END AS product_department,
       'SKU-' || CAST(l_partkey AS VARCHAR) AS product_sku,
       l_suppkey AS product_distribution_center_id
FROM lines l LEFT JOIN part p ON p.p_partkey = l.l_partkey""",
    "src_products": """
SELECT p_partkey AS id, p_retailprice * 0.5 AS cost, p_type AS category, p_name AS name,
       CASE WHEN p_partkey % 97 = 0 THEN NULL ELSE p_brand END AS brand,
       p_retailprice AS retail_price,
       CASE WHEN p_size % 2 = 0 THEN 'Women' ELSE 'Men' END AS department,
       'SKU-' || CAST(p_partkey AS VARCHAR) AS sku,
       p_partkey % (SELECT count(*) FROM supplier) AS distribution_center_id
FROM part""",
    "src_users": """
SELECT c_custkey AS id, c_name AS first_name,
       'Family-' || CAST(c_custkey % 100 AS VARCHAR) AS last_name,
       'customer' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
       CAST(18 + c_custkey % 60 AS BIGINT) AS age,
       CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
       'State-' || CAST(c_nationkey % 5 AS VARCHAR) AS state,
       CAST(c_custkey AS VARCHAR) || ' Main Street' AS street_address,
       lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS postal_code,
       'City-' || CAST(c_nationkey AS VARCHAR) AS city,
       n.n_name AS country,
       CAST(c_nationkey AS DOUBLE) AS latitude,
       c_acctbal AS longitude,
       c_mktsegment AS traffic_source,
       TIMESTAMP '1994-01-01 00:00:00' + to_days(CAST(c_custkey * 37 % 3000 AS INTEGER)) AS created_at,
       'POINT(' || CAST(c_nationkey AS VARCHAR) || ' ' || CAST(c_custkey AS VARCHAR) || ')' AS user_geom
FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey""",
    "src_events": """
SELECT event_id AS id,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE user_id END AS user_id,
       event_id % 10 + 1 AS sequence_number,
       'session-' || CAST(event_id // 10 AS VARCHAR) AS session_id,
       CAST(ts AS TIMESTAMP) AS created_at,
       '10.0.' || CAST(event_id % 256 AS VARCHAR) || '.1' AS ip_address,
       'City-' || CAST(event_id % 25 AS VARCHAR) AS city,
       'State-' || CAST(event_id % 5 AS VARCHAR) AS state,
       lpad(CAST(event_id % 100000 AS VARCHAR), 5, '0') AS postal_code,
       CASE event_id % 4 WHEN 0 THEN 'Chrome' WHEN 1 THEN 'Firefox' WHEN 2 THEN 'Safari' ELSE 'Edge' END AS browser,
       CASE event_id % 3 WHEN 0 THEN 'Search' WHEN 1 THEN 'Email' ELSE 'Organic' END AS traffic_source,
       '/' || event_type AS uri,
       event_type AS event_type
FROM events""",
    "src_distribution_centers": """
SELECT s_suppkey AS id, s_name AS name, CAST(s_nationkey AS DOUBLE) AS latitude, s_acctbal AS longitude,
       'POINT(' || CAST(s_nationkey AS VARCHAR) || ' ' || CAST(s_suppkey AS VARCHAR) || ')' AS distribution_center_geom
FROM supplier""",
}

FAULTY_SRC = {
    "f_src_users": "SELECT * FROM src_users WHERE id % 7 <> 0",
    "f_src_distribution_centers": "SELECT * FROM src_distribution_centers WHERE id % 9 <> 4",
    "f_src_orders": """
SELECT * REPLACE (CASE WHEN order_id % 50 = 0 THEN NULL ELSE CAST(4 AS BIGINT) END AS num_of_item)
FROM src_orders
UNION ALL
SELECT * REPLACE (CASE WHEN order_id % 50 = 0 THEN NULL ELSE CAST(4 AS BIGINT) END AS num_of_item)
FROM src_orders WHERE order_id % 1000 = 1""",
    "f_src_order_items": """
SELECT * REPLACE (CASE WHEN id % 97 = 3 THEN 'Lost' ELSE status END AS status,
                  CASE WHEN order_id % 11 = 0 THEN user_id + 1 ELSE user_id END AS user_id,
                  CASE WHEN id % 211 = 0 THEN NULL ELSE product_id END AS product_id)
FROM src_order_items""",
    "f_src_events": "SELECT * REPLACE (CASE WHEN id % 997 = 0 THEN NULL ELSE id END AS id) FROM src_events",
    "f_src_inventory_items": "SELECT * FROM src_inventory_items",
    "f_src_products": "SELECT * FROM src_products",
}


def _raw(table: str, p: str) -> str:
    fam = "events" if table == "events" else "sales"
    src = f"{p}src_{table}"
    first = f"SELECT *, '{SELECTED}' AS _BATCH_ID, {X[(SELECTED, fam)]} AS _EXTRACTED_AT FROM {src}"
    if table == "events":
        return first
    key = TABLE_KEYS[table]
    return (first + f"\nUNION ALL\nSELECT *, '{SECOND}' AS _BATCH_ID, {X[(SECOND, fam)]} AS _EXTRACTED_AT "
            f"FROM {src} WHERE {key} % 3 <> 0")


STG = {
    "distribution_centers": """
SELECT CAST(id AS BIGINT) AS distribution_center_id, CAST(name AS VARCHAR) AS distribution_center_name,
       CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude,
       CAST(distribution_center_geom AS VARCHAR) AS distribution_center_geom,
       _BATCH_ID AS source_batch_id, _EXTRACTED_AT AS extracted_at""",
    "events": """
SELECT CAST(id AS BIGINT) AS event_id, CAST(user_id AS BIGINT) AS customer_id,
       CAST(sequence_number AS BIGINT) AS sequence_number, session_id AS session_id,
       created_at AS created_at, ip_address AS ip_address, city AS city, state AS state,
       postal_code AS postal_code, browser AS browser, traffic_source AS traffic_source, uri AS uri,
       event_type AS event_type, _BATCH_ID AS source_batch_id, _EXTRACTED_AT AS extracted_at,
       created_at > _EXTRACTED_AT AS is_created_after_extract""",
    "inventory_items": """
SELECT CAST(id AS BIGINT) AS inventory_item_id, CAST(product_id AS BIGINT) AS product_id,
       created_at AS created_at, sold_at AS sold_at, CAST(cost AS DOUBLE) AS cost,
       product_category AS product_category, product_name AS product_name, product_brand AS product_brand,
       CAST(product_retail_price AS DOUBLE) AS product_retail_price,
       product_department AS product_department, product_sku AS product_sku,
       CAST(product_distribution_center_id AS BIGINT) AS distribution_center_id,
       _BATCH_ID AS source_batch_id, _EXTRACTED_AT AS extracted_at,
       created_at > _EXTRACTED_AT AS is_created_after_extract""",
    "order_items": """
SELECT CAST(id AS BIGINT) AS order_item_id, CAST(order_id AS BIGINT) AS order_id,
       CAST(user_id AS BIGINT) AS customer_id, CAST(product_id AS BIGINT) AS product_id,
       CAST(inventory_item_id AS BIGINT) AS inventory_item_id, lower(status) AS order_item_status,
       created_at AS created_at, shipped_at AS shipped_at, delivered_at AS delivered_at,
       returned_at AS returned_at, CAST(sale_price AS DOUBLE) AS sale_price,
       _BATCH_ID AS source_batch_id, _EXTRACTED_AT AS extracted_at,
       created_at > _EXTRACTED_AT AS is_created_after_extract""",
    "orders": """
SELECT CAST(order_id AS BIGINT) AS order_id, CAST(user_id AS BIGINT) AS customer_id,
       lower(status) AS order_status, gender AS gender, created_at AS created_at,
       returned_at AS returned_at, shipped_at AS shipped_at, delivered_at AS delivered_at,
       CAST(num_of_item AS BIGINT) AS order_item_count,
       _BATCH_ID AS source_batch_id, _EXTRACTED_AT AS extracted_at,
       created_at > _EXTRACTED_AT AS is_created_after_extract""",
    "products": """
SELECT CAST(id AS BIGINT) AS product_id, CAST(cost AS DOUBLE) AS cost, category AS category,
       name AS product_name, brand AS brand, CAST(retail_price AS DOUBLE) AS retail_price,
       department AS department, sku AS sku, CAST(distribution_center_id AS BIGINT) AS distribution_center_id,
       _BATCH_ID AS source_batch_id, _EXTRACTED_AT AS extracted_at""",
    "users": """
SELECT CAST(id AS BIGINT) AS customer_id, first_name AS first_name, last_name AS last_name, email AS email,
       CAST(age AS BIGINT) AS age, gender AS gender, state AS state, street_address AS street_address,
       postal_code AS postal_code, city AS city, country AS country, CAST(latitude AS DOUBLE) AS latitude,
       CAST(longitude AS DOUBLE) AS longitude, traffic_source AS traffic_source, created_at AS created_at,
       user_geom AS user_geom, _BATCH_ID AS source_batch_id, _EXTRACTED_AT AS extracted_at,
       created_at > _EXTRACTED_AT AS is_created_after_extract""",
}

MART_TEMPLATES = {
    "dim_customers": """
SELECT customer_id, first_name, last_name, age, gender, city, state, country,
       traffic_source AS acquisition_channel, created_at AS registered_at, source_batch_id, extracted_at
FROM {p}stg_users""",
    "dim_products": """
SELECT product_id, product_name, brand, category, department, sku,
       CAST(retail_price AS DECIMAL(18,4)) AS current_retail_price,
       CAST(cost AS DECIMAL(18,4)) AS current_unit_cost,
       distribution_center_id, source_batch_id, extracted_at
FROM {p}stg_products""",
}

# The sales fact, straight from the driver's lines and orders: no RAW, no staging, no join to inventory. What a
# line counts for comes from a small table of statuses and weights.
STATUS_WEIGHTS = """
SELECT * FROM (VALUES ('N', 'F', 'complete', 1, 0, 0), ('N', 'O', 'shipped', 0, 0, 0), ('R', 'F', 'returned', 0, 0, 1),
                      ('R', 'O', 'returned', 0, 0, 1), ('A', 'F', 'cancelled', 0, 1, 0), ('A', 'O', 'processing', 0, 0, 0))
     w(flag, line, status, sold, cancelled, returned)"""
SOLD_LINES = f"""
SELECT n.item_id, n.l_orderkey AS order_id, n.l_partkey AS part, w.status, w.sold, w.cancelled, w.returned,
       CAST(n.l_extendedprice AS DECIMAL(18,4)) AS price,
       CAST(n.l_extendedprice * (1.0 - n.l_discount) AS DECIMAL(18,4)) AS cost,
       CAST(n.l_shipdate AS TIMESTAMP) AS ship,
       (SELECT any_value(o_custkey) FROM orders WHERE o_orderkey = n.l_orderkey) AS buyer,
       (SELECT any_value(CAST(o_orderdate AS DATE)) FROM orders WHERE o_orderkey = n.l_orderkey) AS day
FROM lines n, status_weights w WHERE w.flag = n.l_returnflag AND w.line = n.l_linestatus"""
# the planted faults, said once more on the lines themselves
FAULTY_LINES = """
SELECT s.* REPLACE (CASE WHEN item_id % 97 = 3 THEN 'lost' ELSE status END AS status,
                    CASE WHEN item_id % 97 = 3 THEN 0 ELSE sold END AS sold,
                    CASE WHEN item_id % 97 = 3 THEN 0 ELSE cancelled END AS cancelled,
                    CASE WHEN item_id % 97 = 3 THEN 0 ELSE returned END AS returned,
                    CASE WHEN order_id % 11 = 0 THEN buyer + 1 ELSE buyer END AS buyer,
                    CASE WHEN item_id % 211 = 0 THEN NULL ELSE part END AS part)
FROM sold_lines s, range(CASE WHEN s.order_id % 1000 = 1 THEN 2 ELSE 1 END)"""
FACT = """
SELECT item_id AS order_item_id, order_id, buyer AS customer_id, part AS product_id, item_id AS inventory_item_id,
       CAST(day AS TIMESTAMP) + to_hours(CAST(order_id % 24 AS INTEGER)) AS order_created_at, day AS order_date,
       ship AS item_created_at,
       CASE WHEN {dispatched} THEN ship + INTERVAL 1 DAY END AS shipped_at,
       CASE WHEN {arrived} THEN ship + INTERVAL 3 DAY END AS delivered_at,
       CASE WHEN {back} THEN ship + INTERVAL 10 DAY END AS returned_at,
       status AS order_item_status, CAST(1 AS BIGINT) AS item_quantity, price AS item_amount, cost AS unit_cost,
       CAST(price * sold AS DECIMAL(18,4)) AS completed_sales_amount,
       CAST(cost * sold AS DECIMAL(18,4)) AS completed_cost_amount,
       CAST((price - cost) * sold AS DECIMAL(18,4)) AS completed_gross_margin_amount,
       CAST(price * cancelled AS DECIMAL(18,4)) AS cancelled_item_amount,
       CAST(price * returned AS DECIMAL(18,4)) AS returned_item_amount,
       ship > {extracted} AS is_created_after_extract, '{batch}' AS source_batch_id, {extracted} AS extracted_at
FROM {lines}"""
# Daily figures in long form: one row per day and status, then per day; distinct counts from distinct pairs.
DAILY = """
WITH by_status AS (
        SELECT order_date, source_batch_id, order_item_status AS s, count(*) AS n, sum(item_amount) AS amount,
               sum(unit_cost) AS cost, sum(item_amount - unit_cost) AS margin,
               count(*) FILTER (WHERE is_created_after_extract) AS late
        FROM {fact} GROUP BY ALL),
     ids AS (
        SELECT order_date, source_batch_id, kind, count(*) AS n
        FROM (SELECT DISTINCT order_date, source_batch_id, 'order' AS kind, order_id AS id FROM {fact}
              UNION SELECT order_date, source_batch_id, 'customer', customer_id FROM {fact})
        WHERE id IS NOT NULL GROUP BY ALL),
     long AS (
        SELECT order_date, source_batch_id, s || '#' AS measure, n::DECIMAL(38,4) AS v FROM by_status
        UNION ALL SELECT order_date, source_batch_id, s || '$', amount FROM by_status
        UNION ALL SELECT order_date, source_batch_id, s || '-', cost FROM by_status
        UNION ALL SELECT order_date, source_batch_id, s || '+', margin FROM by_status
        UNION ALL SELECT order_date, source_batch_id, 'late', late FROM by_status
        UNION ALL SELECT order_date, source_batch_id, 'all#', n FROM by_status
        UNION ALL SELECT order_date, source_batch_id, 'all$', amount FROM by_status
        UNION ALL SELECT order_date, source_batch_id, kind, n FROM ids)
SELECT order_date, source_batch_id, {measures}
FROM long GROUP BY order_date, source_batch_id"""
_WHOLE = {"order_count": "order", "customer_count": "customer", "item_count": "all#", "completed_item_count": "complete#",
          "cancelled_item_count": "cancelled#", "returned_item_count": "returned#", "shipped_item_count": "shipped#",
          "processing_item_count": "processing#"}
_MONEY = {"ordered_item_amount": "all$", "completed_sales_amount": "complete$", "completed_cost_amount": "complete-",
          "completed_gross_margin_amount": "complete+", "cancelled_item_amount": "cancelled$",
          "returned_item_amount": "returned$"}


def daily(fact: str, margin: str = "DECIMAL(28,4)") -> str:
    """The daily figures of a fact relation; ``margin`` is the type of the gross margin column."""
    def total(key: str, kind: str) -> str:
        return f"CAST(coalesce(sum(v) FILTER (WHERE measure = '{key}'), 0) AS {kind})"

    columns = [f"{total(k, 'BIGINT')} AS {c}" for c, k in _WHOLE.items()]
    columns += [f"{total(k, margin if 'margin' in c else 'DECIMAL(28,4)')} AS {c}" for c, k in _MONEY.items()]
    return DAILY.format(fact=fact, measures=",\n       ".join([*columns, f"{total('late', 'BIGINT')} AS future_created_item_count"]))


def _fact(lines: str) -> str:
    # shipping times depend on the status a line was sent under, which the planted status fault does not touch
    sent = "(SELECT w.status FROM sold_lines w WHERE w.item_id = l.item_id)"
    return FACT.format(lines=f"{lines} l", batch=SELECTED, extracted=X[(SELECTED, "sales")],
                       dispatched=f"{sent} IN ('shipped', 'complete', 'returned')",
                       arrived=f"{sent} IN ('complete', 'returned')", back=f"{sent} = 'returned'")


def _library() -> dict[str, str]:
    lib = dict(SRC)
    lib.update(FAULTY_SRC)
    for p in ("", "f_"):
        for t in TABLES:
            lib[f"{p}raw_{t}"] = _raw(t, p)
            lib[f"{p}stg_{t}"] = STG[t] + f"\nFROM {p}raw_{t} WHERE _BATCH_ID = '{SELECTED}'"
        for name, tmpl in MART_TEMPLATES.items():
            lib[f"{p}{name}"] = tmpl.format(p=p)
        lib[f"{p}fct_order_items"] = _fact(f"{p}sold_lines")
        lib[f"{p}mart_daily_sales"] = daily(f"{p}fct_order_items")
    lib |= {"status_weights": STATUS_WEIGHTS, "sold_lines": SOLD_LINES, "f_sold_lines": FAULTY_LINES}
    return lib


LIBRARY = _library()
_WORD = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def with_ctes(sql: str, extra: dict[str, str] | None = None) -> str:
    """Prepend every library CTE that ``sql`` (transitively) references."""
    lib = {**LIBRARY, **(extra or {})}
    order: list[str] = []
    seen: set[str] = set()

    def visit(name: str) -> None:
        if name in seen:
            return
        seen.add(name)
        for d in [w for w in dict.fromkeys(_WORD.findall(lib[name])) if w in lib and w != name]:
            visit(d)
        order.append(name)

    for w in dict.fromkeys(_WORD.findall(sql)):
        if w in lib:
            visit(w)
    body = sql.strip()
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS ({lib[n].strip()})" for n in order)
    if body[:5].upper() == "WITH ":  # the query's own CTEs follow the library's
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"

# RAW column order per table (source columns upper-cased, then lineage).
RAW_COLUMNS = {
    "distribution_centers": ["ID", "NAME", "LATITUDE", "LONGITUDE", "DISTRIBUTION_CENTER_GEOM"],
    "events": ["ID", "USER_ID", "SEQUENCE_NUMBER", "SESSION_ID", "CREATED_AT", "IP_ADDRESS", "CITY", "STATE",
               "POSTAL_CODE", "BROWSER", "TRAFFIC_SOURCE", "URI", "EVENT_TYPE"],
    "inventory_items": ["ID", "PRODUCT_ID", "CREATED_AT", "SOLD_AT", "COST", "PRODUCT_CATEGORY", "PRODUCT_NAME",
                        "PRODUCT_BRAND", "PRODUCT_RETAIL_PRICE", "PRODUCT_DEPARTMENT", "PRODUCT_SKU",
                        "PRODUCT_DISTRIBUTION_CENTER_ID"],
    "order_items": ["ID", "ORDER_ID", "USER_ID", "PRODUCT_ID", "INVENTORY_ITEM_ID", "STATUS", "CREATED_AT",
                    "SHIPPED_AT", "DELIVERED_AT", "RETURNED_AT", "SALE_PRICE"],
    "orders": ["ORDER_ID", "USER_ID", "STATUS", "GENDER", "CREATED_AT", "RETURNED_AT", "SHIPPED_AT",
               "DELIVERED_AT", "NUM_OF_ITEM"],
    "products": ["ID", "COST", "CATEGORY", "NAME", "BRAND", "RETAIL_PRICE", "DEPARTMENT", "SKU",
                 "DISTRIBUTION_CENTER_ID"],
    "users": ["ID", "FIRST_NAME", "LAST_NAME", "EMAIL", "AGE", "GENDER", "STATE", "STREET_ADDRESS", "POSTAL_CODE",
              "CITY", "COUNTRY", "LATITUDE", "LONGITUDE", "TRAFFIC_SOURCE", "CREATED_AT", "USER_GEOM"],
}
RAW_COLUMNS = {t: cols + ["_BATCH_ID", "_EXTRACTED_AT"] for t, cols in RAW_COLUMNS.items()}
RAW_TEMPORAL = {
    "distribution_centers": ["_EXTRACTED_AT"],
    "events": ["CREATED_AT", "_EXTRACTED_AT"],
    "inventory_items": ["CREATED_AT", "SOLD_AT", "_EXTRACTED_AT"],
    "order_items": ["CREATED_AT", "SHIPPED_AT", "DELIVERED_AT", "RETURNED_AT", "_EXTRACTED_AT"],
    "orders": ["CREATED_AT", "RETURNED_AT", "SHIPPED_AT", "DELIVERED_AT", "_EXTRACTED_AT"],
    "products": ["_EXTRACTED_AT"],
    "users": ["CREATED_AT", "_EXTRACTED_AT"],
}
