"""The same queries as plain SQL over the test tables, to check the results."""

from __future__ import annotations

SALES = """(
    SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_no,
           o.o_custkey AS customer_id, l.l_partkey AS product_id,
           o.o_orderdate AS order_date, l.l_extendedprice AS amount
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

# the batch load's orders, whose priority class stands in for a product
BATCH_SALES = """(
    SELECT o_orderkey AS order_id, o_custkey AS customer_id,
           CAST(substring(o_orderpriority, 1, 1) AS BIGINT) AS product_id,
           CAST(o_orderdate AS DATE) AS order_date, o_totalprice AS amount
    FROM orders)"""

REGIONS = """(
    SELECT n_nationkey AS region_id, r_name AS region_name, n_name AS country
    FROM nation LEFT JOIN region ON n_regionkey = r_regionkey)"""

STAR = f"""{SALES} s
    LEFT JOIN customer ON s.customer_id = c_custkey
    LEFT JOIN {REGIONS} r ON c_nationkey = r.region_id"""

TOP_CUSTOMERS = f"""
    SELECT customer_id, c_name AS customer_name, region_name,
           round(sum(amount), 2) AS total_spend, count(order_id) AS order_count
    FROM {STAR}
    GROUP BY ALL ORDER BY total_spend DESC, customer_id LIMIT 100"""

MONTHLY = f"""
    SELECT CAST(year(order_date) AS INT) AS year,
           CAST(month(order_date) AS INT) AS month,
           round(sum(amount), 2) AS total_revenue,
           count(order_id) AS total_orders,
           round(avg(amount), 2) AS avg_order_value
    FROM {SALES} s GROUP BY 1, 2"""

VERSIONS = """
    SELECT user_id, event_type, ts AS start_at,
           lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS end_at
    FROM events"""

KNOWN = "c_acctbal >= 0"

ORACLE = {
    "bronze_ingest": "SELECT * FROM orders",
    "bronze_ingest_in_steps": "SELECT * FROM orders",
    "bronze_ingest_many_files": "SELECT * FROM orders",
    "bronze_full_refresh": "SELECT * FROM customer",
    "schema_drift_rescued": """
        SELECT p_partkey, p_name,
               CASE WHEN p_size > 25 THEN
                   '{"p_brand":"' || p_brand || '","p_size":' || p_size || '}'
               END AS _rescued_data
        FROM part""",
    "batch_copy": "SELECT * FROM customer",
    "overwrite_table": "SELECT * EXCLUDE (p_size) FROM part",
    "csv_export": MONTHLY,
    "row_count": "SELECT count(*) AS row_count FROM lineitem",
    "project_drop_rename": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               o_totalprice AS total_amount
        FROM orders""",
    "split_domain": "SELECT page_id, split_part(url, '/', 3) AS domains FROM pages",
    "domain_counts": """
        SELECT split_part(url, '/', 3) AS domains, count(page_id) AS total_customers
        FROM pages GROUP BY 1""",
    "filter_equals": """
        SELECT c_custkey AS customer_id,
               c_name || '@' || lower(c_mktsegment) || '.com' AS email,
               c_acctbal AS balance, lower(c_mktsegment) || '.com' AS domains,
               'Building ' || c_name AS full_name
        FROM customer WHERE c_mktsegment = 'BUILDING'""",
    "concat_full_name": """
        SELECT c_custkey, c_name || ' ' || c_mktsegment AS full_name FROM customer""",
    "cast_date_year": """
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
               CAST(year(o_orderdate) AS INT) AS year
        FROM orders""",
    "parse_timestamp": """
        SELECT o_orderkey,
               CAST(CAST(o_orderdate AS STRING) AS TIMESTAMP) AS order_date
        FROM orders""",
    "filter_year_amount": f"""
        SELECT * FROM {SALES} s WHERE year(order_date) = 1997 AND amount > 10000""",
    "drop_null_keys": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               o_totalprice AS amount, CAST(o_orderdate AS DATE) AS order_date
        FROM orders
        WHERE o_orderkey IS NOT NULL AND o_custkey IS NOT NULL
          AND o_orderstatus <> 'P' AND o_totalprice > 0""",
    "fill_nulls": """
        SELECT p_partkey AS product_id,
               coalesce(CASE WHEN p_type <> 'PROMO' THEN p_type END, 'Uncategorized')
                   AS category
        FROM part""",
    "trim_name": """
        SELECT c_custkey AS customer_id, trim('  ' || c_name || ' ') AS customer_name
        FROM customer""",
    "sql_udf_discount": """
        SELECT p_partkey AS product_id, p_retailprice AS price,
               round(p_retailprice * CAST(0.9 AS DOUBLE), 4) AS discounted_price
        FROM part""",
    "py_udf_upper": """
        SELECT p_partkey AS product_id, p_brand AS brand, upper(p_brand) AS brand_upper
        FROM part""",
    "sql_udtf_orders_by_year": """
        SELECT o_orderkey AS order_id, CAST(year(o_orderdate) AS INT) AS year
        FROM orders WHERE year(o_orderdate) = 1997""",
    "union_split_dedup": """
        SELECT DISTINCT * FROM (
            SELECT * FROM customer WHERE c_acctbal >= 0
            UNION ALL SELECT * FROM customer WHERE c_acctbal < 5000) u""",
    "dedup_keep_first": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
                   l_shipdate,
                   row_number() OVER (
                       PARTITION BY l_orderkey, l_linenumber
                       ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice
                   ) AS rn
            FROM lineitem) t
        WHERE rn = 1""",
    "left_join_unmatched": f"""
        SELECT o_orderkey, o_custkey, d.dim_key
        FROM orders LEFT JOIN (
            SELECT c_custkey AS dim_id, c_custkey + 1 AS dim_key
            FROM customer WHERE {KNOWN}) d ON o_custkey = d.dim_id""",
    "split_new_old": f"""
        SELECT c_custkey, CASE WHEN {KNOWN} THEN 'old' ELSE 'new' END AS side
        FROM customer""",
    "enriched_master_join": f"""
        SELECT order_id, line_no, amount, c_name AS customer_name,
               p_type AS category, country, region_name
        FROM {STAR} LEFT JOIN part ON product_id = p_partkey""",
    "orders_with_region": f"""
        SELECT order_id, c_name AS customer_name, region_name, country, amount,
               order_date
        FROM {STAR}""",
    "kpi_monthly_revenue": MONTHLY,
    "kpi_category_revenue": f"""
        SELECT p_type AS category, round(sum(amount), 2) AS revenue,
               count(order_id) AS total_orders
        FROM {SALES} s LEFT JOIN part ON product_id = p_partkey GROUP BY 1""",
    "kpi_region_revenue": f"""
        SELECT region_name, country, round(sum(amount), 2) AS revenue,
               count(order_id) AS total_orders,
               round(avg(amount), 2) AS avg_order_value
        FROM {STAR} GROUP BY 1, 2""",
    "kpi_top_customers": TOP_CUSTOMERS,
    "sql_region_category": f"""
        SELECT region_name, p_type AS category, count(order_id) AS total_orders,
               round(sum(amount), 2) AS revenue,
               round(avg(amount), 2) AS avg_order_value
        FROM {STAR} LEFT JOIN part ON product_id = p_partkey
        GROUP BY 1, 2 ORDER BY revenue DESC, region_name, category LIMIT 50""",
    "rank_family": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity,
               CAST(year(l_shipdate) AS INT) AS year,
               dense_rank() OVER w AS flag, rank() OVER w AS rank_flag
        FROM lineitem
        WINDOW w AS (PARTITION BY year(l_shipdate) ORDER BY l_quantity DESC)""",
    "row_number_by_year": """
        SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, o_totalprice,
               row_number() OVER (
                   PARTITION BY year(o_orderdate)
                   ORDER BY o_totalprice DESC, o_orderkey) AS row_flag
        FROM orders""",
    "rank_in_region_top5": f"""
        SELECT * FROM (
            SELECT t.*, CAST(dense_rank() OVER (
                PARTITION BY region_name ORDER BY total_spend DESC) AS INT)
                AS rank_in_region
            FROM ({TOP_CUSTOMERS}) t) z
        WHERE rank_in_region <= 5""",
    "top_k_orders": """
        SELECT o_orderkey, o_totalprice FROM orders
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
    "surrogate_key": """
        SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS dim_customer_key
        FROM customer""",
    "surrogate_key_incremental": f"""
        WITH old AS (
            SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS k
            FROM customer WHERE {KNOWN})
        SELECT c_custkey, k AS dim_customer_key FROM old
        UNION ALL
        SELECT c_custkey, (SELECT coalesce(max(k), 0) FROM old)
               + row_number() OVER (ORDER BY c_custkey)
        FROM customer WHERE NOT ({KNOWN})""",
    "scd1_dim_customer": """
        WITH old AS (
            SELECT c_custkey, c_mktsegment,
                   row_number() OVER (ORDER BY c_custkey) AS k
            FROM customer WHERE c_acctbal >= 0),
        src AS (
            SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING'
                   THEN 'CONSTRUCTION' ELSE c_mktsegment END AS c_mktsegment
            FROM customer WHERE c_acctbal < 8000)
        SELECT o.c_custkey AS customer_id,
               coalesce(s.c_mktsegment, o.c_mktsegment) AS c_mktsegment,
               TIMESTAMP '2024-01-01 00:00:00' AS create_date,
               CASE WHEN s.c_mktsegment <> o.c_mktsegment
                    THEN TIMESTAMP '2024-01-02 00:00:00'
                    ELSE TIMESTAMP '2024-01-01 00:00:00' END AS update_date,
               o.k AS "DimCustomerKey"
        FROM old o LEFT JOIN src s ON o.c_custkey = s.c_custkey
        UNION ALL
        SELECT s.c_custkey, s.c_mktsegment, TIMESTAMP '2024-01-02 00:00:00',
               TIMESTAMP '2024-01-02 00:00:00',
               (SELECT coalesce(max(k), 0) FROM old)
               + row_number() OVER (ORDER BY s.c_custkey)
        FROM src s LEFT JOIN old o ON s.c_custkey = o.c_custkey
        WHERE o.c_custkey IS NULL""",
    "fact_upsert": """
        SELECT o_orderkey, o_custkey,
               CASE WHEN o_orderdate >= DATE '1998-01-01'
                    THEN round(o_totalprice + 1, 2) ELSE o_totalprice END
                   AS o_totalprice,
               o_orderdate
        FROM orders""",
    "create_or_merge": """
        SELECT o_orderkey, o_totalprice,
               CAST(CASE WHEN year(o_orderdate) >= 1998 AND o_totalprice > 400000
                         THEN year(o_orderdate) - 1
                         ELSE year(o_orderdate) END AS INT) AS year
        FROM orders""",
    "fact_build": f"""
        WITH dim AS (
            SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS k
            FROM customer WHERE {KNOWN}),
        n AS (
            SELECT s.*, row_number() OVER (
                PARTITION BY order_id, customer_id, product_id
                ORDER BY amount DESC, line_no) AS rn
            FROM {SALES} s)
        SELECT n.order_id, n.customer_id, n.product_id, n.order_date, n.amount,
               coalesce(d.k, -1) AS "DimCustomerKey",
               coalesce(p.p_partkey, -1) AS "DimProductKey"
        FROM n LEFT JOIN dim d ON n.customer_id = d.c_custkey
        LEFT JOIN part p ON n.product_id = p.p_partkey AND p.p_partkey % 3 <> 0
        WHERE rn = 1""",
    "scd2_dim": VERSIONS,
    "scd2_reference_degenerate": """
        SELECT p_partkey, p_name, p_partkey AS start_at, CAST(NULL AS BIGINT) AS end_at
        FROM part""",
    "current_version": f"""
        SELECT user_id, event_type, start_at FROM ({VERSIONS}) v
        WHERE end_at IS NULL""",
    "scd2_stream": VERSIONS,
    "expectation_counts": """
        WITH e AS (
            SELECT CASE WHEN event_type <> 'error' THEN event_id END AS event_id,
                   CASE WHEN value < 10 THEN user_id END AS user_id
            FROM events)
        SELECT count(*) AS rows_checked, 'rule1' AS rule,
               count(*) - count(event_id) AS failures FROM e
        UNION ALL
        SELECT count(*), 'rule2', count(*) - count(user_id) FROM e""",
    "expect_or_drop": """
        SELECT event_id, user_id FROM events
        WHERE event_type <> 'error' AND value < 10
          AND event_id IS NOT NULL AND user_id IS NOT NULL""",
    "warehouse_customers": """
        SELECT c_custkey AS customer_id,
               c_name || '@' || lower(c_mktsegment) || '.com' AS email,
               c_acctbal AS balance, lower(c_mktsegment) || '.com' AS domains,
               upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) || ' ' || c_name
                   AS full_name,
               row_number() OVER (ORDER BY c_custkey) AS "DimCustomerKey"
        FROM customer""",
    "warehouse_customers_updated": """
        SELECT c_custkey AS customer_id,
               c_name || '@' || lower(c_mktsegment) || '.com' AS email,
               CASE c_custkey % 3 WHEN 0 THEN CAST(-100000 AS DOUBLE)
                    WHEN 1 THEN CAST(100000 AS DOUBLE) ELSE c_acctbal END AS balance, lower(c_mktsegment) || '.com' AS domains,
               upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) || ' ' || c_name
                   AS full_name,
               row_number() OVER (ORDER BY c_custkey) AS "DimCustomerKey"
        FROM customer""",
    "warehouse_products": """
        SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS brand,
               p_type AS category, p_retailprice AS price,
               round(p_retailprice * CAST(0.9 AS DOUBLE), 4) AS discounted_price,
               p_partkey AS start_at, CAST(NULL AS BIGINT) AS end_at
        FROM part""",
    "warehouse_facts": f"""
        WITH dim AS (
            SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS k
            FROM customer),
        n AS (
            SELECT s.*, row_number() OVER (
                PARTITION BY order_id, customer_id, product_id
                ORDER BY amount DESC) AS rn
            FROM {SALES} s)
        SELECT n.order_id, n.customer_id, n.product_id, n.order_date,
               n.amount AS total_amount,
               CAST(year(n.order_date) AS INT) AS year,
               coalesce(d.k, -1) AS "DimCustomerKey",
               coalesce(p.p_partkey, -1) AS "DimProductKey"
        FROM n LEFT JOIN dim d ON n.customer_id = d.c_custkey
        LEFT JOIN part p ON n.product_id = p.p_partkey
        WHERE rn = 1""",
    "warehouse_facts_corrected": f"""
        WITH dim AS (
            SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS k
            FROM customer),
        n AS (
            SELECT s.*, row_number() OVER (
                PARTITION BY order_id, customer_id, product_id
                ORDER BY amount DESC) AS rn
            FROM {SALES} s)
        SELECT n.order_id, n.customer_id, n.product_id, n.order_date,
               CASE n.order_id % 3 WHEN 0 THEN CAST(0.5 AS DOUBLE)
                    WHEN 1 THEN CAST(1000000 AS DOUBLE) ELSE n.amount END AS total_amount,
               CAST(year(n.order_date) AS INT) AS year,
               coalesce(d.k, -1) AS "DimCustomerKey",
               coalesce(p.p_partkey, -1) AS "DimProductKey"
        FROM n LEFT JOIN dim d ON n.customer_id = d.c_custkey
        LEFT JOIN part p ON n.product_id = p.p_partkey
        WHERE rn = 1""",
    "batch_enriched": f"""
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               CAST(substring(o_orderpriority, 1, 1) AS BIGINT) AS product_id,
               CAST(o_orderdate AS DATE) AS order_date, o_totalprice AS amount,
               c_name AS customer_name, c_nationkey AS region_id, region_name, country,
               p_name AS product_name, p_brand AS brand, p_type AS category,
               p_retailprice AS price
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey
        LEFT JOIN {REGIONS} r ON c_nationkey = r.region_id
        LEFT JOIN part ON p_partkey = CAST(substring(o_orderpriority, 1, 1) AS BIGINT)
        """,
    "schema_drift_type_change": """
        SELECT p_partkey,
               CASE p_partkey % 3 WHEN 1 THEN CAST(length(p_type) AS VARCHAR)
                    WHEN 0 THEN p_type END AS p_type,
               CASE WHEN p_partkey % 3 = 0 OR p_partkey % 3 = 1 AND p_size <= 40
                    THEN p_size END AS p_size,
               CASE p_partkey % 3 WHEN 1 THEN floor(p_retailprice)
                    ELSE p_retailprice END AS p_retailprice,
               CASE WHEN p_partkey % 3 = 1 AND p_size > 40 THEN '{"p_size":"n/a"}'
                    WHEN p_partkey % 3 = 2
                    THEN '{"p_type":["' || p_type || '"],"p_size":{"value":' || p_size
                         || ',"unit":"cm"}}' END AS _rescued_data
        FROM part""",
    "scd2_corrected_version": VERSIONS.replace(
        "FROM events",
        "FROM (SELECT user_id, ts, CASE WHEN event_type IN ('click', 'error')"
        " THEN upper(event_type) ELSE lower(event_type) END AS event_type FROM events)",
    ),
    "change_feed": """
        SELECT p_partkey, p_name,
               CASE WHEN p_partkey % 7 <> 0 AND p_partkey % 3 = 0 THEN p_retailprice + 1
                    ELSE p_retailprice END AS p_retailprice,
               CASE WHEN p_partkey % 7 = 0 THEN 'delete' WHEN p_partkey % 5 = 0 THEN 'insert'
                    ELSE 'update' END AS _change
        FROM part
        WHERE CASE WHEN p_partkey % 7 = 0 THEN p_partkey % 5 <> 0
                   ELSE p_partkey % 5 = 0 OR p_partkey % 3 = 0 END""",
    "skip_changes": """
        SELECT p_partkey, p_name,
               CASE WHEN p_partkey % 5 = 0 AND p_partkey % 3 = 0 THEN p_retailprice + 1
                    ELSE p_retailprice END AS p_retailprice
        FROM part WHERE p_partkey % 5 <> 0 OR p_partkey % 7 <> 0""",
    "fact_build_as_of": """
        WITH v AS (SELECT user_id, event_type, ts FROM events WHERE event_id % 2 = 0),
        f AS (SELECT event_id, user_id, ts + INTERVAL 1 HOUR AS at FROM events
              WHERE event_id % 2 = 1)
        SELECT f.event_id, f.user_id, f.at, v.event_type, v.ts AS valid_from
        FROM f ASOF LEFT JOIN v ON f.user_id = v.user_id AND f.at >= v.ts""",
    "expectation_log": """
        WITH e AS (
            SELECT CASE WHEN event_type <> 'error' THEN event_id END AS event_id,
                   CASE WHEN value < 10 THEN user_id END AS user_id
            FROM events WHERE value IS NOT NULL)
        SELECT 'rule1' AS rule, count(*) AS rows_checked,
               count(*) - count(event_id) AS failures FROM e
        UNION ALL
        SELECT 'rule2', count(*), count(*) - count(user_id) FROM e""",
    "warehouse_same_hour": f"""
        WITH dim AS (
            SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS k
            FROM customer),
        n AS (
            SELECT s.*, row_number() OVER (
                PARTITION BY order_id, customer_id, product_id
                ORDER BY amount DESC) AS rn
            FROM {SALES} s)
        SELECT n.order_id, n.customer_id, n.product_id, n.order_date,
               CASE n.order_id % 3 WHEN 0 THEN CAST(0.5 AS DOUBLE)
                    WHEN 1 THEN CAST(1000000 AS DOUBLE) ELSE n.amount END AS total_amount,
               CAST(year(n.order_date) AS INT) AS year,
               coalesce(d.k, -1) AS "DimCustomerKey",
               coalesce(p.p_partkey, -1) AS "DimProductKey"
        FROM n LEFT JOIN dim d ON n.customer_id = d.c_custkey
        LEFT JOIN part p ON n.product_id = p.p_partkey
        WHERE rn = 1""",
    "empty_scan": "SELECT c_custkey, 'new' AS side FROM customer",
    "load_clock": """
        SELECT count(*) AS customers, CAST(1 AS BIGINT) AS clocks,
               CAST(0 AS BIGINT) AS updated_later, CAST(0 AS BIGINT) AS off_the_clock
        FROM customer""",
    "sql_country_category": f"""
        SELECT country AS region_name, p_type AS category, count(order_id) AS total_orders,
               round(sum(amount), 2) AS revenue,
               round(avg(amount), 2) AS avg_order_value
        FROM {STAR} LEFT JOIN part ON product_id = p_partkey
        GROUP BY 1, 2 ORDER BY revenue DESC, region_name, category LIMIT 50""",
    "export_monthly_revenue": MONTHLY.replace(SALES, BATCH_SALES),
    "export_category_revenue": f"""
        SELECT p_type AS category, round(sum(amount), 2) AS revenue,
               count(order_id) AS total_orders
        FROM {BATCH_SALES} s LEFT JOIN part ON product_id = p_partkey GROUP BY 1""",
    "export_region_revenue": f"""
        SELECT region_name, country, round(sum(amount), 2) AS revenue,
               count(order_id) AS total_orders,
               round(avg(amount), 2) AS avg_order_value
        FROM {STAR.replace(SALES, BATCH_SALES)} GROUP BY 1, 2""",
    "export_top_customers": TOP_CUSTOMERS.replace(SALES, BATCH_SALES),
}
