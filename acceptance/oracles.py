"""SQL for each acceptance query, to run on the same tables in another engine."""

from __future__ import annotations

CUSTOMER_ORDERS = """
customer_orders AS (
  SELECT c.c_custkey, c.c_name, r.r_name AS region, o.o_orderkey, o.o_orderdate, o.o_totalprice
  FROM customer c
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN orders o ON c.c_custkey = o.o_custkey
  WHERE o.o_orderdate >= TIMESTAMP '1997-01-01 00:00:00'
)"""

ENRICHED_ORDERS = CUSTOMER_ORDERS + """,
enriched_orders AS (
  SELECT co.*, l.l_partkey, p.p_name, p.p_type AS category, l.l_quantity,
         CAST(l.l_quantity * p.p_retailprice AS DECIMAL(18,2)) AS total_price
  FROM customer_orders co
  JOIN lineitem l ON co.o_orderkey = l.l_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""

PRODUCT_SALES = f"""
WITH {ENRICHED_ORDERS}
SELECT category, COUNT(DISTINCT o_orderkey) AS order_count,
       CAST(SUM(l_quantity) AS BIGINT) AS total_quantity,
       CAST(SUM(total_price) AS DOUBLE) AS total_revenue
FROM enriched_orders GROUP BY category"""

REGIONAL_SALES = f"""
WITH {ENRICHED_ORDERS}
SELECT region, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_sales,
       COUNT(DISTINCT o_orderkey) AS order_count, COUNT(DISTINCT c_custkey) AS unique_customers
FROM enriched_orders WHERE o_totalprice > 250000
GROUP BY region HAVING SUM(o_totalprice) > 1500000000"""

BIG_ORDERS = "FROM orders WHERE o_totalprice > 450000 AND o_orderstatus = 'F'"

UNION_DISTINCT = """
SELECT c_nationkey AS nationkey FROM customer WHERE c_acctbal < -950
UNION SELECT s_nationkey FROM supplier WHERE s_acctbal > 8500
UNION SELECT n_nationkey FROM nation WHERE n_regionkey = 1"""

LEFT_JOIN = """
SELECT p.p_partkey, p.p_brand, l.l_orderkey, l.l_quantity
FROM part p LEFT JOIN lineitem l ON p.p_partkey = l.l_partkey AND l.l_quantity > 49"""

NEGATIVE = "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal < 0"

ORACLES = {
    "customer_orders": f"WITH {CUSTOMER_ORDERS} SELECT * FROM customer_orders",
    "order_details": f"""
        WITH {ENRICHED_ORDERS}
        SELECT o_orderkey, l_partkey, category, l_quantity, CAST(total_price AS DOUBLE) AS total_price
        FROM enriched_orders""",
    "regional_sales": REGIONAL_SALES,
    "spec_query": REGIONAL_SALES,
    "spec_load": REGIONAL_SALES,
    "product_sales": PRODUCT_SALES,
    "job_shared": f"""
        WITH {ENRICHED_ORDERS}
        SELECT category AS item, CAST(SUM(l_quantity) AS BIGINT) AS quantity FROM enriched_orders GROUP BY category
        UNION ALL
        SELECT CAST(o_orderkey AS VARCHAR), CAST(SUM(l_quantity) AS BIGINT) FROM enriched_orders GROUP BY o_orderkey""",
    "step_chain": PRODUCT_SALES,
    "step_validated": PRODUCT_SALES,
    "job_load": PRODUCT_SALES,
    "step_materialised": f"""
        WITH r AS ({REGIONAL_SALES}), p AS ({PRODUCT_SALES})
        SELECT 'region' AS report, region AS item, order_count FROM r
        UNION ALL SELECT 'category', category, order_count FROM p""",
    "step_params": f"SELECT o_orderkey {BIG_ORDERS}",
    "work_copy": f"WITH {CUSTOMER_ORDERS} SELECT region, COUNT(*) AS orders FROM customer_orders GROUP BY region",
    "group_sum": """
        SELECT l_returnflag, l_linestatus, CAST(SUM(l_quantity) AS BIGINT) AS sum_qty
        FROM lineitem GROUP BY l_returnflag, l_linestatus""",
    "group_dedupe": "SELECT p_brand, p_type FROM part GROUP BY p_brand, p_type",
    "having_key": """
        SELECT p_brand, COUNT(*) AS parts FROM part GROUP BY p_brand HAVING p_brand = 'Brand#2'""",
    "group_stats": """
        SELECT l_returnflag, MIN(l_quantity) AS min_qty, MAX(l_quantity) AS max_qty,
               CAST(CAST(AVG(l_quantity) AS DECIMAL(18,4)) AS DOUBLE) AS avg_qty, COUNT(*) AS items
        FROM lineitem GROUP BY l_returnflag""",
    "group_names": """
        SELECT l_suppkey AS __k0, COUNT(*) AS __h, CAST(SUM(l_quantity) AS BIGINT) AS __s0
        FROM lineitem GROUP BY l_suppkey HAVING MIN(l_quantity) < 3""",
    "job_connector": PRODUCT_SALES,
    "global_count": "SELECT COUNT(*) AS items FROM lineitem",
    "left_join": LEFT_JOIN,
    "right_join": LEFT_JOIN,
    "left_join_items": """
        SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, p.p_brand
        FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey AND p.p_size > 25""",
    "full_join": """
        SELECT c.c_custkey, s.s_suppkey FROM customer c FULL JOIN supplier s ON c.c_custkey = s.s_suppkey + 1450""",
    "full_join_items": """
        SELECT o.o_orderkey, o.o_orderstatus, l.l_partkey, l.l_quantity
        FROM orders o
        FULL JOIN lineitem l ON o.o_orderkey = l.l_orderkey AND o.o_totalprice > 250000 AND l.l_quantity > 40""",
    "semi_join": """
        SELECT c_custkey, c_name FROM customer
        WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 490000)""",
    "anti_join": """
        SELECT c_custkey, c_name FROM customer
        WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)""",
    "cross_join": "SELECT s_suppkey, s_name, r_name FROM supplier CROSS JOIN region",
    "theta_join": """
        SELECT o.o_orderkey, l.l_linenumber, l.l_partkey, l.l_shipdate
        FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey AND l.l_shipdate < o.o_orderdate
        AND l.l_extendedprice * 10 > o.o_totalprice""",
    "band_join": """
        SELECT c_custkey, s_suppkey, c_acctbal, s_acctbal
        FROM customer JOIN supplier ON c_acctbal >= s_acctbal - 0.5 AND c_acctbal <= s_acctbal + 0.5""",
    "self_join": """
        SELECT a.c_custkey AS custkey, c.c_custkey AS next_custkey, a.c_mktsegment AS segment
        FROM customer a JOIN customer c ON a.c_custkey + 1 = c.c_custkey
        WHERE a.c_mktsegment = c.c_mktsegment""",
    "union_distinct": UNION_DISTINCT,
    "union_ordered": UNION_DISTINCT,
    "union_grouped": """
        SELECT o_custkey AS custkey, 'orders' AS kind, COUNT(*) AS n
        FROM orders GROUP BY o_custkey HAVING SUM(o_totalprice) > 3000000
        UNION
        SELECT c.c_custkey, 'customers', COUNT(o.o_orderkey)
        FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey
        WHERE c.c_acctbal > 9000 GROUP BY c.c_custkey""",
    "order_by_multi": """
        SELECT c_custkey, c_name, c_nationkey FROM customer ORDER BY c_nationkey DESC, c_name ASC""",
    "order_by_aggregate": """
        SELECT l_suppkey, COUNT(*) AS items, CAST(SUM(l_quantity) AS BIGINT) AS sum_qty
        FROM lineitem GROUP BY l_suppkey""",
    "pass_through": "SELECT c_custkey, c_name, c_acctbal FROM customer",
    "source_query": f"SELECT o_orderkey, o_totalprice {BIG_ORDERS}",
    "conform_types": "SELECT o_orderkey, o_totalprice, o_orderdate, o_orderstatus FROM orders",
    "time_of_day": "SELECT event_id, strftime(ts, '%H:%M:%S') AS time_of_day FROM events",
    "sectioned_read": """
        SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
               o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS o_totalprice,
               CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority
        FROM orders""",
    "sectioned_bundle": """
        SELECT 'client' AS kind, c_name AS name, c_acctbal FROM customer WHERE c_acctbal < 0
        UNION ALL SELECT 'vendor', s_name, s_acctbal FROM supplier""",
    "load_append": """
        SELECT c_custkey, c_name, c_acctbal FROM customer
        UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer""",
    "load_truncate": NEGATIVE,
    "load_retry": """
        SELECT c_custkey, c_name, c_acctbal, 'monday' AS load_batch FROM customer
        UNION ALL SELECT c_custkey, c_name, c_acctbal, 'tuesday' FROM customer WHERE c_acctbal < 0
        UNION ALL SELECT c_custkey, c_name, c_acctbal, 'replaced' FROM customer WHERE c_acctbal < 0""",
    "load_overwrite": "SELECT s_suppkey, s_acctbal FROM supplier",
    "load_create": "SELECT c_custkey, c_name, TRUE AS created FROM customer",
    "load_audit": """
        SELECT CAST(0 AS BIGINT) AS without_load_ts, CAST(1 AS BIGINT) AS load_times, COUNT(*) AS row_count
        FROM customer""",
    "load_metrics": """
        SELECT COUNT(*) FILTER (c_acctbal < 0) AS rows_held, COUNT(*) AS rows_removed,
               COUNT(*) FILTER (c_acctbal < 0) AS rows_loaded
        FROM customer""",
    "size_estimate": """
        SELECT CAST(SUM(STRLEN(c_name) + 8) AS BIGINT) AS bytes,
               CAST(GREATEST(1, SUM(STRLEN(c_name) + 8) // 134217728) AS BIGINT) AS partitions
        FROM customer""",
    "check_nonempty": f"""
        WITH {CUSTOMER_ORDERS}
        SELECT 'customer_orders' AS view_name, COUNT(*) AS row_count, COUNT(*) > 0 AS passed
        FROM customer_orders""",
    "check_outputs": f"""
        WITH {ENRICHED_ORDERS}, p AS ({PRODUCT_SALES}), r AS ({REGIONAL_SALES})
        SELECT 'enriched_orders' AS view_name, COUNT(*) AS row_count, COUNT(*) > 0 AS passed FROM enriched_orders
        UNION ALL SELECT 'product_sales', COUNT(*), COUNT(*) > 0 FROM p
        UNION ALL SELECT 'regional_sales', COUNT(*), COUNT(*) > 0 FROM r
        UNION ALL SELECT 'free_orders', COUNT(*), COUNT(*) > 0 FROM customer_orders WHERE o_totalprice < 0""",
    "check_gate": """
        SELECT 'quantity is positive' AS check_name, COUNT(*) FILTER (NOT l_quantity > 0) AS violations,
               COUNT(*) FILTER (NOT l_quantity > 0) = 0 AS passed FROM lineitem
        UNION ALL SELECT 'discount below a tenth', COUNT(*) FILTER (NOT l_discount < 0.1),
               COUNT(*) FILTER (NOT l_discount < 0.1) = 0 FROM lineitem
        UNION ALL SELECT 'ship date known', COUNT(*) FILTER (l_shipdate IS NULL),
               COUNT(*) FILTER (l_shipdate IS NULL) = 0 FROM lineitem""",
}
