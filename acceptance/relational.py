"""Relational queries, declared as specs or built from the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from acceptance.inputs import register
from sluiceway.functions import conform, time_of_day
from sluiceway.operators import ordered
from sluiceway.plans import query_from_spec
from sluiceway.sources import from_item, read_query

SINCE_1997 = "o.o_orderdate >= TIMESTAMP_NTZ '1997-01-01 00:00:00'"

# Orders meet the customers before the items do: only the narrow rows are shuffled by customer.
CUSTOMER_JOINS = [
    {"join_type": "INNER", "join_table": "customer c", "join_condition": "o.o_custkey = c.c_custkey"},
    {"join_type": "INNER", "join_table": "nation n", "join_condition": "c.c_nationkey = n.n_nationkey"},
    {"join_type": "INNER", "join_table": "region r", "join_condition": "n.n_regionkey = r.r_regionkey"},
]
ITEM_JOINS = [
    {"join_type": "INNER", "join_table": "lineitem l", "join_condition": "o.o_orderkey = l.l_orderkey"},
    {"join_type": "INNER", "join_table": "part p", "join_condition": "l.l_partkey = p.p_partkey"},
]
STAR_TABLES = ("customer", "nation", "region", "orders", "lineitem", "part")

CUSTOMER_ORDERS = {
    "select_columns": [
        "c.c_custkey",
        "c.c_name",
        "r.r_name AS region",
        "o.o_orderkey",
        "o.o_orderdate",
        "o.o_totalprice",
    ],
    "table_name": "orders o",
    "join_conditions": CUSTOMER_JOINS,
    "where_conditions": SINCE_1997,
}

ORDER_DETAILS = {
    "select_columns": [
        "o.o_orderkey",
        "l.l_partkey",
        "p.p_type AS category",
        "l.l_quantity",
        "CAST(CAST(l.l_quantity * p.p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS total_price",
    ],
    "table_name": "orders o",
    "join_conditions": CUSTOMER_JOINS + ITEM_JOINS,
    "where_conditions": SINCE_1997,
}

REGIONAL_SALES = {
    "select_columns": [
        "r.r_name AS region",
        "CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_sales",
        "COUNT(DISTINCT o.o_orderkey) AS order_count",
        "COUNT(DISTINCT c.c_custkey) AS unique_customers",
    ],
    "table_name": "orders o",
    "join_conditions": CUSTOMER_JOINS + ITEM_JOINS,
    "where_conditions": f"{SINCE_1997} AND o.o_totalprice > 250000",
    "group_by": ["r.r_name"],
    "having": "SUM(o.o_totalprice) > 1500000000",
}

GROUP_SUM = {
    "select_columns": ["l_returnflag", "l_linestatus", "CAST(SUM(l_quantity) AS BIGINT) AS sum_qty"],
    "table_name": "lineitem",
    "group_by": ["l_returnflag", "l_linestatus"],
}
GROUP_DEDUPE = {
    "select_columns": ["p.p_brand", "p.p_type"],
    "table_name": "part p",
    "group_by": ["p.p_brand", "p.p_type"],
}
HAVING_KEY = {
    "select_columns": ["p.p_brand", "COUNT(*) AS parts"],
    "table_name": "part p",
    "group_by": ["p.p_brand"],
    "having": 'p.p_brand = "Brand#2"',
}
GROUP_STATS = {
    "select_columns": [
        "l.l_returnflag",
        "MIN(l.l_quantity) AS min_qty",
        "MAX(l.l_quantity) AS max_qty",
        "CAST(CAST(AVG(CAST(l.l_quantity AS DECIMAL(18,2))) AS DECIMAL(18,4)) AS DOUBLE) AS avg_qty",
        "COUNT(*) AS items",
    ],
    "table_name": "lineitem l",
    "group_by": ["l.l_returnflag"],
}
GLOBAL_COUNT = {"select_columns": ["COUNT(*) AS items"], "table_name": "lineitem"}

PART_ITEMS = ["p.p_partkey", "p.p_brand", "l.l_orderkey", "l.l_quantity"]
LEFT_JOIN = {
    "select_columns": PART_ITEMS,
    "table_name": "part p",
    "join_conditions": [
        {
            "join_type": "LEFT",
            "join_table": "lineitem l",
            "join_condition": ["p.p_partkey = l.l_partkey", "l.l_quantity > 49"],
            "hot_keys": True,
        }
    ],
}
RIGHT_JOIN = {
    "select_columns": PART_ITEMS,
    "table_name": "lineitem l",
    "join_conditions": [
        {
            "join_type": "RIGHT",
            "join_table": "part p",
            "join_condition": ["p.p_partkey = l.l_partkey", "l.l_quantity > 49"],
            "hot_keys": True,
        }
    ],
}
LEFT_JOIN_ITEMS = {
    "select_columns": ["l.l_orderkey", "l.l_linenumber", "l.l_quantity", "p.p_brand"],
    "table_name": "lineitem l",
    "join_conditions": [
        {
            "join_type": "LEFT OUTER",
            "join_table": "part p",
            "join_condition": "l.l_partkey = p.p_partkey AND p.p_size > 25",
        }
    ],
}
FULL_JOIN = {
    "select_columns": ["c.c_custkey", "s.s_suppkey"],
    "table_name": "customer c",
    "join_conditions": [
        {"join_type": "FULL", "join_table": "supplier s", "join_condition": "c.c_custkey = s.s_suppkey + 1450"}
    ],
}
FULL_JOIN_ITEMS = {
    "select_columns": ["o.o_orderkey", "o.o_orderstatus", "l.l_partkey", "l.l_quantity"],
    "table_name": "orders o",
    "join_conditions": [
        {
            "join_type": "FULL OUTER",
            "join_table": "lineitem l",
            "join_condition": ["o.o_orderkey = l.l_orderkey", "o.o_totalprice > 250000", "l.l_quantity > 40"],
            "hot_keys": True,
        }
    ],
}
SEMI_JOIN = {
    "select_columns": ["c.c_custkey", "c.c_name"],
    "table_name": "customer c",
    "join_conditions": [
        {
            "join_type": "LEFT SEMI",
            "join_table": "orders o",
            "join_condition": "c.c_custkey = o.o_custkey AND o.o_totalprice > 490000",
        }
    ],
}
ANTI_JOIN = {
    "select_columns": ["c.c_custkey", "c.c_name"],
    "table_name": "customer c",
    "join_conditions": [
        {
            "join_type": "LEFT ANTI",
            "join_table": "orders o",
            "join_condition": "c.c_custkey = o.o_custkey AND o.o_totalprice > 400000",
        }
    ],
}
# The five regions are the fixed side, so the result grows as the suppliers do.
CROSS_JOIN = {
    "select_columns": ["s.s_suppkey", "s.s_name", "r.r_name"],
    "table_name": "supplier s",
    "join_conditions": [{"join_type": "CROSS", "join_table": "region r"}],
}
THETA_JOIN = {
    "select_columns": ["o.o_orderkey", "l.l_linenumber", "l.l_partkey", "l.l_shipdate"],
    "table_name": "orders o",
    "join_conditions": [
        {
            "join_type": "INNER",
            "join_table": "lineitem l",
            "join_condition": "o.o_orderkey = l.l_orderkey AND l.l_shipdate < o.o_orderdate "
            "AND l.l_extendedprice * 10 > o.o_totalprice",
        }
    ],
}
# No equality at all: balances within half a unit of each other.
BAND_JOIN = {
    "select_columns": ["c.c_custkey", "s.s_suppkey", "c.c_acctbal", "s.s_acctbal"],
    "table_name": "customer c",
    "join_conditions": [
        {
            "join_type": "INNER",
            "join_table": "supplier s",
            "join_condition": ["c.c_acctbal >= s.s_acctbal - 0.5", "c.c_acctbal <= s.s_acctbal + 0.5"],
        }
    ],
}
SELF_JOIN = {
    "select_columns": ["a.c_custkey AS custkey", "c.c_custkey AS next_custkey", "a.c_mktsegment AS segment"],
    "table_name": "customer a",
    "where_conditions": "a.c_custkey + 1 = c.c_custkey AND a.c_mktsegment = c.c_mktsegment",
    "join_conditions": [
        {"join_type": "INNER", "join_table": "customer c", "join_condition": "a.c_custkey + 1 = c.c_custkey"}
    ],
}
UNION_DISTINCT = {
    "select_columns": ["c.c_nationkey AS nationkey"],
    "table_name": "customer c",
    "where_conditions": "c.c_acctbal < -950",
    "unions": [
        {"select_columns": ["s.s_nationkey"], "table_name": "supplier s", "where_conditions": "s.s_acctbal > 8500"},
        {"select_columns": ["n.n_nationkey"], "table_name": "nation n", "where_conditions": "n.n_regionkey = 1"},
    ],
}
UNION_ORDERED = {
    **UNION_DISTINCT,
    "order_by": ["nationkey DESC"],
    "unions": [
        {**UNION_DISTINCT["unions"][0], "order_by": ["s.s_nationkey ASC"]},
        {**UNION_DISTINCT["unions"][1], "order_by": ["n.n_nationkey DESC"]},
    ],
}
UNION_GROUPED = {
    "select_columns": ["o.o_custkey AS custkey", "'orders' AS kind", "COUNT(*) AS n"],
    "table_name": "orders o",
    "group_by": ["o.o_custkey"],
    "having": "SUM(o.o_totalprice) > 3000000",
    "unions": [
        {
            "select_columns": ["c.c_custkey", "'customers'", "COUNT(o.o_orderkey)"],
            "table_name": "customer c",
            "join_conditions": [
                {"join_type": "INNER", "join_table": "orders o", "join_condition": "c.c_custkey = o.o_custkey"}
            ],
            "where_conditions": "c.c_acctbal > 9000",
            "group_by": ["c.c_custkey"],
        }
    ],
}
ORDER_BY_MULTI = {
    "select_columns": ["c.c_custkey", "c.c_name", "c.c_nationkey"],
    "table_name": "customer c",
    "order_by": ["c.c_nationkey DESC", "c.c_name ASC"],
}
TOP_LINES_ORDERED = {
    "select_columns": ["l_suppkey", "COUNT(*) AS items", "CAST(SUM(l_quantity) AS BIGINT) AS sum_qty"],
    "table_name": "lineitem",
    "group_by": ["l_suppkey"],
    "order_by": ["MAX(l_quantity) DESC", "sum_qty DESC", "l_suppkey"],
}

# Outputs may have any name, also such as the library could use inside.
GROUP_NAMES = {
    "select_columns": ["l_suppkey AS __k0", "COUNT(*) AS __h", "CAST(SUM(l_quantity) AS BIGINT) AS __s0"],
    "table_name": "lineitem",
    "group_by": ["l_suppkey"],
    "having": "MIN(l_quantity) < 3",
    "order_by": ["MAX(l_quantity) DESC", "l_suppkey"],
}

# Query name -> (spec, tables it reads).
SPECS = {
    "customer_orders": (CUSTOMER_ORDERS, ("customer", "nation", "region", "orders")),
    "order_details": (ORDER_DETAILS, STAR_TABLES),
    "regional_sales": (REGIONAL_SALES, STAR_TABLES),
    "group_sum": (GROUP_SUM, ("lineitem",)),
    "group_dedupe": (GROUP_DEDUPE, ("part",)),
    "having_key": (HAVING_KEY, ("part",)),
    "group_stats": (GROUP_STATS, ("lineitem",)),
    "global_count": (GLOBAL_COUNT, ("lineitem",)),
    "left_join": (LEFT_JOIN, ("part", "lineitem")),
    "left_join_items": (LEFT_JOIN_ITEMS, ("part", "lineitem")),
    "right_join": (RIGHT_JOIN, ("part", "lineitem")),
    "full_join": (FULL_JOIN, ("customer", "supplier")),
    "full_join_items": (FULL_JOIN_ITEMS, ("orders", "lineitem")),
    "semi_join": (SEMI_JOIN, ("customer", "orders")),
    "anti_join": (ANTI_JOIN, ("customer", "orders")),
    "cross_join": (CROSS_JOIN, ("supplier", "region")),
    "theta_join": (THETA_JOIN, ("orders", "lineitem")),
    "band_join": (BAND_JOIN, ("customer", "supplier")),
    "self_join": (SELF_JOIN, ("customer",)),
    "union_distinct": (UNION_DISTINCT, ("customer", "supplier", "nation")),
    "union_ordered": (UNION_ORDERED, ("customer", "supplier", "nation")),
    "union_grouped": (UNION_GROUPED, ("customer", "orders")),
    "order_by_multi": (ORDER_BY_MULTI, ("customer",)),
    "order_by_aggregate": (TOP_LINES_ORDERED, ("lineitem",)),
    "group_names": (GROUP_NAMES, ("lineitem",)),
    "spec_query": ({**REGIONAL_SALES, "order_by": ["total_sales DESC"]}, STAR_TABLES),
}


def from_spec(name: str):
    spec, tables = SPECS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        register(spark, sf_dir, *tables)
        return query_from_spec(spark, spec)

    return run


def pass_through(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir, "customer")
    inner = from_item(spark, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    return inner.select("c_custkey", "c_name", "c_acctbal")


def source_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir, "orders")
    return read_query(
        spark,
        "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 450000 AND o_orderstatus = 'F'",
    )


def conform_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir, "orders")
    texts = from_item(spark, "orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS o_orderkey",
        "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) AS o_totalprice",
        "CAST(o_orderdate AS STRING) AS o_orderdate",
        "o_orderstatus",
    )
    typed = conform(texts, {"o_orderkey": "INT64", "o_totalprice": "NUMERIC", "o_orderdate": "DATETIME"})
    return conform(typed, {"o_totalprice": "FLOAT64", "o_orderdate": "timestamp_ntz"})


def time_of_day_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir, "events")
    return from_item(spark, "events").select("event_id", time_of_day("ts").alias("time_of_day"))


QUERIES = {name: from_spec(name) for name in SPECS} | {
    "pass_through": pass_through,
    "source_query": source_query,
    "conform_types": conform_types,
    "time_of_day": time_of_day_query,
}
