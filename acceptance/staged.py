"""Queries over sectioned text, step chains, loads and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acceptance.inputs import as_text, register, write_sections
from acceptance.relational import REGIONAL_SALES, STAR_TABLES
from sluiceway.functions import size_report
from sluiceway.operators import (
    check_conditions,
    check_nonempty,
    check_outputs,
    create_target,
    load,
    load_batch,
    ordered,
)
from sluiceway.plans import run_job, run_step, run_steps, stage_from_spec
from sluiceway.sources import from_item, load_bundle, read_sections
from sluiceway.workspace import materialise, new_work_path, new_work_table

CUSTOMER_ORDERS = {
    "name": "customer_orders",
    "query": """
        SELECT c.c_custkey, c.c_name, r.r_name AS region, o.o_orderkey, o.o_orderdate, o.o_totalprice
        FROM orders o
        JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey
        JOIN region r ON n.n_regionkey = r.r_regionkey
        WHERE o.o_orderdate >= TIMESTAMP_NTZ '1997-01-01 00:00:00'""",
}
ENRICHED_ORDERS = {
    "name": "enriched_orders",
    "query": """
        SELECT co.region, co.c_custkey, co.o_orderkey, co.o_totalprice, p.p_type AS category, l.l_quantity,
               CAST(l.l_quantity * p.p_retailprice AS DECIMAL(18,2)) AS total_price
        FROM lineitem l
        JOIN customer_orders co ON l.l_orderkey = co.o_orderkey
        JOIN part p ON l.l_partkey = p.p_partkey""",
}
PRODUCT_SALES = {
    "name": "product_sales",
    "query": """
        SELECT category, COUNT(DISTINCT o_orderkey) AS order_count,
               CAST(SUM(l_quantity) AS BIGINT) AS total_quantity,
               CAST(SUM(total_price) AS DOUBLE) AS total_revenue
        FROM enriched_orders
        GROUP BY category""",
}
REGIONAL_REPORT = {
    "name": "regional_sales",
    "query": """
        SELECT region, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_sales,
               COUNT(DISTINCT o_orderkey) AS order_count, COUNT(DISTINCT c_custkey) AS unique_customers
        FROM enriched_orders
        WHERE o_totalprice > 250000
        GROUP BY region
        HAVING SUM(o_totalprice) > 1500000000""",
}
BIG_ORDERS = {
    "name": "big_orders",
    "query": """
        SELECT o_orderkey FROM IDENTIFIER(:orders_table)
        WHERE o_totalprice > :min_total AND o_orderstatus = :status""",
    "dynamic_variable_flag": True,
}
BIG_ORDERS_PARAMS = {"orders_table": "orders", "min_total": 450000, "status": "F"}


def product_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir, *STAR_TABLES)
    steps = run_steps(spark, [CUSTOMER_ORDERS, ENRICHED_ORDERS, PRODUCT_SALES])
    return ordered(steps["product_sales"], ["total_revenue DESC"])


def step_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir, *STAR_TABLES)
    job = run_job(spark, {"extract": [CUSTOMER_ORDERS], "transform": [ENRICHED_ORDERS, PRODUCT_SALES]})
    return job.views["product_sales"]


def step_validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir, *STAR_TABLES)
    run_steps(spark, [CUSTOMER_ORDERS, ENRICHED_ORDERS, PRODUCT_SALES], validated=True)
    return spark.table("validated_product_sales")


def step_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir, "orders")
    return run_step(spark, BIG_ORDERS, BIG_ORDERS_PARAMS)


def step_materialised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched orders are written once and feed both reports; the result is both, side by side."""
    register(spark, sf_dir, *STAR_TABLES)
    views = run_steps(
        spark, [CUSTOMER_ORDERS, {**ENRICHED_ORDERS, "table": True}, REGIONAL_REPORT, PRODUCT_SALES]
    )
    return (
        views["regional_sales"]
        .select(F.lit("region").alias("report"), F.col("region").alias("item"), "order_count")
        .union(views["product_sales"].select(F.lit("category"), "category", "order_count"))
    )


def job_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extract, transform and a checked load; the result is what the target holds."""
    register(spark, sf_dir, *STAR_TABLES)
    target = new_work_table(spark, "product_sales")
    config = {
        "extract": [CUSTOMER_ORDERS],
        "transform": [ENRICHED_ORDERS, PRODUCT_SALES],
        "load": [
            {
                "table_name": target,
                "dataframe_name": "product_sales",
                "load_type": "overwrite",
                "conditions": {"revenue is positive": "total_revenue > 0"},
            }
        ],
    }
    run_job(spark, config)
    return spark.table(target).drop("load_ts")


def job_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads and a check of outputs that all need the enriched orders, which are evaluated once; both targets, side by side."""
    register(spark, sf_dir, *STAR_TABLES)
    targets = {name: new_work_table(spark, name) for name in ("product_sales", "order_values")}
    order_values = {
        "name": "order_values",
        "query": "SELECT o_orderkey, SUM(l_quantity) AS quantity FROM enriched_orders GROUP BY o_orderkey",
    }
    config = {
        "extract": [CUSTOMER_ORDERS],
        "transform": [ENRICHED_ORDERS, PRODUCT_SALES, order_values],
        "outputs": ["enriched_orders", "product_sales"],
        "load": [{"table_name": table, "dataframe_name": name, "load_type": "truncate"} for name, table in targets.items()],
    }
    run_job(spark, config).release(spark)
    sales, values = (spark.table(targets[name]) for name in ("product_sales", "order_values"))
    return sales.select(F.col("category").alias("item"), F.col("total_quantity").alias("quantity")).union(
        values.select(F.col("o_orderkey").cast("string"), F.col("quantity").cast("bigint"))
    )


def job_connector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job of which only one phase transforms, and whose target is a connector's; its files are read back."""
    register(spark, sf_dir, *STAR_TABLES)
    path = new_work_path(spark, "product_sales")
    config = {
        "transform": [CUSTOMER_ORDERS, ENRICHED_ORDERS, PRODUCT_SALES],
        "outputs": ["product_sales"],
        "load": [
            {
                "table_name": "product_sales",
                "dataframe_name": "product_sales",
                "load_type": "overwrite",
                "format": "parquet",
                "options": {"path": path},
            }
        ],
    }
    run_job(spark, config)
    return spark.read.parquet(path).drop("load_ts")


def spec_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A spec evaluated and loaded twice with ``truncate``; the second load replaces the first."""
    register(spark, sf_dir, *STAR_TABLES)
    target = new_work_table(spark, "regional_sales")
    spec = {**REGIONAL_SALES, "load_table": True, "staging_table_name": target, "load_type": "truncate"}
    stage_from_spec(spark, spec)
    stage_from_spec(spark, spec, sized=True)
    return spark.table(target).drop("load_ts")


def sectioned_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and orders written as one text, orders read back."""
    register(spark, sf_dir, "customer", "orders")
    texts = {name: as_text(spark.table(name)) for name in ("customer", "orders")}
    return read_sections(spark, write_sections(texts))["orders"]


def sectioned_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two texts that both hold customers: the later one, with those of negative balance, stays."""
    register(spark, sf_dir, "customer", "supplier")
    customer, supplier = as_text(spark.table("customer")), as_text(spark.table("supplier"))
    first = write_sections({"clients": customer, "vendors": supplier})
    second = write_sections({"clients": customer.filter(F.col("c_acctbal").startswith("-"))})
    tables = load_bundle(
        spark,
        {"first": first, "second": second},
        types={"clients": {"c_custkey": "INT64", "c_acctbal": "FLOAT64"}, "vendors": {"s_acctbal": "NUMERIC"}},
    )
    clients = tables["clients"].select(F.lit("client").alias("kind"), F.col("c_name").alias("name"), "c_acctbal")
    vendors = spark.table("vendors").select(F.lit("vendor"), "s_name", F.col("s_acctbal").cast("double"))
    return clients.union(vendors)


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir, "customer")
    return from_item(spark, "customer").select("c_custkey", "c_name", "c_acctbal")


def load_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_work_table(spark, "append")
    load(_customers(spark, sf_dir), target)
    load(_customers(spark, sf_dir).select("c_acctbal", "c_name", "c_custkey"), target)
    return spark.table(target).drop("load_ts")


def load_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second load reads the very table it replaces."""
    target = new_work_table(spark, "truncate")
    load(_customers(spark, sf_dir), target)
    load(spark.table(target).filter("c_acctbal < 0"), target, "truncate")
    return spark.table(target).drop("load_ts")


def load_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of which some come twice: appended by calls, and replacing one another as loads of a job."""
    customers = _customers(spark, sf_dir)
    customers.createOrReplaceTempView("all_customers")
    appended, replaced = new_work_table(spark, "appended"), new_work_table(spark, "replaced")
    for batch in ("monday", "tuesday", "monday"):
        load_batch(customers if batch == "monday" else customers.filter("c_acctbal < 0"), appended, batch)
    step = {"name": "replacing", "query": "SELECT * FROM all_customers WHERE c_acctbal < :most", "dynamic_variable_flag": True}
    for batch, most in (("first", 5000), ("second", 0), ("second", 9999)):
        item = {"table_name": replaced, "dataframe_name": "replacing", "load_type": "truncate", "batch": batch}
        run_job(spark, {"transform": [step], "load": [item]}, params={"most": most})
    held = spark.table(appended).select("c_custkey", "c_name", "c_acctbal", "load_batch")
    return held.union(spark.table(replaced).select("c_custkey", "c_name", "c_acctbal", F.lit("replaced")))


def load_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir, "supplier")
    target = new_work_table(spark, "overwrite")
    load(_customers(spark, sf_dir), target)
    load(spark.table("supplier").select("s_suppkey", "s_acctbal"), target, "overwrite")
    return spark.table(target).drop("load_ts")


def load_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target gets its columns from the result, then its rows."""
    target = new_work_table(spark, "create")
    customers = _customers(spark, sf_dir)
    created = create_target(customers.withColumn("load_ts", F.current_timestamp()), target)
    result = load(customers, target)
    return spark.table(target).select("c_custkey", "c_name", F.lit(created and not result.created).alias("created"))


def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_work_table(spark, "audit")
    load(_customers(spark, sf_dir), target)
    return spark.table(target).agg(
        F.count_if(F.col("load_ts").isNull()).alias("without_load_ts"),
        F.count_distinct("load_ts").alias("load_times"),
        F.count(F.lit(1)).alias("row_count"),
    )


def load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_work_table(spark, "metrics")
    customers = _customers(spark, sf_dir)
    load(customers, target)
    result = load(customers.filter("c_acctbal < 0"), target, "truncate")
    return spark.table(target).agg(
        F.count(F.lit(1)).alias("rows_held"),
        F.lit(result.rows_removed).cast("bigint").alias("rows_removed"),
        F.lit(result.rows_loaded).cast("bigint").alias("rows_loaded"),
    )


def size_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir, "customer")
    return size_report(from_item(spark, "customer").selectExpr("c_name AS n"))


def check_nonempty_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir, *STAR_TABLES)
    return check_nonempty(run_step(spark, CUSTOMER_ORDERS), "customer_orders")


def check_outputs_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir, *STAR_TABLES)
    # Three outputs read the enriched orders, so these are written once.
    steps = [CUSTOMER_ORDERS, {**ENRICHED_ORDERS, "table": True}, PRODUCT_SALES, REGIONAL_REPORT]
    no_orders = {"name": "free_orders", "query": "SELECT * FROM customer_orders WHERE o_totalprice < 0"}
    run_steps(spark, [*steps, no_orders])
    return check_outputs(spark, ["enriched_orders", "product_sales", "regional_sales", "free_orders"])


def check_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir, "lineitem")
    return check_conditions(
        spark.table("lineitem"),
        {
            "quantity is positive": "l_quantity > 0",
            "discount below a tenth": "l_discount < 0.1",
            "ship date known": "l_shipdate IS NOT NULL",
        },
    )


def work_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A step result written once and aggregated from there, as each stage of a staged job does."""
    register(spark, sf_dir, "customer", "nation", "region", "orders")
    held = materialise(run_step(spark, CUSTOMER_ORDERS), "customer_orders")
    return held.groupBy("region").agg(F.count(F.lit(1)).alias("orders"))


QUERIES = {
    "product_sales": product_sales,
    "step_chain": step_chain,
    "step_validated": step_validated,
    "step_params": step_params,
    "step_materialised": step_materialised,
    "job_load": job_load,
    "job_shared": job_shared,
    "job_connector": job_connector,
    "spec_load": spec_load,
    "sectioned_read": sectioned_read,
    "sectioned_bundle": sectioned_bundle,
    "load_append": load_append,
    "load_truncate": load_truncate,
    "load_retry": load_retry,
    "load_overwrite": load_overwrite,
    "load_create": load_create,
    "load_audit": load_audit,
    "load_metrics": load_metrics,
    "size_estimate": size_estimate,
    "check_nonempty": check_nonempty_query,
    "check_outputs": check_outputs_query,
    "check_gate": check_gate,
    "work_copy": work_copy,
}
