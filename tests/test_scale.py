"""Plans: what large tables and hot keys would meet."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from acceptance.relational import SPECS
from sluiceway.operators import join
from sluiceway.sources import from_item

SF_DIR = "/root/testdata/sf0.001"
NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@contextmanager
def settings(spark, values):
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in values:
            spark.conf.unset(key)


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(SPECS) - {"cross_join"}))
def test_only_the_cross_join_pairs_everything(spark, name):
    with settings(spark, NO_BROADCAST):
        plan = contract.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = contract.queries()["customer_orders"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01T00:00)" in plan
    assert "o_orderstatus" not in plan and "c_acctbal" not in plan


@pytest.mark.parametrize("name", ["left_join", "right_join", "full_join_items"])
def test_hot_key_joins_read_few_columns_and_keep_nothing(spark, name):
    plan = contract.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan and "l_extendedprice" not in plan and "o_custkey" not in plan and "p_name" not in plan
    if name != "full_join_items":
        assert "GreaterThan(l_quantity,49.0)" in plan


HOT = {
    **NO_BROADCAST,
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture(scope="module")
def hot(spark):
    """Keys of a small side, and rows of which a third share one of them."""
    spark.range(400).selectExpr("id AS k").createOrReplaceTempView("hot_keys")
    rows = spark.range(0, 60000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).alias("k"), F.xxhash64("id").alias("v")
    )
    rows.createOrReplaceTempView("hot_rows")
    return from_item(spark, "hot_keys a"), from_item(spark, "hot_rows b")


def largest_share(df):
    rows = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(rows) / sum(rows)


@pytest.mark.parametrize("kind", ["LEFT", "FULL"])
def test_outer_join_with_a_hot_key_is_dealt(spark, hot, kind):
    keys, rows = hot
    with settings(spark, {**NO_BROADCAST, "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "32"}):
        whole = join(keys, rows, kind, "a.k = b.k")
        parts = join(keys, rows, kind, "a.k = b.k", hot_keys=True)
        assert largest_share(whole) > 1 / 3 and largest_share(parts) < 1 / 5
        assert sorted(map(repr, whole.collect())) == sorted(map(repr, parts.collect()))


def test_inner_join_with_a_hot_key_is_split(spark, hot):
    with settings(spark, HOT):
        assert "skew=true" in executed(join(*hot, "INNER", "a.k = b.k"))


def test_semi_join_collapses_the_hot_side_before_the_shuffle(spark, hot):
    with settings(spark, HOT):
        semi = join(*hot, "LEFT SEMI", ["a.k = b.k", "b.v <> 0", "concat('x', b.v) <> 'a AND b'"], hot_keys=True)
        below_join = executed(semi).split("Initial Plan")[0].split("SortMergeJoin")[1]
        assert below_join.count("HashAggregate(keys=[k#") == 2
        assert semi.count() == 400


def test_filters_pass_an_ordered_view(spark):
    from sluiceway.plans import query_from_spec

    spark.read.parquet(f"{SF_DIR}/customer.parquet").createOrReplaceTempView("scale_customer")
    spec = {"select_columns": ["c_custkey", "c_nationkey"], "table_name": "scale_customer", "order_by": ["c_custkey"]}
    query_from_spec(spark, spec).createOrReplaceTempView("scale_ordered")
    plan = spark.sql("SELECT * FROM scale_ordered WHERE c_nationkey = 3")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(c_nationkey,3)" in plan


def test_a_long_run_of_ties_spreads(spark):
    from sluiceway.operators import ordered

    with settings(spark, {"spark.sql.adaptive.enabled": "false"}):
        sizes = ordered(spark.range(0, 40000, numPartitions=8).selectExpr("0 AS same", "id"), ["same"]).select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(sizes) >= 6


@pytest.mark.parametrize("kind", ["LEFT SEMI", "LEFT ANTI"])
def test_semi_and_anti_joins_with_a_hot_key_on_the_left_are_split(spark, hot, kind):
    keys, rows = hot
    with settings(spark, HOT):
        joined = join(rows, keys, kind, "a.k = b.k")
        assert "skew=true" in executed(joined)
        assert joined.count() == rows.filter("k < 400" if kind == "LEFT SEMI" else "k >= 400").count()
