"""Loads: what the target holds afterwards, also when something fails on the way."""

import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sluiceway.operators import CheckFailed, create_target, load, load_external
from sluiceway.workspace import drop_work_table, work_database


@pytest.fixture
def target(spark):
    name = f"target_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def held(spark, table):
    return sorted(tuple(row) for row in spark.table(table).drop("load_ts").collect())


def rows(spark, *values):
    return spark.createDataFrame(list(values), "id int, name string")


A, B, C = (1, "a"), (2, "b"), (3, "c")


def test_append_creates_then_adds_by_name(spark, target):
    result = load(rows(spark, A, B), target)
    assert (result.target, result.rows_removed, result.rows_loaded, result.created) == (target, 0, 2, True)
    result = load(rows(spark, C).select("name", "id"), target)
    assert (result.rows_loaded, result.created) == (1, False)
    assert held(spark, target) == [A, B, C]
    assert dict(spark.table(target).dtypes)["load_ts"] == "timestamp"
    assert spark.table(target).filter("load_ts IS NULL").count() == 0


def test_truncate_keeps_the_definition(spark, target):
    spark.sql(f"CREATE TABLE {target} (name STRING, id BIGINT, load_ts TIMESTAMP) USING orc PARTITIONED BY (id) COMMENT 'kept'")
    load(rows(spark, A, B), target)
    result = load(rows(spark, C), target, "truncate")
    assert (result.rows_removed, result.rows_loaded) == (2, 1)
    assert spark.table(target).select("id", "name").collect() == [(3, "c")]
    described = {row.col_name: row.data_type for row in spark.sql(f"DESCRIBE TABLE EXTENDED {target}").collect()}
    assert described["Comment"] == "kept" and described["Provider"] == "orc"


def test_overwrite_replaces_the_schema(spark, target):
    load(rows(spark, A, B), target)
    result = load(spark.range(3), target, "overwrite")
    assert (result.rows_removed, result.rows_loaded, result.created) == (2, 3, False)
    assert spark.table(target).columns == ["id", "load_ts"]


def test_create_target(spark, target):
    assert create_target(rows(spark, A), target) is True
    assert create_target(rows(spark, A), target) is False
    assert held(spark, target) == []


@pytest.mark.parametrize("load_type", ["truncate", "overwrite"])
def test_load_may_read_its_own_target(spark, target, load_type):
    load(rows(spark, A, B, C), target)
    result = load(spark.table(target).filter("id > 1"), target, load_type)
    assert (result.rows_removed, result.rows_loaded) == (3, 2)
    assert held(spark, target) == [B, C]


@pytest.mark.parametrize("load_type", ["append", "truncate", "overwrite"])
def test_failing_query_leaves_the_target_and_can_be_retried(spark, target, load_type):
    load(rows(spark, A), target)
    bad = rows(spark, B, C).withColumn("id", F.when(F.col("id") == 3, F.raise_error("broken").cast("int")).otherwise(F.col("id")))
    with pytest.raises(PySparkException, match="broken"):
        load(bad, target, load_type)
    assert held(spark, target) == [A]
    load(rows(spark, B, C), target, load_type)
    assert held(spark, target) == ([A, B, C] if load_type == "append" else [B, C])


@pytest.mark.parametrize("load_type", ["append", "truncate", "overwrite"])
def test_failing_check_leaves_the_target(spark, target, load_type):
    load(rows(spark, A), target)
    conditions = {"named": "name IS NOT NULL", "small": "id < 3", "known": "id > 0"}
    with pytest.raises(CheckFailed, match=r"does not meet: named \(1 rows\), small \(3 rows\), known \(1 rows\)$"):
        load(rows(spark, B, C, (4, None), (None, "n")), target, load_type, conditions=conditions)
    with pytest.raises(CheckFailed, match="nothing to load"):
        load(rows(spark, B).limit(0), target, load_type, nonempty=True)
    assert held(spark, target) == [A]
    assert load(rows(spark, B), target, load_type, conditions=conditions, nonempty=True).rows_loaded == 1


@pytest.mark.parametrize("load_type", ["append", "truncate", "overwrite"])
@pytest.mark.parametrize("direct", [True, False])
def test_empty_load(spark, target, load_type, direct):
    load(rows(spark, A), target)
    result = load(rows(spark, A).filter("id > 5"), target, load_type, direct=direct)
    assert result.rows_loaded == 0
    assert held(spark, target) == ([A] if load_type == "append" else [])


@pytest.mark.parametrize("load_type", ["append", "truncate", "overwrite"])
def test_direct_load(spark, target, load_type):
    load(rows(spark, A), target)
    result = load(rows(spark, B), target, load_type, direct=True)
    assert (result.rows_removed, result.rows_loaded) == (0 if load_type == "append" else 1, 1)
    assert held(spark, target) == ([A, B] if load_type == "append" else [B])
    with pytest.raises(ValueError, match="direct"):
        load(rows(spark, B), target, load_type, direct=True, sized=True)


def test_sized_load(spark, target):
    result = load(spark.range(0, 1000, numPartitions=8).selectExpr("CAST(id AS INT) AS id", "'x' AS name"), target, sized=True)
    assert result.rows_loaded == 1000
    assert len(spark.table(target).inputFiles()) == 1


def test_unknown_load_type(spark, target):
    with pytest.raises(ValueError, match="load_type must be one of append, truncate, overwrite"):
        load(rows(spark, A), target, "upsert")


def test_repeated_columns(spark, target):
    with pytest.raises(ValueError, match="more than once: id"):
        load(rows(spark, A).selectExpr("id", "name AS ID"), target)


@pytest.mark.parametrize("load_type", ["append", "truncate"])
def test_columns_must_fit(spark, target, load_type):
    load(rows(spark, A), target)
    with pytest.raises(ValueError, match=r"missing \['name'\], not in the table \['other'\]"):
        load(rows(spark, B).withColumnRenamed("name", "other"), target, load_type)
    assert held(spark, target) == [A]


def test_load_ts_is_one_time_per_load(spark, target):
    load(spark.range(0, 100, numPartitions=8), target)
    load(spark.range(0, 100, numPartitions=8), target)
    assert spark.table(target).select("load_ts").distinct().count() == 2


def test_work_tables_are_dropped(spark, target):
    before = spark.catalog.listTables(work_database(spark))
    load(rows(spark, A), target, "truncate")
    with pytest.raises(CheckFailed):
        load(rows(spark, A), target, conditions={"no": "false"})
    assert len(spark.catalog.listTables(work_database(spark))) == len(before)


def test_rows_are_kept_when_the_copy_into_the_target_fails(spark, target, tmp_path):
    spark.sql(f"CREATE TABLE {target} (id INT, load_ts TIMESTAMP) USING parquet LOCATION '{tmp_path / 'gone'}'")
    load(spark.range(3).selectExpr("CAST(id AS INT) AS id"), target)
    with pytest.raises(PySparkException, match="CAST_OVERFLOW") as failure:
        load(spark.range(1).selectExpr("id + 3000000000 AS id"), target, "truncate")
    kept = failure.value.__notes__[0].split()[-1]
    assert [row.id for row in spark.table(kept).collect()] == [3000000000]
    drop_work_table(spark, kept)


def test_external_load(spark, tmp_path):
    path = str(tmp_path / "out")
    assert load_external(rows(spark, A, B), "parquet", path=path).rows_loaded == 2
    assert load_external(rows(spark, C), "parquet", path=path).target == path
    assert spark.read.parquet(path).count() == 3
    result = load_external(spark.read.parquet(path).filter("id > 1").drop("load_ts"), "parquet", "truncate", path=path)
    assert result.rows_loaded == 2
    assert sorted(row.id for row in spark.read.parquet(path).collect()) == [2, 3]
    with pytest.raises(CheckFailed):
        load_external(rows(spark, A), "parquet", "overwrite", path=path, conditions={"two": "id = 2"})
    assert spark.read.parquet(path).count() == 2
