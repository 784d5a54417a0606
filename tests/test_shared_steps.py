"""Jobs evaluate a step once that several of their loads and checks need."""

import uuid

import pytest
from pyspark.sql import functions as F

from sluiceway.operators import CheckFailed
from sluiceway.plans import run_job
from sluiceway.plans.steps import _runs


@pytest.fixture
def source(spark):
    """A view of 40 rows, and a function that tells how many rows have been read from it."""
    read = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def seen(x):
        read.add(1)
        return x

    name = f"source_{uuid.uuid4().hex}"
    spark.range(40).select(seen.asNondeterministic()("id").alias("id")).createOrReplaceTempView(name)
    yield name, lambda: read.value
    spark.catalog.dropTempView(name)


@pytest.fixture
def targets(spark):
    names = [f"target_{uuid.uuid4().hex}" for _ in range(3)]
    yield names
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def written(result):
    """Steps that were written; the loads' own tables are named otherwise."""
    return [table for table in result.work_tables if not table.split(".")[1].startswith("load_")]


def loads(targets, *views):
    return [{"table_name": t, "dataframe_name": v, "load_type": "overwrite"} for t, v in zip(targets, views)]


def test_two_loads_and_a_check_of_one_view(spark, source, targets):
    name, read = source
    config = {"extract": [{"name": "base", "query": f"SELECT id FROM {name}"}], "outputs": ["base"], "load": loads(targets, "base", "validated_base")}
    result = run_job(spark, config)
    assert read() == 40
    assert [spark.table(t).count() for t in targets[:2]] == [40, 40] and [r.rows_loaded for r in result.loads] == [40, 40]
    assert result.views["base"].count() == 40 and len(written(result)) == 1
    result.release(spark)
    assert read() == 40


def test_views_between_are_built_on_what_was_written(spark, source, targets):
    name, read = source
    config = {
        "extract": [{"name": "base", "query": f"SELECT id, id % 4 AS k FROM {name}"}],
        "transform": [
            {"name": "low", "query": "SELECT id FROM base WHERE id < 10"},
            {"name": "sums", "query": "SELECT k, SUM(id) AS total FROM validated_base WHERE id IN (SELECT id FROM low) GROUP BY k"},
            {"name": "lower", "query": "WITH c AS (SELECT id FROM low) SELECT id FROM c WHERE id < 5"},
        ],
        "load": loads(targets, "sums", "lower"),
    }
    result = run_job(spark, config)
    assert read() == 40
    assert sorted((r.k, r.total) for r in spark.table(targets[0]).collect()) == [(0, 12), (1, 15), (2, 8), (3, 10)]
    assert sorted(r.id for r in spark.table(targets[1]).collect()) == [0, 1, 2, 3, 4]
    result.release(spark)


def test_a_single_load_is_not_written_twice_and_a_step_may_opt_out(spark, source, targets):
    name, read = source
    steps = [{"name": "base", "query": f"SELECT id FROM {name}"}]
    assert written(run_job(spark, {"extract": steps, "load": loads(targets, "base")})) == []
    assert read() == 40
    steps[0]["table"] = False
    assert written(run_job(spark, {"extract": steps, "load": loads(targets, "base", "base")})) == []
    assert read() == 120


def test_a_later_step_of_the_same_name_counts(spark, source, targets):
    name, read = source
    config = {
        "extract": [{"name": "base", "query": f"SELECT id FROM {name}"}],
        "transform": [{"name": "base", "query": "SELECT id + 1 AS id FROM base"}],
        "load": loads(targets, "base", "base"),
    }
    run_job(spark, config).release(spark)
    assert read() == 40
    assert {r.id for r in spark.table(targets[1]).collect()} == set(range(1, 41))


def test_an_empty_output_of_several_ends_the_job_before_any_load(spark, source, targets):
    name, read = source
    config = {
        "extract": [{"name": "base", "query": f"SELECT id FROM {name}"}],
        "transform": [{"name": "none", "query": "SELECT id FROM base WHERE id < 0"}],
        "outputs": ["base", "none"],
        "load": loads(targets, "base"),
    }
    with pytest.raises(CheckFailed, match="empty: none"):
        run_job(spark, config)
    assert read() == 40 and not spark.catalog.tableExists(targets[0])


def test_columns_that_no_table_can_hold_stay_views(spark, source, targets):
    name, read = source
    config = {"extract": [{"name": "base", "query": f"SELECT id, NULL AS nothing FROM {name}"}, {"name": "ids", "query": "SELECT id FROM base"}], "load": loads(targets, "ids"), "outputs": ["base"]}
    result = run_job(spark, config)
    # The check of outputs counts rows without the column that is watched.
    assert written(result) == [] and spark.table(targets[0]).count() == 40 and read() == 40


def test_runs_are_counted_up_to_the_next_written_step():
    # 0 <- 1 <- 2, and 2 is used twice: only 2 is written.
    assert _runs([set(), {0}, {1}], [0, 0, 2], set()) == [1, 1, 2]
    # 1 and 2 both read 0.
    assert _runs([set(), {0}, {0}], [0, 1, 1], set()) == [2, 1, 1]
    # 1 was written before: it does not run 0 again.
    assert _runs([set(), {0}, {0}], [0, 1, 1], {1}) == [1, 1, 1]
