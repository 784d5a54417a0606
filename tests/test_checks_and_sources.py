import pytest
from pyspark.errors import AnalysisException
from pyspark.sql.datasource import DataSource, DataSourceReader

from sluiceway.operators import (
    CheckFailed,
    check_conditions,
    check_nonempty,
    check_outputs,
    require_conditions,
    require_nonempty,
    require_outputs,
)
from sluiceway.sources import from_item, read_query
from sluiceway.workspace import materialise, work_folder


def echo_connector():
    """A connector that runs no query but returns the one it was asked for."""

    class Reader(DataSourceReader):
        def __init__(self, options):
            self.options = options

        def read(self, partition):
            yield self.options["query"], self.options["project"]

    class Echo(DataSource):
        @classmethod
        def name(cls):
            return "echo"

        def schema(self):
            return "query string, project string"

        def reader(self, schema):
            return Reader(self.options)

    return Echo


def test_query_goes_to_the_connector(spark):
    spark.dataSource.register(echo_connector())
    query = "SELECT x FROM far.away"
    assert tuple(read_query(spark, query, "echo", project="p").first()) == (query, "p")
    with pytest.raises(ValueError, match="args"):
        read_query(spark, query, "echo", args={"a": 1})


def test_query_over_views(spark):
    spark.range(5).createOrReplaceTempView("source_view")
    assert read_query(spark, "SELECT * FROM source_view WHERE id > :low", args={"low": 2}).count() == 2
    with pytest.raises(ValueError, match="format"):
        read_query(spark, "SELECT 1", project="p")
    with pytest.raises(AnalysisException):
        read_query(spark, "SELECT nothing FROM source_view")


def test_from_item_alias(spark):
    spark.range(5).createOrReplaceTempView("source_view")
    assert from_item(spark, "source_view s").select("s.id").count() == 5


def test_nonempty(spark):
    assert tuple(check_nonempty(spark.range(3), "x").first()) == ("x", 3, True)
    assert tuple(check_nonempty(spark.range(0), "x").first()) == ("x", 0, False)
    require_nonempty(spark.range(1), "x")
    with pytest.raises(CheckFailed, match="'x' is empty"):
        require_nonempty(spark.range(0), "x")


def test_outputs(spark):
    spark.range(2).createOrReplaceTempView("out_two")
    spark.range(0).createOrReplaceTempView("out_none")
    report = {tuple(row) for row in check_outputs(spark, ["out_two", "out_none"]).collect()}
    assert report == {("out_two", 2, True), ("out_none", 0, False)}
    assert require_outputs(spark, ["out_two"]) == {"out_two": 2}
    with pytest.raises(CheckFailed, match="empty: out_none"):
        require_outputs(spark, ["out_two", "out_none"])
    with pytest.raises(ValueError):
        require_outputs(spark, [])
    with pytest.raises(AnalysisException):
        require_outputs(spark, ["out_missing"])


def test_conditions(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "c")], "n int, s string")
    conditions = {"n known": "n IS NOT NULL", "n positive": "n > 0", "always": "true"}
    report = [tuple(row) for row in check_conditions(df, conditions).collect()]
    assert report == [("n known", 1, False), ("n positive", 1, False), ("always", 0, True)]
    require_conditions(df, "df", {"always": "true"})
    with pytest.raises(CheckFailed, match=r"'df' does not meet: n known \(1 rows\), n positive \(1 rows\)$"):
        require_conditions(df, "df", conditions)


def test_work_tables_live_in_the_shared_folder(spark):
    held = materialise(spark.range(3), "kept")
    assert all(work_folder(spark) in file for file in held.inputFiles())
    assert held.count() == 3
