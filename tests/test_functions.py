import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sluiceway.functions import WAREHOUSE_TYPES, conform, repartition_by_size, size_report, time_of_day
from sluiceway.operators import reused


def test_conform_takes_warehouse_and_spark_names(spark):
    df = spark.createDataFrame([("1", "1.5", "2.25", "x", "2024-01-02 03:04:05", "7")], list("abcdef"))
    typed = conform(
        df, {"a": "INT64", "b": "float64", "c": "BIGNUMERIC", "d": "TIME", "e": "DATETIME", "f": "int"}
    )
    assert dict(typed.dtypes) == {
        "a": "bigint",
        "b": "double",
        "c": "decimal(38,9)",
        "d": "string",
        "e": "timestamp",
        "f": "int",
    }
    assert typed.first().a == 1
    assert WAREHOUSE_TYPES["NUMERIC"] == WAREHOUSE_TYPES["BIGNUMERIC"]


@pytest.mark.parametrize("kind", ["INT64", "DATETIME", "NUMERIC"])
def test_conform_raises_on_a_value_that_does_not_fit(spark, kind):
    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
        conform(spark.createDataFrame([("1oo.0",)], ["a"]), {"a": kind}).collect()


def test_conform_raises_on_an_unknown_column(spark):
    with pytest.raises(PySparkException, match="UNRESOLVED_COLUMN"):
        conform(spark.createDataFrame([("1",)], ["a"]), {"b": "INT64"})


def test_time_of_day(spark):
    moment = datetime.datetime(2024, 3, 31, 2, 30, 15, 999000)
    df = spark.createDataFrame([(moment,)], "t timestamp").withColumn("n", F.lit(moment).cast("timestamp_ntz"))
    row = df.select(time_of_day("n").alias("n"), time_of_day(F.col("n")).alias("m"), time_of_day().alias("now")).first()
    assert row.n == row.m == "02:30:15"
    assert len(row.now) == 8


def test_time_of_day_of_dates_and_texts(spark):
    df = spark.sql("SELECT DATE '2024-01-01' AS d, '2024-01-01T12:30:00' AS t, '2024-01-01 01:02:03.5' AS f")
    assert tuple(df.select(*[time_of_day(c) for c in "dtf"]).first()) == ("00:00:00", "12:30:00", "01:02:03")
    with pytest.raises(PySparkException):
        spark.sql("SELECT 'garbage text' AS g").select(time_of_day("g")).collect()


def test_conform_takes_names_with_dots(spark):
    assert conform(spark.createDataFrame([("1",)], ["a.b"]), {"a.b": "INT64"}).first()[0] == 1


def test_time_of_day_without_zone_ignores_the_session_zone(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-03-31 02:30:00' AS t")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert df.select(time_of_day("t").alias("t")).first().t == "02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_size_report(spark):
    df = spark.createDataFrame([("ab", 1), ("é", 22)], "s string, n int")
    sizes = len('{"s":"ab","n":1}') + len('{"s":"é","n":22}'.encode())
    assert tuple(size_report(df).first()) == (sizes, 1)
    assert tuple(size_report(df, partition_bytes=10).first()) == (sizes, sizes // 10)
    assert tuple(size_report(df.limit(0)).first()) == (0, 1)


def test_repartition_by_size(spark):
    df = spark.range(1000)
    with reused(df) as kept:
        spread = repartition_by_size(kept, partition_bytes=1000)
        assert spread.rdd.getNumPartitions() == size_report(df).first().bytes // 1000
        assert spread.count() == 1000
    assert repartition_by_size(df).rdd.getNumPartitions() == 1


def test_reused_releases_the_same_dataframe(spark):
    df = spark.range(10)
    with pytest.raises(KeyError), reused(df) as kept:
        assert kept is df and df.is_cached
        raise KeyError
    assert not df.is_cached
