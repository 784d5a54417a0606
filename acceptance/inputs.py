"""Inputs of the acceptance queries: the driver's tables, also rendered as sectioned text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from sluiceway.workspace import new_work_path


def register(spark: SparkSession, sf_dir: str, *names: str) -> None:
    """Register the named driver tables as temp views."""
    for name in names:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


def as_text(df: DataFrame) -> DataFrame:
    """Every column as a string; doubles hold money and are written with two decimals."""
    columns = []
    for column, kind in df.dtypes:
        value = F.col(column).cast("decimal(18,2)") if kind == "double" else F.col(column)
        columns.append(value.cast("string").alias(column))
    return df.select(*columns)


def write_sections(tables: dict[str, DataFrame]) -> str:
    """Write tables as one sectioned text, a folder of part files that many tasks write; give its path."""
    spark = next(iter(tables.values())).sparkSession
    pieces = []
    for number, (name, table) in enumerate(tables.items()):
        frame = [f"[{name}]", ",".join(table.columns), ""]
        lines = [F.struct(F.lit(k).alias("kind"), F.lit(v).alias("line")) for k, v in zip((0, 1, 3), frame)]
        pieces.append(spark.range(1).select(F.lit(number).alias("section"), F.inline(F.array(*lines))))
        rows = F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in table.columns])
        pieces.append(table.select(F.lit(number).alias("section"), F.lit(2).alias("kind"), rows.alias("line")))
    path = new_work_path(spark, "sections")
    (
        reduce(DataFrame.union, pieces)
        .orderBy("section", "kind", F.spark_partition_id())
        .select("line")
        .write.text(path)
    )
    return path
