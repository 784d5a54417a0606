"""Output partitioning by size: that of files written already, or an estimate."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: bytes of one output partition.
PARTITION_BYTES = 128 * 1024 * 1024


def row_bytes() -> Column:
    """Bytes of a row's JSON form, field names included."""
    return F.octet_length(F.to_json(F.struct("*"))).cast("bigint")


def size_report(df: DataFrame, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """One row: estimated ``bytes`` and the number of ``partitions`` to write them in."""
    size = F.coalesce(F.sum("bytes"), F.lit(0))
    return (
        df.select(row_bytes().alias("bytes"))
        .agg(size.alias("bytes"))
        .select("bytes", F.greatest(F.lit(1), F.expr(f"bytes div {partition_bytes}")).alias("partitions"))
    )


def repartition_by_size(df: DataFrame, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """Spread the rows evenly over as many partitions as their estimated size asks for.

    The estimate is a pass over ``df``, so give it something cheap to read twice: a table, or a
    DataFrame that is kept with :func:`sluiceway.operators.load.reused`.
    """
    return df.repartition(size_report(df, partition_bytes).first().partitions)


def file_bytes(spark: SparkSession, table: str) -> int:
    """Bytes of a table's files as their folder lists them; no row is read."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS NOSCAN")
    about = json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {table} AS JSON").first()[0])
    return about.get("statistics", {}).get("size_in_bytes", 0)


def repartition_by_files(spark: SparkSession, table: str, partition_bytes: int | None = None) -> DataFrame:
    """A table's rows, spread evenly over as many partitions as its files ask for.

    A partition stands for ``PARTITION_BYTES`` of files or up to twice as much, provided that the target's format
    packs rows as the table's does.
    """
    return spark.table(table).repartition(max(1, file_bytes(spark, table) // (partition_bytes or PARTITION_BYTES)))
