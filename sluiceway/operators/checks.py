"""Checks on outputs. ``check_*`` give a report as a DataFrame, ``require_*`` raise."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class CheckFailed(Exception):
    """An output does not meet its conditions."""


def violations(condition: str) -> Column:
    """Number of rows that do not meet the condition; a NULL outcome does not meet it."""
    return F.count_if(~F.coalesce(F.expr(condition), F.lit(False)))


def check_nonempty(df: DataFrame, name: str) -> DataFrame:
    """One row: name, number of rows, and whether there are any."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("view_name"), "row_count", (F.col("row_count") > 0).alias("passed")
    )


def check_outputs(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """:func:`check_nonempty` for each of the named views or tables."""
    if not names:
        raise ValueError("no outputs to check")
    return reduce(DataFrame.union, [check_nonempty(spark.table(name), name) for name in names])


def check_conditions(df: DataFrame, conditions: Mapping[str, str]) -> DataFrame:
    """One row per labelled condition: number of violating rows, and whether there are none.

    All conditions are counted in one pass.
    """
    labels = list(conditions)
    counts = df.agg(*[violations(conditions[label]).alias(f"c{i}") for i, label in enumerate(labels)])
    pairs = [
        F.struct(F.lit(label).alias("check_name"), F.col(f"c{i}").alias("violations"))
        for i, label in enumerate(labels)
    ]
    return counts.select(F.inline(F.array(*pairs))).withColumn("passed", F.col("violations") == 0)


def require_nonempty(df: DataFrame, name: str) -> None:
    """Raise unless there is a row. Reads no further than the first one."""
    if df.isEmpty():
        raise CheckFailed(f"'{name}' is empty")


def require_outputs(spark: SparkSession, names: Sequence[str]) -> dict[str, int]:
    """Row counts of the named views or tables; raise if one of them is empty."""
    return require_counted(spark, names, {})


def require_counted(spark: SparkSession, names: Sequence[str], counted: Mapping[str, int]) -> dict[str, int]:
    """:func:`require_outputs`, reading only those whose rows are not ``counted`` yet."""
    unread = [name for name in names if name not in counted]
    counts = dict(counted)
    if unread or not names:
        counts |= {row.view_name: row.row_count for row in check_outputs(spark, unread).collect()}
    empty = [name for name in names if counts[name] == 0]
    if empty:
        raise CheckFailed(f"empty: {', '.join(empty)}")
    return {name: counts[name] for name in names}


def require_conditions(df: DataFrame, name: str, conditions: Mapping[str, str]) -> None:
    """Raise unless every row meets every condition."""
    require_counts(name, {row.check_name: row.violations for row in check_conditions(df, conditions).collect()})


def require_counts(name: str, counts: Mapping[str, int]) -> None:
    """Raise if a condition was counted as violated."""
    broken = [f"{label} ({count} rows)" for label, count in counts.items() if count]
    if broken:
        raise CheckFailed(f"'{name}' does not meet: {', '.join(broken)}")
