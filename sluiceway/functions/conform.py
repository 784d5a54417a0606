"""Typing of all-string columns, and the time of day as text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Warehouse type names and the Spark types they stand for.
WAREHOUSE_TYPES = {
    "INT64": "bigint",
    "FLOAT64": "double",
    "BIGNUMERIC": "decimal(38,9)",
    "NUMERIC": "decimal(38,9)",
    "TIME": "string",
    "DATETIME": "timestamp",
}


def conform(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns to the given types, named as in a warehouse or in Spark.

    Casts follow the session's ANSI mode, so by default a value that does not fit raises.
    """
    return df.withColumns(
        {name: F.col(f"`{name}`").cast(WAREHOUSE_TYPES.get(kind.strip().upper(), kind)) for name, kind in types.items()}
    )


def time_of_day(ts: Column | str | None = None) -> Column:
    """``HH:mm:ss`` of a timestamp with or without a time zone, a date or a text, or of now.

    A text is cast to a timestamp without a time zone, so under ANSI one that is none raises.
    """
    if ts is None:
        ts = F.current_timestamp()
    elif isinstance(ts, str):
        ts = F.col(ts)
    # As text a value with a zone has the session's local time, and one without keeps its own.
    whole = F.to_timestamp_ntz(ts.cast("string")).cast("string")
    return F.substring(F.split_part(whole, F.lit(" "), F.lit(2)), 1, 8)
