"""Sources that are a query: pushed to a connector, or Spark SQL over registered views and tables."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def read_query(
    spark: SparkSession,
    query: str,
    fmt: str | None = None,
    args: Mapping[str, Any] | None = None,
    **options: Any,
) -> DataFrame:
    """Result of ``query``.

    With ``fmt`` the connector of that name runs the query and only the result travels to Spark.
    Without it the query is Spark SQL, and ``args`` binds its ``:name`` markers.
    """
    if fmt is None:
        if options:
            raise ValueError("options need a connector format")
        return spark.sql(query, args=dict(args) if args else None)
    if args:
        raise ValueError("args bind markers in Spark SQL, not in a connector's query")
    return spark.read.format(fmt).options(**options).option("query", query).load()


def from_item(spark: SparkSession, item: str) -> DataFrame:
    """A FROM item such as ``"orders o"`` or ``"sales.orders o"``; columns resolve as ``o.name``."""
    return spark.sql(f"SELECT * FROM {item}")
