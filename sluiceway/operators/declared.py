"""Loads declared as a mapping, in a spec or a job."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame

from sluiceway.operators.batches import load_batch
from sluiceway.operators.load import LoadResult, load, load_external


def load_item(df: DataFrame, table: str, item: Mapping[str, Any], **load_options: Any) -> LoadResult:
    """Load as a declared item says: into a catalog table, or with ``format`` and ``options`` through a connector.

    The connector gets the table's name as ``table``, unless the options say where to write. With ``batch`` the load
    may be repeated, see :func:`sluiceway.operators.batches.load_batch`.
    """
    load_type = item.get("load_type", "append")
    if "batch" in item:
        if "format" in item:
            raise ValueError("a batch needs a catalog table, not a connector")
        return load_batch(df, table, item["batch"], load_type, **load_options)
    if "format" not in item:
        if "options" in item:
            raise ValueError("options need a connector format")
        return load(df, table, load_type, **load_options)
    options = dict(item.get("options") or {})
    if not {"table", "dbtable", "path"} & set(options):
        options["table"] = table
    return load_external(df, item["format"], load_type, **load_options, **options)
