"""Queries declared as a mapping, evaluated with DataFrame operators.

Keys: ``select_columns`` and ``table_name`` (required), ``join_conditions``, ``where_conditions``,
``group_by``, ``having``, ``order_by`` and ``unions``, a list of mappings with the same keys but no
``unions`` of their own. A union has set semantics, so the order of one branch has no effect; the order
of the top level sorts the result. The top level may also have the load keys of :func:`stage_from_spec`.
Any other key is an error, since a misspelt condition would otherwise let all rows through.

A join may also carry ``hot_keys: True``, and its ``join_condition`` may be a list of conditions that must
all hold, see :mod:`sluiceway.operators.joins`.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.operators.declared import load_item
from sluiceway.operators.joins import join, join_name
from sluiceway.operators.load import LoadResult
from sluiceway.operators.relational import grouped, ordered, union_distinct
from sluiceway.sources.queries import from_item

_REQUIRED = ("select_columns", "table_name")
_TEXTS = ("table_name", "where_conditions", "having")
_LISTS = ("select_columns", "group_by", "order_by")
_QUERY_KEYS = {*_REQUIRED, *_TEXTS, *_LISTS, "join_conditions"}
# Keys that tell what becomes of the result; load_file is a note for others and is not read.
_LOAD_KEYS = {"staging_table_name", "load_table", "load_type", "load_file", "format", "options", "batch"}
_JOIN_KEYS = {"join_type", "join_table", "join_condition", "hot_keys"}
_COUNT = re.compile(r"count\s*\(\s*\*\s*\)", re.IGNORECASE)
_STAR = re.compile(r"(?:^|[.(,])\s*\*")
_DISTINCT = re.compile(r"\s*distinct\s+", re.IGNORECASE)


class SpecError(ValueError):
    """A query spec is not well formed; the message lists every fault."""


def _is_text(value: Any) -> bool:
    return isinstance(value, str) and bool(value.strip())


def _faults(spec: Any, at: str, nested: bool = False) -> list[str]:
    if not isinstance(spec, Mapping):
        return [f"{at or 'the spec'} must be a mapping"]
    at = f"{at}." if at else ""
    known = _QUERY_KEYS if nested else _QUERY_KEYS | _LOAD_KEYS | {"unions"}
    found = [f"{at}{key} is not a known key here" for key in spec if key not in known]
    found += [f"{at}{key} is required" for key in _REQUIRED if key not in spec]
    found += [f"{at}{key} must be a non-empty string" for key in _TEXTS if key in spec and not _is_text(spec[key])]
    for key in _LISTS:
        if key in spec and not (isinstance(spec[key], list) and spec[key] and all(map(_is_text, spec[key]))):
            found.append(f"{at}{key} must be a non-empty list of non-empty strings")
    parts = {"join_conditions": _join_faults}
    if not nested:
        parts["unions"] = lambda branch, place: _faults(branch, place, nested=True)
    for key, faults in parts.items():
        if key in spec and not (isinstance(spec[key], list) and spec[key]):
            found.append(f"{at}{key} must be a non-empty list of mappings")
        elif key in spec:
            for i, part in enumerate(spec[key]):
                found += faults(part, f"{at}{key}[{i}]")
    return found


def _join_faults(item: Any, at: str) -> list[str]:
    if not isinstance(item, Mapping):
        return [f"{at} must be a mapping"]
    unknown = [f"{at}.{key} is not a known key here" for key in item if key not in _JOIN_KEYS]
    found = [f"{at}.{key} must be a non-empty string" for key in ("join_type", "join_table") if not _is_text(item.get(key))]
    condition = item.get("join_condition")
    listed = isinstance(condition, list) and bool(condition) and all(map(_is_text, condition))
    if not found and join_name(item["join_type"]) == "cross":
        if "join_condition" in item:
            found.append(f"{at} is a cross join and takes no join_condition")
    elif not listed and not _is_text(condition):
        found.append(f"{at}.join_condition must be a non-empty string")
    return unknown + found


def check_spec(spec: Any) -> None:
    """Raise :class:`SpecError` unless ``spec`` is well formed."""
    found = _faults(spec, "")
    if found:
        raise SpecError("; ".join(found))


def _texts(value: Any) -> list[str]:
    if isinstance(value, Mapping):
        value = [v for key, v in value.items() if key not in ("table_name", "join_table")]
    return [value] if isinstance(value, str) else [text for v in value for text in _texts(v)] if isinstance(value, list) else []


def _needed(df: DataFrame, spec: Mapping[str, Any], order_by: list[str]) -> DataFrame:
    """Only the columns whose names occur in the spec, for joins that look at whole rows; all of them if it selects a star."""
    texts = _texts([dict(spec), *order_by])
    if any(_STAR.search(_COUNT.sub("", text)) for text in texts):
        return df
    whole = "\n".join(texts).lower()
    names = [name for name in df.columns if name.lower() in whole]
    twice = len({name.lower() for name in df.columns}) < len(df.columns)
    return df if twice or not names else df.select(*[F.col(f"`{name.replace('`', '``')}`") for name in names])


def _branch(spark: SparkSession, spec: Mapping[str, Any], order_by: list[str]) -> DataFrame:
    joins = spec.get("join_conditions", [])
    narrow = any(item.get("hot_keys", False) for item in joins)

    def table(item: str) -> DataFrame:
        df = from_item(spark, item)
        return _needed(df, spec, order_by) if narrow else df

    rows = table(spec["table_name"])
    for item in joins:
        rows = join(
            rows,
            table(item["join_table"]),
            item["join_type"],
            item.get("join_condition"),
            item.get("hot_keys", False),
        )
    if "where_conditions" in spec:
        rows = rows.filter(F.expr(spec["where_conditions"]))
    first, *others = spec["select_columns"]
    distinct = _DISTINCT.match(first)
    select = [first[distinct.end() :] if distinct else first, *others]
    if "group_by" in spec or "having" in spec:
        in_group = [] if distinct else order_by
        rows = grouped(rows, select, spec.get("group_by", ()), spec.get("having"), in_group)
    else:
        in_group = []
        rows = rows.select(*map(F.expr, select))
    if distinct:
        rows = rows.distinct()
    return ordered(rows, order_by) if order_by and not in_group else rows


def query_from_spec(spark: SparkSession, spec: Mapping[str, Any]) -> DataFrame:
    """The DataFrame a spec describes; tables are views or catalog tables, with or without an alias."""
    check_spec(spec)
    order_by = spec.get("order_by", [])
    if "unions" not in spec:
        return _branch(spark, spec, order_by)
    result = union_distinct([_branch(spark, branch, []) for branch in (spec, *spec["unions"])])
    return ordered(result, order_by, spec["select_columns"]) if order_by else result


def stage_from_spec(spark: SparkSession, spec: Mapping[str, Any], **load_options: Any) -> LoadResult | None:
    """Evaluate a spec and load the result as its load keys say.

    ``load_table`` turns the load on, ``staging_table_name`` names the target, ``load_type`` is
    ``append`` unless given. With ``format`` the target is a connector's, told by ``options``; the name goes
    along as its ``table``. ``batch`` makes the load repeatable. Without ``load_table`` the spec is only checked and analysed.
    """
    rows = query_from_spec(spark, spec)
    if not spec.get("load_table", False):
        return None
    if not _is_text(spec.get("staging_table_name")):
        raise SpecError("staging_table_name must be a non-empty string when load_table is set")
    return load_item(rows, spec["staging_table_name"], spec, **load_options)
