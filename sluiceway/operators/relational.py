"""Grouping, ordering and unions over free-form expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

_ORDER = re.compile(
    r"(?P<by>.*?)(?:\s+(?P<way>asc|desc))?(?:\s+nulls\s+(?P<nulls>first|last))?\s*",
    re.IGNORECASE | re.DOTALL,
)


def _order(item: str) -> tuple[str, str]:
    """``"a.x DESC"`` as the expression text and the name of the Column method that directs it."""
    parts = _ORDER.fullmatch(item.strip())
    way = (parts["way"] or "asc").lower()
    nulls = f"_nulls_{parts['nulls'].lower()}" if parts["nulls"] else ""
    return parts["by"], way + nulls


def _sorted(df: DataFrame, keys: Sequence[Column]) -> DataFrame:
    # Rows that tie may come in any order. A hash of the row as the last key lets range partitioning cut
    # through a long run of ties; unlike a partition number it lets filters above pass the sort.
    names = [name.lower() for name in df.columns]
    spread = [
        F.col(f"`{name.replace('`', '``')}`")
        for name, kind in df.dtypes
        if names.count(name.lower()) == 1 and "map<" not in kind and "variant" not in kind
    ]
    return df.orderBy(*keys, *([F.xxhash64(*spread)] if spread else []))


def ordered(df: DataFrame, order_by: Sequence[str], select: Sequence[str] = ()) -> DataFrame:
    """Sort by ``"expression [ASC|DESC] [NULLS FIRST|LAST]"`` items, first item first.

    A number stands for the column at that position. ``select`` gives the expressions behind the columns
    of ``df`` where these no longer resolve, as after a union: an item that repeats one of them sorts by
    its column.
    """
    named = {
        item.strip(): f"`{name}`"
        for item, name in zip(select, df.columns)
        if len(select) == len(df.columns) and df.columns.count(name) == 1
    }
    keys = [(_at(df.columns, by) or named.get(by, by), way) for by, way in map(_order, order_by)]
    return _sorted(df, [getattr(F.expr(by), way)() for by, way in keys])


def _at(names: Sequence[str], by: str) -> str | None:
    """The quoted name at the position that a sort item gives as a number."""
    if not by.isdigit():
        return None
    if not 1 <= int(by) <= len(names):
        raise ValueError(f"order_by item {by} is not the number of a select item")
    return f"`{names[int(by) - 1]}`"


def _group_key(df: DataFrame, select: Sequence[str], key: str) -> Column:
    """A grouping item: an expression, the number of a select item, or the name of one."""
    if key.isdigit():
        if not 1 <= int(key) <= len(select):
            raise ValueError(f"group_by item {key} is not the number of a select item")
        return F.expr(select[int(key) - 1])
    try:
        df.select(F.expr(key))
    except AnalysisException:
        for item in select:
            if df.select(F.expr(item)).columns == [key]:
                return F.expr(item)
        raise
    return F.expr(key)


def grouped(
    df: DataFrame,
    select: Sequence[str],
    group_by: Sequence[str] = (),
    having: str | None = None,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """GROUP BY with HAVING and ORDER BY; keys, aggregates and both conditions may mix freely.

    All of it is one aggregation, and what is not selected does not show in the result. Without
    ``group_by`` the whole input is one group. As in SQL, a name in HAVING or ORDER BY means the
    selected column before it means one of the input, but inside an aggregate it means the input's.
    """
    mark = unused([*df.columns, *select, *group_by, *order_by, having or ""])
    hidden = [f"{mark}k{i}" for i in range(len(group_by))]
    groups = df.groupBy(*[_group_key(df, select, key).alias(name) for key, name in zip(group_by, hidden)])
    outputs = [F.expr(item) for item in select]
    names = groups.agg(*outputs).columns[len(group_by) :]
    keys = [(_at(names, by) or by, way) for by, way in map(_order, order_by)]
    try:
        result = groups.agg(*outputs)
        if having:
            result = result.filter(F.expr(having))
        if keys:
            result = _sorted(result, [getattr(F.expr(by), way)() for by, way in keys])
    except AnalysisException:
        result, more = _grouped_with_hidden_columns(groups, outputs, names, having, keys, mark)
        hidden += more
    return result.drop(*hidden)


def unused(texts: Sequence[str]) -> str:
    """A beginning for names that occurs in none of the texts, so no output can have such a name."""
    mark, whole = "__", "\n".join(texts).lower()
    while mark in whole:
        mark += "_"
    return mark


def _grouped_with_hidden_columns(
    groups: GroupedData, outputs: list[Column], names: list[str], having: str | None, keys: list[tuple[str, str]], mark: str
) -> tuple[DataFrame, list[str]]:
    """For what Spark does not resolve above an aggregation, as HAVING and ORDER BY on other aggregates.

    Gives the result and the names of the columns that were added to it.
    """
    hidden, sort, added = [], [], []
    names = [name.lower() for name in names]
    for i, (by, way) in enumerate(keys):
        if names.count(by.strip("`").lower()) == 1:
            sort.append(getattr(F.col(by), way)())
        else:
            added.append(f"{mark}s{i}")
            hidden.append(F.expr(by).alias(added[-1]))
            sort.append(getattr(F.col(added[-1]), way)())
    result = groups.agg(*outputs, *hidden)
    if having:
        try:
            result = result.filter(F.expr(having))
        except AnalysisException:
            # An aggregate of an input column whose name is selected for something else.
            added.append(f"{mark}h")
            result = groups.agg(*outputs, *hidden, F.expr(having).alias(added[-1])).filter(F.col(added[-1]))
    return (_sorted(result, sort) if sort else result), added


def union_distinct(branches: Sequence[DataFrame]) -> DataFrame:
    """UNION of any number of branches, by position and without duplicates."""
    return reduce(DataFrame.union, branches).distinct()
