"""Loads into staging tables, with an audit column and metrics.

Loads that replace a table's rows, are gated by checks, or size their output, go through a work table:
the query runs once, in full, before the target is touched. So a failing query or check leaves the
target as it was, a load may read its own target, and counting, checking and sizing need no second run
of the query. Should the last copy into the target fail, the work table stays and the error names it.
The price is one more write and read of the result; ``direct`` saves it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sluiceway.functions.sizing import repartition_by_files
from sluiceway.operators.checks import CheckFailed, require_counts, violations
from sluiceway.workspace import drop_work_table, new_work_table

LOAD_TYPES = ("append", "truncate", "overwrite")


@dataclass(frozen=True)
class LoadResult:
    """What a load did. ``rows_removed`` is None where a connector does not tell."""

    target: str
    rows_removed: int | None
    rows_loaded: int
    created: bool


def audited(df: DataFrame) -> DataFrame:
    """Add ``load_ts``, one timestamp for all rows of the load."""
    return df.withColumn("load_ts", F.current_timestamp())


@contextmanager
def reused(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep ``df`` for the actions inside the block and release that same DataFrame afterwards."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


def create_target(df: DataFrame, table: str) -> bool:
    """Create an empty table with the columns of ``df`` unless it exists; tell whether it was created."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        return False
    spark.catalog.createTable(table, schema=df.schema)
    return True


def load(
    df: DataFrame,
    table: str,
    load_type: str = "append",
    *,
    conditions: Mapping[str, str] | None = None,
    nonempty: bool = False,
    sized: bool = False,
    direct: bool = False,
) -> LoadResult:
    """Load ``df`` plus ``load_ts`` into a catalog table, which is created if it does not exist.

    ``append`` adds rows, ``truncate`` replaces the rows and keeps the table's definition, ``overwrite``
    replaces the table. Columns go by name. ``conditions`` and ``nonempty`` must hold or nothing is
    loaded. ``sized`` writes partitions of about 128 MiB.
    """
    _check_arguments(df, load_type, direct and bool(conditions or nonempty or sized))
    spark = df.sparkSession

    def write(rows: DataFrame) -> tuple[int, bool]:
        exists = spark.catalog.tableExists(table)
        removed = spark.table(table).count() if exists and load_type != "append" else 0
        if load_type == "overwrite":
            rows.write.mode("overwrite").saveAsTable(table)
            return removed, not exists
        create_target(rows, table)
        (
            aligned(rows, spark.table(table).columns, table)
            .write.option("partitionOverwriteMode", "static")
            .insertInto(table, overwrite=load_type == "truncate")
        )
        return removed, not exists

    staged = not direct and bool(load_type != "append" or conditions or nonempty or sized)
    return _run(audited(df), table, write, conditions or {}, nonempty, sized, staged)


def load_external(
    df: DataFrame,
    fmt: str,
    load_type: str = "append",
    *,
    conditions: Mapping[str, str] | None = None,
    nonempty: bool = False,
    sized: bool = False,
    direct: bool = False,
    **options: Any,
) -> LoadResult:
    """:func:`load` through a connector, which ``options`` tell where to write.

    Both ``truncate`` and ``overwrite`` are the connector's own overwrite. Rows removed are not known.
    """
    _check_arguments(df, load_type, direct and bool(conditions or nonempty or sized))

    def write(rows: DataFrame) -> tuple[int | None, bool]:
        mode = "append" if load_type == "append" else "overwrite"
        rows.write.format(fmt).options(**options).mode(mode).save()
        return (0 if load_type == "append" else None), False

    target = str(options.get("table") or options.get("dbtable") or options.get("path") or fmt)
    staged = not direct and bool(load_type != "append" or conditions or nonempty or sized)
    return _run(audited(df), target, write, conditions or {}, nonempty, sized, staged)


def _check_arguments(df: DataFrame, load_type: str, direct_but_gated: bool) -> None:
    if load_type not in LOAD_TYPES:
        raise ValueError(f"load_type must be one of {', '.join(LOAD_TYPES)}, not {load_type!r}")
    if direct_but_gated:
        raise ValueError("a direct load can be neither checked beforehand nor sized")
    check_names(df)


def check_names(df: DataFrame) -> None:
    """Raise if two columns have one name."""
    names = [name.lower() for name in df.columns]
    twice = sorted({name for name in names if names.count(name) > 1})
    if twice:
        raise ValueError(f"columns occur more than once: {', '.join(twice)}")


def aligned(rows: DataFrame, columns: list[str], table: str) -> DataFrame:
    """The rows with their columns in the order of the table's; raise unless they are the same ones."""
    have = {name.lower() for name in rows.columns}
    want = {name.lower() for name in columns}
    if have != want:
        missing, extra = sorted(want - have), sorted(have - want)
        raise ValueError(f"columns do not fit table '{table}': missing {missing}, not in the table {extra}")
    return rows.select(*[F.col(f"`{name}`") for name in columns])


def observed(rows: DataFrame, conditions: Mapping[str, str]) -> tuple[DataFrame, Observation]:
    """Rows whose number, and violations of the i-th condition as ``c<i>``, are known once they have been written."""
    # Observed in the task that writes, whose numbers count once even if executors are lost on the way.
    seen = Observation()
    broken = [violations(condition).alias(f"c{i}") for i, condition in enumerate(conditions.values())]
    return rows.observe(seen, F.count(F.lit(1)).alias("rows"), *broken), seen


def _run(
    rows: DataFrame,
    target: str,
    write: Callable[[DataFrame], tuple[int | None, bool]],
    conditions: Mapping[str, str],
    nonempty: bool,
    sized: bool,
    staged: bool,
) -> LoadResult:
    spark = rows.sparkSession
    counted, seen = observed(rows, conditions)
    if not staged:
        removed, created = write(counted)
        return LoadResult(target, removed, seen.get["rows"], created)
    table = new_work_table(spark, "load")
    try:
        counted.write.saveAsTable(table)
        if nonempty and seen.get["rows"] == 0:
            raise CheckFailed(f"nothing to load into '{target}'")
        require_counts(target, {label: seen.get[f"c{i}"] for i, label in enumerate(conditions)})
    except BaseException:
        drop_work_table(spark, table)
        raise
    try:
        removed, created = write(repartition_by_files(spark, table) if sized else spark.table(table))
    except Exception as error:
        # The target may have lost its rows by now, so the new ones must not go as well.
        error.add_note(f"the rows for '{target}' are kept in {table}")
        raise
    drop_work_table(spark, table)
    return LoadResult(target, removed, seen.get["rows"], created)
