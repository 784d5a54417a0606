"""Loads that may be repeated: a batch has an id, and one that is in the target already adds nothing.

The journal is the target's own metadata, so it can't disagree with the rows. A target of appended batches is
partitioned by ``load_batch``; a batch's files are written aside and become a partition in one step of the
catalog. A target whose batches replace each other has its files in a folder named after the batch, and one step
of the catalog points it to the next folder. So a load that dies at any point leaves the rows as they were, and
files that it wrote are in nobody's way.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluiceway.functions.sizing import repartition_by_files
from sluiceway.operators.checks import CheckFailed, require_counts
from sluiceway.operators.load import LoadResult, aligned, audited, check_names, create_target, observed
from sluiceway.workspace import drop_work_folder, drop_work_table, new_work_table

BATCH = "load_batch"
BATCH_LOADS = ("append", "truncate")
# What a folder's name ends with: a digest of the batch's id and a number that no other try has.
_TRY = re.compile(r"-([0-9a-f]{32})-[0-9a-f]{32}$")


def load_batch(
    df: DataFrame,
    table: str,
    batch: str,
    load_type: str = "append",
    *,
    conditions: Mapping[str, str] | None = None,
    nonempty: bool = False,
    sized: bool = False,
) -> LoadResult:
    """Load ``df`` plus ``load_ts`` as the batch ``batch``, unless the target has it; then nothing is run.

    ``append`` adds rows to a table partitioned by ``load_batch``, which is created if it does not exist. Of two tries
    at the same time the first to be done counts. ``truncate`` replaces the rows of a table that is not partitioned,
    and knows the last batch only: an older one that comes again replaces it. Its definition stays. A query that
    was planned before the switch may fail for want of the old files, as with any overwrite; the old files of an external table
    are left where they are. Checks and sizes are those of :func:`sluiceway.operators.load.load`.
    """
    if load_type not in BATCH_LOADS:
        raise ValueError(f"the load_type of a batch must be one of {', '.join(BATCH_LOADS)}, not {load_type!r}")
    if not isinstance(batch, str) or not batch:
        raise ValueError("a batch needs a non-empty string as its id")
    check_names(df)
    if BATCH in [name.lower() for name in df.columns]:
        raise ValueError(f"{BATCH} is the column that tells the batch")
    way = _append if load_type == "append" else _replace
    return way(audited(df), table, batch, (conditions or {}, nonempty, sized))


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _described(spark: SparkSession, table: str) -> dict[str, Any]:
    return json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {table} AS JSON").first()[0])


def _append(rows: DataFrame, table: str, batch: str, gates: tuple) -> LoadResult:
    spark = rows.sparkSession
    created = not spark.catalog.tableExists(table)
    if created:
        rows.withColumn(BATCH, F.lit(batch)).limit(0).write.partitionBy(BATCH).saveAsTable(table)
    about = _described(spark, table)
    if about.get("partition_columns") != [BATCH]:
        raise ValueError(f"table '{table}' is not partitioned by {BATCH} alone, so it can't tell which batches it has")
    part = f"PARTITION ({BATCH} = {_literal(batch)})"
    if not spark.sql(f"SHOW PARTITIONS {table} {part}").isEmpty():
        return LoadResult(table, 0, 0, created)
    # Within the table's folder, so that it goes with the table, and hidden from those who list it.
    folder = f"{about['location']}/_batch-{uuid.uuid4().hex}"
    schema = StructType([field for field in spark.table(table).schema if field.name.lower() != BATCH])

    def place(work: str) -> None:
        spark.catalog.createTable(work, path=folder, source=about["provider"], schema=schema)

    def switch() -> bool:
        try:
            spark.sql(f"ALTER TABLE {table} ADD {part} LOCATION {_literal(folder)}")
        except AnalysisException as error:
            if error.getCondition() != "PARTITIONS_ALREADY_EXIST":
                raise
            return False
        return True

    loaded = _written(rows, table, folder, place, switch, gates)
    return LoadResult(table, 0, loaded, created)


def _replace(rows: DataFrame, table: str, batch: str, gates: tuple) -> LoadResult:
    spark = rows.sparkSession
    created = create_target(rows, table)
    about = _described(spark, table)
    if about.get("partition_columns"):
        raise ValueError(f"table '{table}' is partitioned, so its rows can't be switched in one step")
    old = about["location"]
    digest = hashlib.sha256(batch.encode()).hexdigest()[:32]
    tried = _TRY.search(old)
    if tried and tried[1] == digest:
        return LoadResult(table, 0, 0, created)
    removed = spark.table(table).count()
    folder = f"{_TRY.sub('', old)}-{digest}-{uuid.uuid4().hex}"

    def place(work: str) -> None:
        spark.sql(f"CREATE TABLE {work} LIKE {table} LOCATION {_literal(folder)}")

    def switch() -> bool:
        spark.sql(f"ALTER TABLE {table} SET LOCATION {_literal(folder)}")
        return True

    loaded = _written(rows, table, folder, place, switch, gates)
    if tried or about["type"] == "MANAGED":
        drop_work_folder(spark, old)
    return LoadResult(table, removed, loaded, created)


def _written(
    rows: DataFrame,
    target: str,
    folder: str,
    place: Callable[[str], None],
    switch: Callable[[], bool],
    gates: tuple[Mapping[str, str], bool, bool],
) -> int:
    """Write ``rows`` to ``folder`` in one pass, check what was seen in it, and switch; give the number of rows.

    ``place`` declares the table that the folder is written as, so that values are cast and refused as in any
    load. What fails before the switch takes the folder with it; one whose switch failed stays.
    """
    spark = rows.sparkSession
    conditions, nonempty, sized = gates
    counted, seen = observed(rows, conditions)
    work, staged, unused = new_work_table(spark, "batch"), None, True
    try:
        place(work)
        if sized:
            staged = new_work_table(spark, "load")
            counted.write.saveAsTable(staged)
            counted = repartition_by_files(spark, staged)
        aligned(counted, spark.table(work).columns, target).write.insertInto(work)
        counts = seen.get
        if nonempty and counts["rows"] == 0:
            raise CheckFailed(f"nothing to load into '{target}'")
        require_counts(target, {label: counts[f"c{i}"] for i, label in enumerate(conditions)})
        # Should the switch raise, the catalog may have done it all the same.
        unused = False
        unused = not switch()
        return 0 if unused else counts["rows"]
    finally:
        # The declared table is external: its files stay.
        drop_work_table(spark, work)
        if staged:
            drop_work_table(spark, staged)
        if unused:
            drop_work_folder(spark, folder)
