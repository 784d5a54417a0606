"""Work tables: intermediate results that later jobs read back.

They live in the shared folder that ``spark.checkpoint.dir`` names, so they survive the loss of an
executor, and in a database of their own, so ``DROP TABLE`` removes the files as well.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


_own_folders: dict[str, str] = {}


def work_folder(spark: SparkSession) -> str:
    """The shared folder for work tables: ``spark.checkpoint.dir``, or the context's checkpoint folder.

    A session on one machine that has neither gets a temporary folder. On a cluster that is an error, because
    a folder on one machine is not visible to the others. A ``file:`` folder is taken to be a mounted share.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _own_folders:
        _own_folders[app] = tempfile.mkdtemp(prefix="sluiceway-")
    return _own_folders[app]


def work_database(spark: SparkSession) -> str:
    """Database of this application's work tables, created on first use."""
    app = re.sub(r"\W", "_", spark.sparkContext.applicationId).lower()
    database = f"sluiceway_{app}"
    if not spark.catalog.databaseExists(database):
        location = f"{work_folder(spark).rstrip('/')}/{database}".replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    return database


class Work(list):
    """The work tables that a scope owns, by name; ``folders`` holds its folders."""

    def __init__(self) -> None:
        super().__init__()
        self.folders: list[str] = []

    def clear(self) -> None:
        """Leave everything to someone else."""
        super().clear()
        self.folders.clear()


#: What the innermost scope of the running thread owns.
_scope: ContextVar[Work | None] = ContextVar("work_scope", default=None)


@contextmanager
def work_scope(spark: SparkSession) -> Iterator[Work]:
    """Work tables and folders that are made inside the block go at its end; so use their results within it.

    The scope is that of the running thread: what another thread makes meanwhile is not touched.
    """
    work = Work()
    token = _scope.set(work)
    try:
        yield work
    finally:
        _scope.reset(token)
        for table in work:
            drop_work_table(spark, table)
        for folder in work.folders:
            drop_work_folder(spark, folder)


def new_work_path(spark: SparkSession, label: str) -> str:
    """A folder for files that are not a table, next to the work tables; the innermost :func:`work_scope` owns it."""
    path = f"{work_folder(spark).rstrip('/')}/{work_database(spark)}/{label}-{uuid.uuid4().hex}"
    if (work := _scope.get()) is not None:
        work.folders.append(path)
    return path


def new_work_table(spark: SparkSession, label: str) -> str:
    """A name for a work table that no other call gets; the innermost :func:`work_scope` owns it."""
    label = re.sub(r"\W", "_", label).lower()
    table = f"{work_database(spark)}.{label}_{uuid.uuid4().hex}"
    if (work := _scope.get()) is not None:
        work.append(table)
    return table


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a work table once and read it back from there."""
    table = new_work_table(df.sparkSession, label)
    df.write.saveAsTable(table)
    return df.sparkSession.table(table)


def drop_work_table(spark: SparkSession, table: str) -> None:
    """Drop one work table and its files."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def drop_work_folder(spark: SparkSession, path: str) -> None:
    """Remove a work folder with all its files, through the file system that it is on."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def drop_work(spark: SparkSession) -> None:
    """Drop every work table and work folder of this application."""
    spark.sql(f"DROP DATABASE IF EXISTS {work_database(spark)} CASCADE")
