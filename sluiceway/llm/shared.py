"""Small helpers of the operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Hashable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.workspace import new_work_path

#: Texts are worked on in slices of about so many bytes, which bounds the memory of a Python worker.
SLICE_BYTES = 2 << 20


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared work folder and read it back: cuts lineage, survives lost executors."""
    path = new_work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterator[pa.RecordBatch], text: str, size: int = SLICE_BYTES, rows: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches into pieces of at most ``rows``, with about ``size`` bytes of text; a longer text stands alone."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths)
        begin = 0
        while begin < batch.num_rows:
            base = ends[begin - 1] if begin else 0
            end = max(begin + 1, min(begin + rows, int(np.searchsorted(ends, base + size, side="right"))))
            yield batch.slice(begin, end - begin)
            begin = end


def remainder(id_column: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % modulus


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, once for each Python worker: tasks are unpickled anew, so it is kept in a module of its own."""
    name = "_sluiceway_kept"
    values = vars(sys.modules.setdefault(name, types.ModuleType(name))).setdefault("values", {})
    if key not in values:
        values[key] = make()
    return values[key]
