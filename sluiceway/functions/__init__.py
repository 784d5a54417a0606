from sluiceway.functions.conform import WAREHOUSE_TYPES, conform, time_of_day
from sluiceway.functions.sizing import PARTITION_BYTES, file_bytes, repartition_by_files, repartition_by_size, size_report

__all__ = [
    "PARTITION_BYTES",
    "WAREHOUSE_TYPES",
    "conform",
    "file_bytes",
    "repartition_by_files",
    "repartition_by_size",
    "size_report",
    "time_of_day",
]
