from sluiceway.operators.batches import load_batch
from sluiceway.operators.checks import (
    CheckFailed,
    check_conditions,
    check_nonempty,
    check_outputs,
    require_conditions,
    require_nonempty,
    require_outputs,
)
from sluiceway.operators.joins import join
from sluiceway.operators.load import LoadResult, audited, create_target, load, load_external, reused
from sluiceway.operators.relational import grouped, ordered, union_distinct

__all__ = [
    "CheckFailed",
    "LoadResult",
    "audited",
    "check_conditions",
    "check_nonempty",
    "check_outputs",
    "create_target",
    "grouped",
    "join",
    "load",
    "load_batch",
    "load_external",
    "ordered",
    "require_conditions",
    "require_nonempty",
    "require_outputs",
    "reused",
    "union_distinct",
]
