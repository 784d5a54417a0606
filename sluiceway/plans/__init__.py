from sluiceway.plans.spec import SpecError, check_spec, query_from_spec, stage_from_spec
from sluiceway.plans.steps import JobResult, run_job, run_step, run_steps

__all__ = [
    "JobResult",
    "SpecError",
    "check_spec",
    "query_from_spec",
    "run_job",
    "run_step",
    "run_steps",
    "stage_from_spec",
]
