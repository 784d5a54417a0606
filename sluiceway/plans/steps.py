"""Named SQL steps, each a view that later steps read, and jobs of extract, transform and load.

A view is lazy, so a chain of steps runs as one plan. A step that several others read can be written to
a table instead; a job does so by itself where several of its loads and checks would run the same step.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sluiceway.operators.checks import CheckFailed, require_counted
from sluiceway.operators.declared import load_item
from sluiceway.operators.load import LoadResult
from sluiceway.sources.queries import read_query
from sluiceway.sources.sectioned import load_bundle
from sluiceway.workspace import drop_work_folder, drop_work_table, new_work_table, work_scope


def run_step(spark: SparkSession, step: Mapping[str, Any], params: Mapping[str, Any] | None = None) -> DataFrame:
    """Evaluate ``step["query"]`` and register it as the view ``step["name"]``.

    With ``dynamic_variable_flag`` the query's ``:name`` markers are bound from ``params``; a table name
    goes in as ``IDENTIFIER(:name)``. With ``format`` and ``options`` a connector runs the query. With
    ``table`` the result is written to that table, or with ``table: True`` to a work table, and the view
    reads it from there.
    """
    name, query = step["name"], step["query"]
    args = None
    if step.get("dynamic_variable_flag"):
        if params is None:
            raise ValueError(f"step '{name}' needs params")
        args = dict(params)
    try:
        df = read_query(spark, query, step.get("format"), args, **step.get("options") or {})
    except AnalysisException as error:
        if args is not None and error.getCondition() == "UNBOUND_SQL_PARAMETER":
            missing = error.getMessageParameters()["name"]
            raise ValueError(f"step '{name}' needs the parameter '{missing}'") from error
        raise
    table = step.get("table")
    if table:
        table = new_work_table(spark, name) if table is True else table
        df.write.mode("overwrite").saveAsTable(table)
        df = spark.table(table)
    df.createOrReplaceTempView(name)
    return df


def run_steps(
    spark: SparkSession,
    steps: Sequence[Mapping[str, Any]],
    params: Mapping[str, Any] | None = None,
    validated: bool = False,
) -> dict[str, DataFrame]:
    """Run steps in the given order; the first failure ends the run.

    ``validated`` registers each result as ``validated_<name>`` too.
    """
    if not steps:
        raise ValueError("no steps to run")
    results = {}
    for step in steps:
        name = step["name"]
        results[name] = run_step(spark, step, params)
        if validated:
            results[f"validated_{name}"] = results[name]
            results[name].createOrReplaceTempView(f"validated_{name}")
    missing = [name for name in results if not spark.catalog.tableExists(name)]
    if missing:
        raise CheckFailed(f"views were not created: {', '.join(missing)}")
    return results


def _views_read(df: DataFrame) -> set[str]:
    """Names of the temporary views that the query itself names, not those that these read in turn."""
    found, todo = set(), [df._jdf.queryExecution().analyzed()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "View":
            found.add(node.desc().identifier().table().lower())
            continue
        for more in (node.children(), node.subqueries()):
            todo += [more.apply(i) for i in range(more.size())]
    return found


def _runs(reads: Sequence[set[int]], used: Sequence[int], fixed: set[int]) -> list[int]:
    """How often each step would run: once for each use and for each run of a later step that reads it.

    A step that would run more than once is taken to be written, so what it reads runs for it once. ``fixed``
    are written already.
    """
    runs = list(used)
    for step in reversed(range(len(reads))):
        for source in reads[step] if step not in fixed else ():
            runs[source] += min(runs[step], 1)
    return runs


def _storable(df: DataFrame) -> bool:
    names = [name.lower() for name in df.columns]
    return len(set(names)) == len(names) and not any("void" in kind or kind == "interval" for _, kind in df.dtypes)


def _write_shared(
    spark: SparkSession,
    steps: Sequence[tuple[Mapping[str, Any], Mapping[str, Any] | None, bool]],
    made: Sequence[DataFrame],
    used: Mapping[str, int],
) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """Write the steps that ``used`` names and later steps would run more than once; build what reads them anew.

    ``steps`` are (step, params, validated) as they were run, ``made`` their results. Gives the new views and the
    number of rows of those written, counted while they were.
    """
    place: dict[str, int] = {}
    reads = []
    for i, ((step, _, validated), df) in enumerate(zip(steps, made)):
        reads.append({place[name] for name in (_views_read(df) if not step.get("table") else ()) if name in place})
        for name in (step["name"], f"validated_{step['name']}")[: 1 + validated]:
            place[name.lower()] = i
    wanted = [0] * len(steps)
    for name, times in used.items():
        if name.lower() in place:
            wanted[place[name.lower()]] += times
    runs = _runs(reads, wanted, {i for i, (step, *_) in enumerate(steps) if step.get("table")})
    views, counts, changed = {}, {}, set()
    for i, (step, params, validated) in enumerate(steps):
        # A step may opt out with ``"table": False``.
        write = runs[i] > 1 and "table" not in step and _storable(made[i])
        if not write and not reads[i] & changed:
            continue
        df = run_step(spark, step, params) if reads[i] & changed else made[i]
        names = (step["name"], f"validated_{step['name']}")[: 1 + validated]
        if write:
            seen, table = Observation(), new_work_table(spark, step["name"])
            df.observe(seen, F.count(F.lit(1)).alias("rows")).write.saveAsTable(table)
            df = spark.table(table)
            counts.update(dict.fromkeys(names, seen.get["rows"]))
        changed.add(i)
        for name in names:
            if place[name.lower()] == i:
                df.createOrReplaceTempView(name)
                views[name] = df
    return views, counts


@dataclass(frozen=True)
class JobResult:
    """The views of a job by name, what its loads did, and the work tables and folders that the views read."""

    views: dict[str, DataFrame]
    loads: list[LoadResult] = field(default_factory=list)
    work_tables: list[str] = field(default_factory=list)
    work_folders: list[str] = field(default_factory=list)

    def release(self, spark: SparkSession) -> None:
        """Drop the work tables; views that read them can't be used any more."""
        while self.work_tables:
            drop_work_table(spark, self.work_tables.pop())
        while self.work_folders:
            drop_work_folder(spark, self.work_folders.pop())


def run_job(
    spark: SparkSession,
    config: Mapping[str, Any],
    params: Mapping[str, Any] | None = None,
    inputs: Mapping[str, str] | None = None,
    types: Mapping[str, Mapping[str, str]] | None = None,
) -> JobResult:
    """Run ``extract``, ``transform`` and ``load`` of a config, in this order.

    A phase that is absent is skipped; one that is there but empty is an error. The config's own
    ``dynamic_params`` (extract) and ``params`` (transform) come on top of ``params``. ``outputs`` names views
    that must have rows before anything is loaded.

    A step that several loads or checks of outputs would run, each through the views between, is written to a work table
    once, unless it says ``"table": False``; rows of a checked step that is written are counted in that pass.

    ``inputs`` are sectioned texts to register first, with ``types`` for their columns. Each load item
    names a ``dataframe_name``, a ``table_name`` and optionally a ``load_type``, ``conditions``, ``sized``,
    ``batch``, and ``format`` with ``options`` of a connector; a load of an empty DataFrame, or of one that breaks a
    condition, fails and changes nothing. Work tables go if the job fails; otherwise the result owns them.
    """
    if not {"extract", "transform", "load"} & set(config):
        raise ValueError("a job needs extract, transform or load")

    def given(key: str) -> dict[str, Any] | None:
        both = {**(params or {}), **(config.get(key) or {})}
        return both if params is not None or key in config else None

    with work_scope(spark) as work:
        views = load_bundle(spark, inputs, types) if inputs else {}
        steps = []
        for phase, key, validated in (("extract", "dynamic_params", True), ("transform", "params", False)):
            if phase in config:
                views |= run_steps(spark, config[phase], given(key), validated)
                steps += [(step, given(key), validated) for step in config[phase]]
        outputs = config.get("outputs", ())
        used = Counter([*outputs, *(item["dataframe_name"] for item in config.get("load", ()))])
        counts = {}
        if used.total() > 1:
            shared, counts = _write_shared(spark, steps, [views[step["name"]] for step, *_ in steps], used)
            views |= shared
        if "outputs" in config:
            require_counted(spark, outputs, counts)
        loads = [
            load_item(
                spark.table(item["dataframe_name"]),
                item["table_name"],
                item,
                conditions=item.get("conditions"),
                nonempty=True,
                sized=item.get("sized", False),
            )
            for item in config.get("load", ())
        ]
        result = JobResult(views, loads, list(work), list(work.folders))
        work.clear()
    return result
