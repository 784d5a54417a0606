"""Who owns work tables and folders, and when they go."""

import os
import threading

import pytest

from sluiceway.plans import run_job
from sluiceway.workspace import materialise, new_work_path, work_folder, work_scope


def files_under(path):
    return sorted(os.path.join(at, name) for at, _, names in os.walk(path) for name in names)


def test_a_scope_ends_with_its_tables_and_folders(spark):
    materialise(spark.range(3), "before")
    before = files_under(work_folder(spark))
    with work_scope(spark) as work:
        held = materialise(spark.range(5), "inside")
        path = new_work_path(spark, "files")
        spark.range(7).write.parquet(path)
        assert held.count() == 5 and len(work) == 1 and work.folders == [path]
        with work_scope(spark) as inner:
            materialise(spark.range(2), "innermost")
            assert len(inner) == 1 and len(work) == 1
        assert held.count() == 5
    assert files_under(work_folder(spark)) == before


def test_what_fails_leaves_nothing(spark):
    before = files_under(work_folder(spark))
    with pytest.raises(ValueError), work_scope(spark):
        materialise(spark.range(5), "lost")
        spark.range(7).write.parquet(new_work_path(spark, "lost"))
        raise ValueError
    assert files_under(work_folder(spark)) == before


def test_threads_own_what_they_make(spark):
    opened, ended, seen = threading.Event(), threading.Event(), {}

    def first():
        with work_scope(spark) as work:
            opened.wait(60)
            held = materialise(spark.range(4), "first")
            seen["owned"] = len(work)
            ended.wait(60)
            seen["rows"] = held.count()

    def second():
        with work_scope(spark) as work:
            opened.set()
            materialise(spark.range(6), "second")
            while "owned" not in seen and thread.is_alive():
                threading.Event().wait(0.05)
            seen["second"] = len(work)
        ended.set()

    thread = threading.Thread(target=first)
    other = threading.Thread(target=second)
    for t in (thread, other):
        t.start()
    for t in (thread, other):
        t.join(120)
    assert seen == {"owned": 1, "second": 1, "rows": 4}


def test_jobs_in_threads_keep_their_tables(spark):
    results = {}

    def job(name):
        steps = [{"name": f"thread_{name}", "query": f"SELECT id FROM range({name})", "table": True}]
        results[name] = run_job(spark, {"extract": steps})

    threads = [threading.Thread(target=job, args=(n,)) for n in (3, 5, 8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(120)
    assert {n: r.views[f"thread_{n}"].count() for n, r in results.items()} == {3: 3, 5: 5, 8: 8}
    tables = [t for r in results.values() for t in r.work_tables]
    assert len(set(tables)) == 3
    for r in results.values():
        r.release(spark)
    assert not any(spark.catalog.tableExists(t) for t in tables)
