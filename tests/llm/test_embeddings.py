"""Linked vectors against brute force over all pairs."""

import numpy as np
import pytest
from sluiceway.llm.embeddings import near_vectors

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, threshold=0.95):
    usable = [v is not None and i is not None and all(x is not None and np.isfinite(x) for x in v) and any(v) for i, v in rows]
    x = [np.array(v, np.float32).astype(float) if u else None for (_, v), u in zip(rows, usable)]
    near = [[u and w and i != j and len(x[i]) == len(x[j]) and x[i] @ x[j] / (np.linalg.norm(x[i]) * np.linalg.norm(x[j])) >= threshold for j, w in enumerate(usable)] for i, u in enumerate(usable)]
    group = [i for i, _ in rows]
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if near[i][j] and group[j] < group[i]:
                    group[i], changed = group[j], True
    return sorted(((rows[i][0], sum(near[i]), group[i], rows[i][0] == group[i]) for i in range(len(rows))), key=repr)


def hard_vectors():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(12, 8))
    rows = [(i, (base[i % 12] + rng.normal(size=8) * (0.05 + 0.02 * (i % 5))).tolist()) for i in range(150)]
    rows += [(200 + i, base[0].tolist()) for i in range(30)] + [(300, (base[0] * 3).tolist()), (301, (base[0] * 1e-30).tolist())]
    rows += [(400, None), (401, [0.0] * 8), (402, [float("nan")] * 8), (403, [None] + [1.0] * 7), (404, [float("inf")] + [1.0] * 7), (405, [1.0, 2.0]), (406, []), (407, [1.0, 2.01]), (408, [-2.0, 1.0]), (409, [5.0]), (410, [7.0]), (411, [-7.0]), (None, base[1].tolist()), (7, base[1].tolist())]
    return rows


@pytest.mark.parametrize("tile", [1024, 16])
def test_hard_vectors_with_clashing_columns(spark, tile):
    from pyspark.sql import functions as F

    rows = hard_vectors()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).select("*", *[F.lit("own").alias(c) for c in ("id", "v", "unit", "tile", "links", "usable", "group", "label")])
    got = near_vectors(df, tile=tile).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)
    assert max(r.n_links for r in got) > 30


@pytest.mark.parametrize("tile", [1024, 8])
def test_lengths_of_about_equal_share(spark, tile):
    rng = np.random.default_rng(11)
    base = {n: rng.normal(size=(5, n)) for n in (2, 5, 8, 40)}
    rows = [(i, (base[n][i % 5] + rng.normal(size=n) * 0.1).tolist()) for i, n in enumerate(rng.choice(list(base), 140))]
    got = near_vectors(spark.createDataFrame(rows, SCHEMA), tile=tile).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)
    lengths = {i: len(v) for i, v in rows}
    assert {lengths[r.vec_id] for r in got if r.n_links} == set(base)


def test_empty_and_unusable_tables(spark):
    assert near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []
    got = near_vectors(spark.createDataFrame([(1, None), (2, [0.0])], SCHEMA)).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_work_files_stay_near_the_size_of_the_vectors(spark):
    import os

    from sluiceway.workspace import work_scope

    rng = np.random.default_rng(9)
    base = rng.normal(size=(20, 64))
    rows = [(i, (base[i % 20] + rng.normal(size=64)).tolist()) for i in range(3000)]
    with work_scope(spark) as work:
        got = near_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3), tile=64).collect()
        sizes = [os.path.getsize(os.path.join(at, f)) for folder in work.folders for at, _, files in os.walk(folder.removeprefix("file:")) for f in files]
    assert len(got) == 3000
    # Of 256 bytes a vector. Before, vectors were written five times over, at twice their width.
    assert sum(sizes) < 3 * 3000 * 256


def test_a_dense_group_across_blocks_with_copies(spark):
    rng = np.random.default_rng(12)
    base = rng.normal(size=30)
    rows = [(i, (base + rng.normal(size=30) * 0.2).tolist()) for i in range(60)]
    rows += [(100 + i, (-2.0 * np.array(rows[i % 7][1])).tolist()) for i in range(40)] + [(200 + i, rows[3][1]) for i in range(20)]
    got = near_vectors(spark.createDataFrame(rows, SCHEMA).repartition(5), tile=8).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)
