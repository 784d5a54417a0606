"""SimHash groups against brute force over all pairs."""

import random

import xxhash
from corpora import SCHEMA, frame, hard_rows, words
from sluiceway.llm.components import connected_components
from sluiceway.llm.simhash import keep_one, near_pairs, segment_counts, simhash_groups


def brute_fingerprint(text):
    ws = (text or "").encode().lower().split()
    if not ws:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(ws[i : i + 4]), 42) for i in range(max(1, len(ws) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(rows):
    prints = [brute_fingerprint(r[1]) for r in rows]
    group = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (prints[i] ^ prints[j]).bit_count() <= 4 and group[i] > group[j]:
                    group[i], changed = group[j], True
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if group[j] == group[i] and rows[j][0] is not None]
        out.append((r[0], f"{prints[i]:016x}", min(ids, default=None)))
    return out


def test_hard_rows_with_clashing_columns(spark):
    rows = hard_rows()
    got = simhash_groups(frame(spark, rows, clashing=True)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute_groups(rows), key=repr)


def test_empty_table(spark):
    assert simhash_groups(spark.createDataFrame([], SCHEMA)).collect() == []


def test_near_pairs_find_every_pair_once(spark):
    rng = random.Random(5)
    prints = set()
    for _ in range(60):
        base = rng.getrandbits(64)
        for _ in range(4):
            flipped = base
            for _ in range(rng.randrange(7)):
                flipped ^= 1 << rng.randrange(64)
            prints.add(flipped - (1 << 64) if flipped >> 63 else flipped)
    expected = {(a, b) for a in prints for b in prints if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 4}
    got = [tuple(r) for r in near_pairs(spark.createDataFrame([(p,) for p in prints], "fp long")).collect()]
    assert len(got) == len(set(got)) and set(got) == expected and expected


def test_near_pairs_never_broadcast_the_cells(spark):
    # A table of 8 bytes a row looks small enough, but 35 cells a row are not.
    plan = near_pairs(spark.range(1000).withColumnRenamed("id", "fp"))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_manhattan_distance_is_a_lower_bound(spark):
    from pyspark.sql import functions as F

    rng = random.Random(6)
    numbers = [(rng.getrandbits(64) - (1 << 63), rng.getrandbits(64) - (1 << 63)) for _ in range(50)] + [(-1, 0), (5, 6)]
    df = spark.createDataFrame(numbers, "a long, b long")
    got = df.select("a", "b", F.bit_count(segment_counts(F.col("a")).bitwiseXOR(segment_counts(F.col("b")))).alias("d"))
    for a, b, d in got.collect():
        counts = [abs((a >> 2 * k & 3).bit_count() - (b >> 2 * k & 3).bit_count()) for k in range(32)]
        assert d == sum(counts) <= ((a ^ b) & (1 << 64) - 1).bit_count()


def test_one_of_each_group_stays(spark):
    rows = [(5, words(1, 300)), (3, words(1, 300) + " end"), (9, words(2, 50)), (1, None), (2, "")]
    kept = keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 9] and kept.columns == ["doc_id", "text"]


def test_one_of_each_group_stays_where_ids_are_missing_or_repeat(spark):
    a, b, c, d = (words(k, 300) for k in (1, 2, 3, 4))
    rows = [(7, a), (2, a + " end"), (7, b), (None, a), (None, c), (None, c), (None, c + " end"), (4, d), (4, d), (4, d), (9, d + " end")]
    kept = keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    # Of c any of the texts may stay, but one.
    assert sorted(map(tuple, (r for r in kept if r.doc_id is not None))) == [(2, a + " end"), (4, d), (7, b)]
    assert [r.text.startswith(c) for r in kept if r.doc_id is None] == [True]


def test_components_of_chains_stars_and_odd_edges(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, x) for x in range(101, 140)] + [(7, 7), (None, 3), (200, 201), (201, 200), (-5, 300)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200, -5: -5, 300: -5}
