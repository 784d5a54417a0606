"""Near-duplicate groups by SimHash, found by a grid range-join of segment popcounts."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .shared import saved, slices

SHINGLE_WORDS = 4
MAX_DISTANCE = 4
SEED = 42
#: Slabs that the 32 segments of two bits are dealt to; pairs within MAX_DISTANCE share three whole slabs.
SLABS = MAX_DISTANCE + 3


def fingerprint(words: list[bytes], width: int = SHINGLE_WORDS) -> int:
    """SimHash of the words' shingles as a signed 64-bit number."""
    import numpy as np
    import xxhash

    if not words:
        return 0
    digest, text = xxhash.xxh64_intdigest, b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    ends = ends[min(width, len(words)) - 1 :].tolist()
    n, set_bits = len(ends), np.zeros(64, np.int64)
    for at in range(0, n, 65536):  # bounds the memory of one very long text
        part = [digest(text[i:j], SEED) for i, j in zip(starts[at : at + 65536], ends[at : at + 65536])]
        hashes = np.fromiter(part, np.uint64, len(part))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp) for every row; A-Z lower-cased, words are separated by 0x20 and 0x09-0x0D."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values = [fingerprint((x.as_py() or "").encode().lower().split(), width) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values, pa.int64())], ["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def segment_counts(fp: Column) -> Column:
    """Ones in each segment of two bits, written in unary (0: 00, 1: 01, 2: 11).

    Two such numbers differ in as many bits as the Manhattan distance of the counts.
    """
    odd = F.lit(0x5555555555555555)
    high = F.shiftrightunsigned(fp, 1)
    return fp.bitwiseOR(high).bitwiseAND(odd).bitwiseOR(F.shiftleft(fp.bitwiseAND(high).bitwiseAND(odd), 1))


def _slab_masks() -> list[int]:
    """The bits of each slab: the segments, dealt evenly."""
    masks = [0] * SLABS
    for segment in range(32):
        masks[segment * SLABS // 32] |= 3 << (2 * segment)
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def near_pairs(nodes: DataFrame) -> DataFrame:
    """(fp) distinct to the pairs (src, dst), src < dst, that differ in at most MAX_DISTANCE bits; each pair once.

    The grid has a dimension for each of the 32 segments. Counts within a Manhattan distance of 4 differ in
    4 of the 7 slabs of dimensions at most, so such points lie in one cell of the grid's projection on
    three of the slabs. Cells are joined by equality; a pair counts in the first projection where it meets;
    the Manhattan distance, which can't exceed that of the fingerprints, is tested before the exact one.
    Spark sizes a side by the table before each row becomes 35, so it is told not to broadcast one.
    """
    masks = _slab_masks()
    cells = []
    for chosen in combinations(range(SLABS), 3):
        mask = sum(masks[j] for j in chosen)
        skipped = sum(1 << j for j in range(chosen[-1]) if j not in chosen)
        cells.append(F.struct(F.col("counts").bitwiseAND(mask).alias("cell"), F.lit(sum(1 << j for j in chosen)).alias("slabs"), F.lit(skipped).alias("skipped")))
    placed = nodes.select("fp", segment_counts(F.col("fp")).alias("counts")).select("fp", "counts", F.inline(F.array(*cells)))
    a = placed.select(F.col("fp").alias("src"), F.col("counts").alias("a"), "cell", "slabs", "skipped")
    b = placed.select(F.col("fp").alias("dst"), F.col("counts").alias("b"), "cell", "slabs")
    apart = F.col("a").bitwiseXOR(F.col("b"))
    agreeing = sum((F.when(apart.bitwiseAND(m) == 0, 1 << j).otherwise(0) for j, m in enumerate(masks)), F.lit(0))
    near = (
        (F.col("src") < F.col("dst"))
        & (F.bit_count(apart) <= MAX_DISTANCE)
        & (F.bit_count(F.col("src").bitwiseXOR(F.col("dst"))) <= MAX_DISTANCE)
        & (agreeing.bitwiseAND(F.col("skipped")) == 0)
    )
    return a.hint("merge").join(b.hint("merge"), ["cell", "slabs"]).where(near).select("src", "dst")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Near-duplicate groups of ``docs``: (doc_id, fingerprint, component_id), one row per row of ``docs``.

    Equal fingerprints are one node of the graph, so groups of exact copies cost one row each in the join.
    component_id is the smallest doc_id in the group. Null and empty texts have fingerprint zero and link
    like any other. A null doc_id gets its row and never counts as the smallest; where a group has no other
    id, its component_id is null. Other columns are ignored, whatever their names; an empty table gives none.
    """
    rows = saved(fingerprints(docs, id_col, text_col), "fingerprints")
    nodes = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    linked = connected_components(near_pairs(nodes.select("fp")))
    named = nodes.join(linked, nodes.fp == linked.node, "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    named = saved(named, "classes")
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = saved(named.join(smallest, "component").select("fp", "component_id"), "classes")
    return rows.join(classes, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", groups=simhash_groups) -> DataFrame:
    """One row of each near-duplicate group of ``docs``, that with the smallest id, with the columns of ``docs``.

    ``groups`` is the function that finds the groups, (doc_id, component_id, ...) of each row. It is given a hash of id
    and text as the id, so that rows without an id, or with an id that others have too, are told apart.

    Rows without an id stay only where their group has no id at all, and then one of them. Of rows that repeat both
    id and text one stays.
    """
    names = (F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = docs.select(*names).select("*", F.xxhash64("id", "text").alias("row_key"))
    named = groups(rows, "row_key", "text").select(F.col("doc_id").alias("row_key"), "component_id").distinct()
    named = rows.groupBy("row_key", "id").count().join(named, "row_key")
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "row_key", "count")).alias("first")
    kept = saved(named.groupBy("component_id").agg(first).select(F.col("first.row_key").alias("__kept_key"), F.col("first.count").alias("__times")), "kept")
    key = F.xxhash64(docs[id_col].cast("long"), docs[text_col].cast("string"))
    stay = docs.join(kept, key == kept["__kept_key"], "left_semi")
    repeated = kept.where("__times > 1")
    if repeated.isEmpty():
        return stay
    # Only rows that are given several times are looked at again.
    again = docs.join(repeated.select("__kept_key"), key == F.col("__kept_key")).dropDuplicates(["__kept_key"])
    return docs.join(kept.where("__times = 1"), key == kept["__kept_key"], "left_semi").unionByName(again.drop("__kept_key"))
