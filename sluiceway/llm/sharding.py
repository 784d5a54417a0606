"""Shards by consistent hashing with virtual nodes and bounded loads. DataFrame functions only."""

from __future__ import annotations

import bisect

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import saved

SHARDS = 24
#: Points of each shard on the ring.
VIRTUAL_NODES = 64
#: Arcs of equal length that the ring is cut into. Keys of an arc stay together.
ARCS = 1 << 16
#: A shard takes (1 + SLACK) times the mean load.
SLACK = 0.0002


def ring_points(spark, shards: int, virtual_nodes: int = VIRTUAL_NODES, arcs: int = ARCS) -> list[tuple[int, int]]:
    """(arc, shard) of every virtual node in order of the ring; their number is that of the parameters."""
    nodes = spark.range(shards * virtual_nodes).select((F.col("id") % shards).cast("int").alias("shard"), F.floor(F.col("id") / shards).cast("int").alias("node"))
    placed = nodes.select(F.pmod(F.xxhash64(F.lit("shard"), "shard", "node"), F.lit(arcs)).alias("arc"), "shard")
    return sorted(tuple(r) for r in placed.collect())


def bounded_owners(loads: dict[int, int], points: list[tuple[int, int]], shards: int, slack: float = SLACK) -> dict[int, int]:
    """The shard of each arc that has a load.

    An arc belongs to the first virtual node clockwise. Where that shard is full the arc goes on clockwise to
    the next shard with room; heavy arcs go first, since light ones fit anywhere. An arc for which no shard has
    room, because it outweighs what is left, goes to the shard with the least load.
    """
    capacity = (1 + slack) * sum(loads.values()) / shards
    arcs_of_points = [arc for arc, _ in points]
    filled, owners = [0] * shards, {}
    for arc in sorted(loads, key=lambda a: (-loads[a], a)):
        at = bisect.bisect_left(arcs_of_points, arc)
        for step in range(len(points)):
            shard = points[(at + step) % len(points)][1]
            if filled[shard] + loads[arc] <= capacity:
                break
        else:
            shard = min(range(shards), key=lambda s: (filled[s], s))
        filled[shard] += loads[arc]
        owners[arc] = shard
    return owners


def shard_by_bytes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, virtual_nodes: int = VIRTUAL_NODES, arcs: int = ARCS, slack: float = SLACK
) -> DataFrame:
    """(``id_col``, size, text_crc32, shard, slot) for every row, with nearly equal bytes in each shard.

    The place on the ring is a hash of id, text and size, so equal texts or ids do not gather. The driver sees
    the loads of the ring's arcs, ``arcs`` numbers whatever the input, and never a key. slot counts the rows of
    a shard from 0, by arc, id and text; it is numbered within arcs, so no task sees a whole shard. Null texts
    have size 8 and the checksum of the empty text; a null id is a value like any other; rows that repeat
    another take slots of their own. Other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("shard_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    rows = rows.withColumn("arc", F.pmod(F.xxhash64("shard_id", "text_crc32", "size"), F.lit(arcs)).cast("int"))
    rows = saved(rows, "sizes")
    totals = rows.groupBy("arc").agg(F.sum("size"), F.count("*")).collect()
    owners = bounded_owners({r[0]: r[1] for r in totals}, ring_points(spark, shards, virtual_nodes, arcs), shards, slack)
    first, used = {}, [0] * shards
    for arc, _, count in sorted(totals):
        first[arc] = used[owners[arc]]
        used[owners[arc]] += count
    # The arcs' shards and first slots, as one text for each: at most ``arcs`` rows.
    listed = sorted(owners)
    parts = [F.split(F.lit(",".join(map(str, x))), ",") for x in (listed, [owners[a] for a in listed], [first[a] for a in listed])]
    zipped = F.arrays_zip(*[p.alias(n) for p, n in zip(parts, ("a", "s", "f"))])
    placed = spark.range(1).select(F.inline(zipped)).toDF("arc", "shard", "first")
    placed = saved(placed.where("arc <> ''").select(F.col("arc").cast("int"), F.col("shard").cast("int"), F.col("first").cast("long")), "arcs")
    order = Window.partitionBy("arc").orderBy("shard_id", "text_crc32", "size")
    slots = rows.join(placed, "arc").withColumn("slot", F.col("first") + F.row_number().over(order) - 1)
    return slots.select(F.col("shard_id").alias(id_col), "size", "text_crc32", "shard", "slot")
