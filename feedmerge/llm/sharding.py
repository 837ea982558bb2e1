"""Shards on a consistent-hash ring with virtual nodes and bounded loads.

The ring has ``SLOTS`` slots. Every shard owns ``nodes`` of them, its virtual nodes, and a
document begins at the slot its hashed id falls in. It belongs to the shard of the
first virtual node clockwise, unless that shard is full: then it goes on clockwise
to the next shard with room. Capacities are the count divided by the shards, with
the remainder given to the first shards, so all capacities are filled and counts
differ by at most one, while only the overflow leaves its home shard.

The law is ``rows``: shard counts are at most one apart. Because loads count, a
shard cannot follow from the id and the shard count alone, so ``grown_shard`` is
null.

Everything that grows with the input is a DataFrame operation: one aggregation
counts documents by slot, the overflow of the at most ``SLOTS`` counts is planned
on the driver, and a window inside each slot numbers its documents, so the planned
ranges give every document its shard and its place there. Slots are even, because
ids are hashed, and a slot holds one document in ``SLOTS``.

A null text has size 1 and the checksum of the empty text. A null id is placed by
the hash of its text. Rows with equal ids lie in one slot and are numbered by
checksum and size; equal rows are interchangeable.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SHARDS = 16
NODES = 64
SLOTS = 1 << 14
SEED = 42


def slot_of(hashed: Column, slots: int = SLOTS) -> Column:
    return F.pmod(hashed, F.lit(slots)).cast("int")


def virtual_nodes(spark: SparkSession, shards: int, nodes: int, slots: int, seed: int) -> dict[int, int]:
    """slot -> shard of every virtual node; the lower shard keeps a slot that two hit."""
    rows = (
        spark.range(shards * nodes)
        .select((F.col("id") % shards).cast("int").alias("shard"), (F.col("id") / shards).cast("int").alias("node"))
        .select("shard", slot_of(F.xxhash64(F.lit(seed), "shard", F.lit("node"), "node"), slots).alias("slot"))
        .groupBy("slot")
        .agg(F.min("shard").alias("shard"))
        .collect()
    )
    return {r.slot: r.shard for r in rows}


def plan_ranges(counts: dict[int, int], ring: dict[int, int], shards: int, slots: int) -> list[list[int]]:
    """[slot, first, last, shard, offset]: where ranks first..last-1 of each slot go.

    ``offset`` added to a rank gives the place in the shard. All documents first
    ask their home shard, in ring order; those that find it full ask the next
    different shard clockwise, all together, until everyone has a place.
    """
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    filled = [0] * shards
    spots = sorted(ring)
    clockwise = [ring[s] for s in spots]
    at, nodes = {}, len(spots)
    k = 0
    for slot in range(slots):
        while k < nodes and spots[k] < slot:
            k += 1
        if slot in counts:
            at[slot] = k % nodes
    asking = [(slot, 0, n, at[slot], frozenset()) for slot, n in sorted(counts.items())]
    placed = []
    while asking:
        later = []
        for slot, first, last, node, tried in asking:
            shard = clockwise[node]
            take = min(last - first, room[shard] - filled[shard])
            if take:
                placed.append([slot, first, first + take, shard, filled[shard] - first])
                filled[shard] += take
            if first + take < last:
                tried = tried | {shard}
                if len(tried) == shards:
                    raise AssertionError("the shards' capacities add up to all documents")
                while clockwise[node] in tried:
                    node = (node + 1) % nodes
                later.append((slot, first + take, last, node, tried))
        asking = later
    return placed


def keyed(docs: DataFrame, slots: int = SLOTS, seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, the ring position and its slot of every document."""
    text = F.coalesce("text", F.lit(""))
    position = F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit(seed), text)).otherwise(F.xxhash64(F.lit(seed), "doc_id"))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        position.alias("_position"),
    ).withColumn("_slot", slot_of(F.shiftrightunsigned("_position", 8), slots))


def assign_shards(
    docs: DataFrame, shards: int = SHARDS, nodes: int = NODES, slots: int = SLOTS, seed: int = SEED
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every document."""
    spark = docs.sparkSession
    rows = keyed(docs, slots, seed)
    # the slots need the ids only, so this pass leaves the texts unread
    ids = docs.select("doc_id", F.when(F.col("doc_id").isNull(), F.col("text")).alias("text"))
    counts = {r._slot: r["count"] for r in keyed(ids, slots, seed).groupBy("_slot").count().collect()}
    ranges = plan_ranges(counts, virtual_nodes(spark, shards, nodes, slots, seed), shards, slots)
    plan = spark.sql(
        "select inline(from_json(:ranges, 'array<struct<s:int,a:bigint,b:bigint,shard:int,o:bigint>>'))",
        args={"ranges": json.dumps([dict(zip(("s", "a", "b", "shard", "o"), r)) for r in ranges])},
    )
    order = Window.partitionBy("_slot").orderBy("_position", "doc_id", "text_crc32", "size")
    ranked = rows.withColumn("_rank", F.row_number().over(order) - 1)
    # at most one range for each slot, and one more for each time a shard fills up
    return ranked.join(
        F.broadcast(plan), (F.col("_slot") == F.col("s")) & (F.col("_rank") >= F.col("a")) & (F.col("_rank") < F.col("b"))
    ).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("_rank") + F.col("o")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
