"""Balanced sharding by longest-processing-time scheduling.

Rows with equal text form a group that stays together.  Groups sorted by
size, largest first, go to the least loaded shard through a heap.

The heap needs few items at any scale: a group of at least ``1/items`` of all
bytes is an item of its own (there are at most ``items`` of those), all lighter
groups are gathered by hash into ``items`` bundles that are scheduled as one
item each.  So at most ``2 * items`` rows reach the driver whatever the
input's size, every group lies in exactly one item, and no bundle of light
groups can weigh much more than ``1/items`` of the total.  Slots are numbered
per partition and offset by a prefix sum, never in one task per shard.

Defined results: null text has size 1 and groups with empty text; repeated rows
share their shard and get slots of their own; an empty table gives no rows;
other input columns are ignored.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import rank_bases, with_local_ranks, written


def schedule(items: list[tuple[int, int, int]], shards: int) -> list[tuple[int, int, int]]:
    """``(kind, id, size)`` items to ``(kind, id, shard)``: largest first, each to
    the least loaded shard (ties: lower shard number)."""
    heap = [(0, s) for s in range(shards)]
    out = []
    for kind, key, size in sorted(items, key=lambda x: (-x[2], x[0], x[1])):
        load, shard = heapq.heappop(heap)
        heapq.heappush(heap, (load + size, shard))
        out.append((kind, key, shard))
    return out


def assign_shards(documents: DataFrame, shards: int = 16, items: int = 16384) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot (gapless from 0)."""
    spark = documents.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = written(documents.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64(text).alias("grp")), "sharding-rows")
    groups = written(rows.groupBy("grp").agg(F.sum("size").alias("size")), "sharding-groups")
    total = groups.agg(F.sum("size")).first()[0] or 0
    heavy = F.col("size") * items >= total
    item = groups.select(F.when(heavy, 0).otherwise(1).alias("kind"),
                         F.when(heavy, F.col("grp")).otherwise(F.pmod("grp", F.lit(items))).alias("id"), "size")
    sizes = item.groupBy("kind", "id").agg(F.sum("size").alias("size")).collect()   # at most 2 * items rows
    plan = spark.createDataFrame(schedule([tuple(r) for r in sizes], shards), "kind int, id long, shard int")
    own = F.broadcast(plan.where("kind = 0").select(F.col("id").alias("grp"), F.col("shard").alias("own")))
    bundle = F.broadcast(plan.where("kind = 1").select(F.col("id").alias("bundle"), F.col("shard").alias("shared")))
    placed = (rows.join(own, "grp", "left")
              .withColumn("bundle", F.pmod("grp", F.lit(items))).join(bundle, "bundle", "left")
              .select("doc_id", "size", "text_crc32", F.coalesce("own", "shared").alias("shard")))
    ranked = written(with_local_ranks(placed, "shard"), "sharding-ranked")
    return (ranked.join(rank_bases(ranked, "shard").drop("n"), ["shard", "part"])
            .select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("rank")).alias("slot")))
