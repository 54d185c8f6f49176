"""Sharding by longest-processing-time scheduling of groups that must stay together.

Equal texts form a group. Groups of at least ``1 / heavy_parts`` of a shard's share are scheduled one by one; there are
at most ``shards * heavy_parts`` of them. All other groups are bundled by their hash into a fixed number of bundles whose
sizes halve from level to level, so the schedule ends with bundles of a few groups and evens out what is left. The
driver only ever sees heavy groups and bundles, whatever the corpus.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import buckets_for, small_table, stored, text_of

LEVELS, PER_LEVEL, HEAVY_PARTS = 20, 128, 64


def longest_first(sizes: dict, shards: int) -> dict:
    """Item -> shard: the largest item first, each to the shard with the least load; ties go to the lower number."""
    heap = [(0, shard) for shard in range(shards)]
    placed = {}
    for item, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        load, shard = heapq.heappop(heap)
        placed[item] = shard
        heapq.heappush(heap, (load + size, shard))
    return placed


def lpt_shards(docs: DataFrame, shards: int = 16, *, id_col: str = "doc_id", text_col: str = "text",
               heavy_parts: int = HEAVY_PARTS) -> DataFrame:
    """One row per input row: id, ``size``, ``text_crc32``, ``shard`` and ``slot`` (gapless from 0 in each shard).

    Size is the UTF-8 length of the text plus 1. A null text is an empty one. Repeated rows are rows of their own and,
    having equal texts, share a shard. Slots follow a hash order; ties in it go by id. An empty table gives no rows.
    Columns of the input other than id and text are not read.
    """
    text = text_of(text_col)
    rows = stored(docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("crc"), F.xxhash64(text).alias("group")), "shards-rows")
    total, count = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    heavy_from = max(1, -(-total // (shards * heavy_parts)))

    # The level is the number of trailing zero bits, so each level holds half of what the one before holds.
    mixed = F.xxhash64("group", F.lit(7))
    level = F.least(F.lit(LEVELS - 1), F.length(F.regexp_extract(F.bin(mixed), "0*$", 0)))
    bundle = (level * PER_LEVEL + F.pmod(F.shiftright(mixed, 32), F.lit(PER_LEVEL))).cast("long")
    groups = rows.groupBy("group").agg(F.sum("size").alias("bytes"))
    heavy = F.col("bytes") >= heavy_from
    items = groups.groupBy(heavy.alias("heavy"), F.when(heavy, F.col("group")).otherwise(bundle).alias("item"))
    sizes = {(r["heavy"], r["item"]): r["bytes"] for r in items.agg(F.sum("bytes").alias("bytes")).collect()}
    placed = longest_first(sizes, shards)

    spark = docs.sparkSession
    alone = small_table(spark, [(k, s) for (h, k), s in placed.items() if h], "group long, alone int")
    bundled = small_table(spark, [(k, s) for (h, k), s in placed.items() if not h], "bundle long, bundled int")
    part = buckets_for(count // shards, 256)
    dealt = (rows.withColumn("bundle", bundle)
             .join(F.broadcast(alone), "group", "left").join(F.broadcast(bundled), "bundle", "left")
             .select("id", "size", "crc", F.coalesce("alone", "bundled").alias("shard"),
                     F.pmod(F.xxhash64("id", "crc"), F.lit(part)).alias("part")))
    offsets = dealt.groupBy("shard", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = offsets.select("shard", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "part").orderBy("id", "crc")
    return (dealt.join(offsets, ["shard", "part"])
            .select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard",
                    (F.col("offset") + F.row_number().over(inside) - 1).cast("long").alias("slot")))
