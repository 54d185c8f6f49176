"""Mixing of sources to target weights by Pfair scheduling.

Each source is cut into blocks of equal byte length. With integer weights that add up to W, block k of a source of
weight w is released at slot floor(k W / w) and due at ceil((k + 1) W / w); in every slot the released block that is due
first goes next. The schedule repeats after W slots, in which each source has exactly w blocks, so one period per set of
sources still running is all the driver computes. A source that runs out leaves, and the others go on by their weights.
No row is dropped or repeated.

The driver schedules a bounded number of sources. All others are scheduled in groups by Spark tasks, the groups in groups
of their own until one is left, which the driver schedules like a source: a block's slot in its group is the number of the
group's block. So every source has its weight, and no two sources share a block.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import buckets_for, small_table, stored, text_of

BLOCK_BYTES = 65_536
PARTS = 1000
PHASE_COLUMNS = ["at", "length", "first", "count", "weight", "slots"]
MOST_SOURCES = 256  # that the driver schedules


def one_period(weights: dict[int, int]) -> dict[int, list[int]]:
    """The slots of each source in one period: earliest deadline first among released blocks."""
    length = sum(weights.values())
    waiting = [(0, source, 0) for source in weights]  # release, source, block
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []
    slots: dict[int, list[int]] = {source: [] for source in weights}
    for slot in range(length):
        while waiting and waiting[0][0] <= slot:
            _, source, k = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(k + 1) * length // weights[source]), source, k))
        _, source, k = heapq.heappop(ready)
        slots[source].append(slot)
        if k + 1 < weights[source]:
            heapq.heappush(waiting, ((k + 1) * length // weights[source], source, k + 1))
    return slots


@dataclass
class Phase:
    """What holds while the same sources run: block ``first`` of a source is the phase's block 0."""

    start: int
    length: int
    first: dict[int, int]
    count: dict[int, int]
    slots: dict[int, list[int]]


def phases(weights: dict[int, int], blocks: dict[int, int]) -> list[Phase]:
    """The schedule until every source has run out: at most one phase per source."""
    done = dict.fromkeys(weights, 0)
    start, found = 0, []
    while running := {s: w for s, w in weights.items() if done[s] < blocks[s]}:
        slots, length = one_period(running), sum(running.values())

        def slot_of(source: int, k: int) -> int:
            return k // running[source] * length + slots[source][k % running[source]]

        end = min(slot_of(s, blocks[s] - done[s] - 1) for s in running) + 1
        rounds, rest = divmod(end, length)
        count = {s: rounds * w + sum(x < rest for x in slots[s]) for s, w in running.items()}
        found.append(Phase(start, length, {s: done[s] for s in running}, count, slots))
        for s in running:
            done[s] += count[s]
        start += end
    return found


def tempered(sizes: dict, exponent: float = 0.5, parts: int = PARTS) -> dict:
    """Integer weights in proportion to a power of the sizes, each at least 1; finer for more sources."""
    powers = {k: max(v, 1) ** exponent for k, v in sizes.items()}
    parts = max(parts, 16 * len(powers))
    whole = sum(powers.values())
    return {k: max(1, round(parts * v / whole)) for k, v in powers.items()}


def _group_schedule(rows):
    """The phases of one group's members, by their powers."""
    import pandas as pd

    rows = rows.sort_values("key")
    weights = tempered(dict(zip(rows["key"], rows["power"], strict=True)), 1.0)
    blocks = {k: int(n) for k, n in zip(rows["key"], rows["blocks"], strict=True)}
    return pd.DataFrame(
        [(str(rows["group"].iloc[0]), s, p.start, p.length, p.first[s], p.count[s], weights[s], p.slots[s])
         for p in phases(weights, blocks) for s in p.first],
        columns=["group", "key", *PHASE_COLUMNS])


def _slot(block: str) -> Column:
    """The slot of a block within a phase's columns; null is possible for blocks of other phases, which Spark may try."""
    return F.expr(f"at + ({block} - first) div weight * length + get(slots, int(({block} - first) % weight))")


def _group_blocks(tail: DataFrame) -> DataFrame:
    """``key, block, place`` of all blocks of the sources in ``tail`` (``key, blocks, power``): its place among them all."""
    at = tail.select("key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    at = at.withColumns({"node": F.col("key"), "place": F.col("block")})
    nodes, count = tail, tail.count()
    while True:
        groups = 1 if count <= MOST_SOURCES else -(-count // max(1, MOST_SOURCES // 2))
        nodes = nodes.withColumn("group", F.pmod(F.xxhash64("key"), F.lit(groups)).cast("int"))
        plan = stored(nodes.groupBy("group").applyInPandas(
            _group_schedule, "group string, key string, at long, length long, first long, count long, weight long, "
                             "slots array<int>"), "mix-group").withColumnRenamed("key", "node")
        own = F.col("place") - F.col("first")
        at = (at.join(plan, "node").where((own >= 0) & (own < F.col("count")))
              .select("key", "block", F.col("group").alias("node"), _slot("place").cast("long").alias("place")))
        if groups == 1:
            return at.select("key", "block", "place")
        nodes = nodes.groupBy(F.col("group").cast("string").alias("key")).agg(
            F.sum("blocks").alias("blocks"), F.sum("power").alias("power"))
        count = nodes.count()


def mix(docs: DataFrame, weights: dict[str | None, int] | None = None, *, source_col: str = "source",
        id_col: str = "doc_id", size=None, block_bytes: int = BLOCK_BYTES, name: str = "mix") -> DataFrame:
    """The rows with a struct column ``name``: ``slot``, ``block``, ``start``, ``release``, ``deadline``, ``rank``.

    The mixed order is slot, then start, then rank. ``weights`` are integers by source, at most 1000 parts or so in
    all; by default they follow the square root of each source's bytes. Sources without a weight have a weight of 1
    together, and share it by the square root of their bytes. They, and by default all but the 256 largest sources, are
    scheduled in groups: ``release`` and ``deadline`` of their blocks are those of the groups' block in that slot.
    ``block`` and ``start`` are a source's own. Null is a source like any other. A text's size is its UTF-8 length plus 1
    (null: 1). Repeated rows are rows of their own. An existing column ``name`` is replaced. An empty table gives no rows.
    """
    spark = docs.sparkSession
    size = size if size is not None else F.octet_length(text_of()) + 1
    narrow = stored(docs.select(F.col(source_col).cast("string").alias("source"), size.cast("long").alias("size"),
                                F.xxhash64(F.col(id_col)).alias("hash")), "mix-rows")
    count = narrow.count()
    by_source = stored(narrow.groupBy("source").agg(F.sum("size").alias("bytes")), "mix-sources")
    if weights is None:
        largest = by_source.orderBy(F.desc("bytes"), F.col("source")).limit(MOST_SOURCES).collect()
        named = [r["source"] for r in largest]
    else:
        named = list(weights)
    known = small_table(spark, list(zip(named, range(1, len(named) + 1), strict=True)), "known string, number int")
    number = F.coalesce("number", F.lit(0))
    # A group member's key; the driver's sources need none.
    key = F.when(F.col("number").isNotNull(), "").otherwise(
        F.when(F.col("source").isNull(), "none").otherwise(F.concat(F.lit("="), "source")))
    nodes = (by_source.join(F.broadcast(known), F.col("source").eqNullSafe(F.col("known")), "left")
             .select(number.alias("number"), key.alias("key"), F.sqrt(F.greatest("bytes", F.lit(1))).alias("power"),
                     F.ceil(F.col("bytes") / F.lit(block_bytes)).cast("long").alias("blocks")))
    totals = {r["number"]: r for r in
              nodes.groupBy("number").agg(F.sum("power").alias("power"), F.sum("blocks").alias("blocks")).collect()}
    parts = tempered({i: r["power"] for i, r in totals.items()}, 1.0) if weights is None else {
        i: max(1, int(weights[named[i - 1]])) if i else 1 for i in totals}
    plan = phases(parts, {i: r["blocks"] for i, r in totals.items()})
    schedule = small_table(
        spark, [(s, p.start, p.length, p.first[s], p.count[s], parts[s], p.slots[s]) for p in plan for s in p.first],
        "number int, at long, length long, first long, count long, weight long, slots array<int>")

    buckets = buckets_for(count)
    bucket = F.pmod("hash", F.lit(buckets)).cast("int")
    numbered = narrow.join(F.broadcast(known), F.col("source").eqNullSafe(F.col("known")), "left")
    sums = (numbered.groupBy(number.alias("number"), key.alias("key"), bucket.alias("bucket"))
            .agg(F.sum("size").alias("bytes")))
    earlier = Window.partitionBy("number", "key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col("number").alias("_number"), F.col("key").alias("_key"), F.col("bucket").alias("_bucket"),
                          F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("_offset"))

    rows = (docs.drop(name).select(F.struct("*").alias("row"), F.col(source_col).cast("string").alias("source"),
                                   size.cast("long").alias("size"), F.col(id_col).alias("id"),
                                   F.xxhash64(F.col(id_col)).alias("hash"))
            .join(F.broadcast(known), F.col("source").eqNullSafe(F.col("known")), "left")
            .select("row", "id", "hash", "size", number.alias("number"), key.alias("key"), bucket.alias("bucket")))
    inside = Window.partitionBy("number", "key", "bucket").orderBy("hash", "id", "size")
    so_far = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = (rows.withColumns({"before": F.coalesce(F.sum("size").over(so_far), F.lit(0)),
                                "rank": F.row_number().over(inside)})
              .join(offsets, (F.col("number") == F.col("_number")) & (F.col("key") == F.col("_key"))
                    & (F.col("bucket") == F.col("_bucket")))
              .withColumn("start", F.col("_offset") + F.col("before"))
              .withColumn("block", F.floor(F.col("start") / F.lit(block_bytes)).cast("long")))
    alone = placed.withColumn("place", F.col("block"))
    if 0 in totals:
        grouped = _group_blocks(nodes.where("number = 0").select("key", "blocks", "power"))
        placed = alone.where("number <> 0").unionByName(placed.where("number = 0").join(grouped, ["key", "block"]))
    else:
        placed = alone
    own = F.col("place") - F.col("first")
    done = placed.join(F.broadcast(schedule.withColumnRenamed("number", "_source")),
                       (F.col("number") == F.col("_source")) & (own >= 0) & (own < F.col("count")))
    times = {"slot": _slot("place"),
             "release": F.expr("at + ((place - first) * length) div weight"),
             "deadline": F.expr("at + ((place - first + 1) * length + weight - 1) div weight")}
    info = F.struct(*[v.cast("long").alias(k) for k, v in times.items()], "block", "start", "rank")
    return done.select("row.*", info.alias(name))


def in_mixed_order(mixed: DataFrame, name: str = "mix") -> DataFrame:
    """The rows in mixed order, over as many tasks as Spark's setting asks for, without the struct."""
    order = [F.col(f"{name}.slot"), F.col(f"{name}.start"), F.col(f"{name}.rank")]
    return mixed.repartitionByRange(*order).sortWithinPartitions(*order).drop(name)


def row_place(docs: DataFrame, name: str = "place") -> DataFrame:
    """The rows with their place in the order of the files they are read from: file by file as written, row by row.

    Files count by the task that wrote them and by their turn there, as their names tell. A row number takes 40 bits and a
    file number 23. Rows that come from no files are counted as Spark hands them out. An existing column ``name`` is replaced.
    """
    file = F.col("_metadata.file_name")
    try:
        docs.select(file, "_metadata.row_index")
    except AnalysisException:
        return docs.withColumn(name, F.monotonically_increasing_id())
    part, turn = (F.regexp_extract("file", rule, 1).try_cast("long") for rule in (r"^part-(\d+)", r"-c(\d+)\."))
    order = Window.orderBy(F.coalesce(part, F.lit(0)), F.coalesce(turn, F.lit(0)), "file")  # one row per file
    files = docs.select(file.alias("file")).distinct().select(F.col("file").alias("__file"), F.row_number().over(order).alias("__number"))
    named = docs.withColumns({"__name": file, "__row": F.col("_metadata.row_index")}).drop(name)
    place = F.shiftleft(F.col("__number").cast("long"), 40) + F.col("__row")
    return (named.join(F.broadcast(files), F.col("__name") == F.col("__file")).withColumn(name, place)
            .drop("__name", "__row", "__file", "__number"))
