"""Blocks of queries against blocks of vectors, and the best of what the blocks give.

Vectors are dealt by a hash of their id, so blocks stay even when one vector is very common.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BLOCK = 4096
QUERIES_PER_BLOCK = 1024
LEAST_BLOCKS = 24


def usable(df: DataFrame, id_col: str, vec_col: str, kind: str = "double") -> DataFrame:
    """``id, vec, dim``, each pair of id and vector once; without null ids and null, empty or non-finite vectors."""
    vec = F.col(vec_col).cast(f"array<{kind}>")
    good = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (df.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec"))
            .where(F.col("id").isNotNull() & (F.size("vec") > 0) & good)
            .dropDuplicates(["id", "vec"]).withColumn("dim", F.size("vec")))


def search_blocks(rows: DataFrame, is_query: Column, k: int, find: Callable, kind: str, *,
                  rows_per_block: int = ROWS_PER_BLOCK, queries_per_block: int = QUERIES_PER_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best of each query, ties to the smaller id.

    ``find(query ids, queries, ids, vectors)`` gives arrays of query ids, ids and scores holding at least the block's
    ``k`` best of each query, never a pair of one id. Only vectors of one dimension meet.
    """
    count, asked = rows.select(F.count("*"), F.count_if(is_query)).first()
    across = max(LEAST_BLOCKS, -(-count // rows_per_block))
    down = max(1, -(-asked // queries_per_block))
    block = F.pmod(F.xxhash64("id"), F.lit(across)).cast("int")
    turn = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(down)).cast("int")
    one = rows.select("id", "vec", "dim", block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(down - 1))).alias("turn"))
    many = rows.where(is_query).select("id", "vec", "dim", F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("block"),
                                       turn.alias("turn"))
    keys = ["dim", "block", "turn"]

    def meet(left, right):
        import numpy as np
        import pyarrow as pa

        queries, vectors = _arrays(left), _arrays(right)
        found = find(*queries, *vectors) if len(queries[0]) and len(vectors[0]) else [np.zeros(0, "i8")] * 3
        return pa.table({"query_id": pa.array(found[0], pa.int64()), "vec_id": pa.array(found[1], pa.int64()),
                         "score": pa.array(found[2], pa.int64() if kind == "long" else pa.float64())})

    pairs = many.groupBy(keys).cogroup(one.groupBy(keys)).applyInArrow(
        meet, f"query_id long, vec_id long, score {kind}")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _arrays(table):
    import numpy as np

    ids = table.column("id").combine_chunks().to_numpy(zero_copy_only=False)
    flat = table.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    order = np.argsort(ids, kind="stable")
    return ids[order], flat.reshape(len(ids), -1)[order] if len(ids) else np.zeros((0, 0))
