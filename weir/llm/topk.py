"""Exact top-k search by inner product over norm buckets.

Each block groups its vectors by length, longest first. For a bucket, the query's lowest kept score gives a local
threshold on the cosine. Above 1 the bucket, and with it all shorter ones, cannot hold a better vector. Where lengths
differ within the bucket, vectors too short for the threshold are pruned; else each vector's coordinate at the query's
focus, its largest coordinate, bounds the cosine, which is held against the threshold for the vector's own length (below zero
a shorter vector needs less). What remains is verified by its product.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .grid import search_blocks, usable

NONE = -(1 << 62)
BUCKET = 256
SPREAD = 0.9  # of shortest to longest: below it, pruning by length


def _first(score: np.ndarray, place: np.ndarray, k: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` highest scores of each row, ties to the lower place; ids ascend, so places stand for them."""
    if np.abs(np.where(score == NONE, 0, score)).max(initial=0) < (1 << 61) // (n + 1):
        # One number orders by both, so that nothing needs to be sorted whole.
        keys = np.where(score == NONE, NONE, score * (n + 1) + (n - place))
        order = np.argpartition(-keys, k - 1, axis=1)[:, :k]
    else:
        order = np.lexsort((place, -score), axis=1)[:, :k]
    return np.take_along_axis(score, order, 1), np.take_along_axis(place, order, 1)


def _finder(k: int, bucket: int):
    def find(query_ids, queries, ids, vectors):
        lengths = np.sqrt((vectors * vectors).sum(axis=1))
        query_lengths = np.sqrt((queries * queries).sum(axis=1))
        focus = np.abs(queries).argmax(axis=1)
        peak = queries[np.arange(len(queries)), focus] / np.maximum(query_lengths, 1e-300)
        by_length = np.argsort(-lengths, kind="stable")
        n = len(ids)
        best, place = np.full((len(queries), k), NONE), np.full((len(queries), k), n)
        floor = np.full(len(queries), -np.inf)
        for first in range(0, n, bucket):
            part = by_length[first : first + bucket]
            longest, shortest = lengths[part[0]], lengths[part[-1]]
            reach = query_lengths * longest
            local = np.divide(floor, reach, out=np.where(floor > 0, np.inf, -np.inf), where=reach > 0)
            alive = np.nonzero(local <= 1 + 1e-9)[0]
            if not len(alive):
                continue
            if shortest < SPREAD * longest:
                least = np.divide(floor[alive], query_lengths[alive], out=np.full(len(alive), -np.inf),
                                  where=query_lengths[alive] > 0)
                keep = lengths[part][None, :] >= least[:, None] - 1e-6
            else:
                unit = vectors[part] / np.maximum(lengths[part], 1e-300)[:, None]
                there = np.clip(unit[:, focus[alive]].T, -1, 1)
                top = np.clip(peak[alive], -1, 1)[:, None]
                own = query_lengths[alive, None] * lengths[part][None, :]
                least = np.divide(floor[alive, None], own, where=own > 0,
                                  out=np.where(floor[alive, None] > 0, np.inf, -np.inf) + np.zeros_like(own))
                keep = top * there + np.sqrt(1 - top * top) * np.sqrt(1 - there * there) >= least - 1e-9
            keep &= query_ids[alive, None] != ids[part][None, :]
            if keep.mean() > 0.2:
                products = queries[alive] @ vectors[part].T
            else:
                a, b = np.nonzero(keep)
                products = np.zeros(keep.shape)
                products[a, b] = (queries[alive[a]] * vectors[part[b]]).sum(axis=1)
            scored = np.where(keep, products.astype(np.int64), NONE)
            merged = np.concatenate([best[alive], scored], axis=1), np.concatenate(
                [place[alive], np.broadcast_to(part, scored.shape)], axis=1)
            best[alive], place[alive] = _first(*merged, k, n)
            lowest = best[alive].min(axis=1)
            floor[alive] = np.where(lowest == NONE, -np.inf, lowest)
        row, column = np.nonzero(best != NONE)
        return [query_ids[row], ids[place[row, column]], best[row, column]]

    return find


def top_products(df: DataFrame, is_query: Column, k: int = 20, *, scale: int = 64, id_col: str = "vec_id",
                 vec_col: str = "embedding", bucket: int = BUCKET) -> DataFrame:
    """The ``k`` highest inner products of each query over ``floor(scale * x)``: ``query_id, rank, vec_id, score``.

    ``is_query`` is a condition on the column ``id``. Every row but those of the query's id is a candidate. Vectors that
    are null, empty or hold null or non-finite components, and rows without an id, take no part; an id repeated with one
    vector counts once; ties go to the smaller id. Vectors of other dimensions never meet. Products are exact while
    the sums of their absolute parts stay below 2^53. An empty table gives no rows. Other columns are not read.
    """
    rows = usable(df, id_col, vec_col).withColumn(
        "vec", F.transform("vec", lambda x: F.floor(x * scale).cast("double")))
    return search_blocks(rows, is_query, k, _finder(k, bucket), "long")
