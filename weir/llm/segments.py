"""Hard negatives by segment summaries that bound scores.

A vector's summary holds the mean and deviation of each of its segments. Over a segment of n components the product of two
vectors lies within ``n * mean * mean`` plus or minus ``deviation * deviation``, so summaries bound the whole score from both
sides. Bounds start at one segment, segments are halved down to ``LEAVES`` of them, then one leaf after the other (those that
vary most first) is refined to its components, whose deviation is zero. A pair leaves as soon as its bounds miss every interval
its anchor asks for; what is left gets its exact score in whole numbers.

Anchors and vectors meet in blocks, dealt by a hash of the id. Each block raises its anchors' lower bounds as it finds better
vectors; all blocks start from the bounds that one sample of all rows gives. The bounds only save work.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

ROWS_PER_BLOCK = 16_384
ANCHORS_PER_BLOCK = 4_096
LEAST_BLOCKS = 24  # so that small tables use all cores
SAMPLE = 1_024  # rows the first bounds come from
LEAVES = 8
TILE = 1_024
PAIRS = 1 << 18  # scored at once
MOST = 1 << 62  # no score lies beyond
FOUND = pa.schema([(name, pa.int64()) for name in ("anchor_id", "low", "high", "vec_id", "score")])


class Summaries:
    """Means and deviations of the segments of vectors, level by level."""

    def __init__(self, vectors: np.ndarray):
        self.whole = vectors
        self.values = vectors.astype(np.float64)
        self.borders = [np.unique(np.linspace(0, vectors.shape[1], (1 << k) + 1).astype(int)) for k in range(LEAVES.bit_length())]
        self.levels = [self._level(b) for b in self.borders]

    def _level(self, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, size = borders[:-1], np.diff(borders)
        mean = np.add.reduceat(self.values, first, axis=1) / size
        apart = self.values - np.repeat(mean, size, axis=1)
        return mean * np.sqrt(size), np.sqrt(np.add.reduceat(apart * apart, first, axis=1))

    def rows(self, part: np.ndarray) -> Summaries:
        out = object.__new__(Summaries)
        out.whole, out.values, out.borders = self.whole[part], self.values[part], self.borders
        out.levels = [(m[part], d[part]) for m, d in self.levels]
        return out


def _refined(a: Summaries, b: Summaries):
    """Centre and spread of the bounds of all pairs, finer by the step."""
    for (mean_a, apart_a), (mean_b, apart_b) in zip(a.levels, b.levels):
        yield mean_a @ mean_b.T, apart_a @ apart_b.T
    (mean_a, apart_a), (mean_b, apart_b) = a.levels[-1], b.levels[-1]
    centre, spread, borders = mean_a @ mean_b.T, apart_a @ apart_b.T, a.borders[-1]
    order = np.argsort(-apart_a.mean(axis=0) * apart_b.mean(axis=0))
    for k in order[:-1]:
        leaf = slice(borders[k], borders[k + 1])
        centre += a.values[:, leaf] @ b.values[:, leaf].T - np.outer(mean_a[:, k], mean_b[:, k])
        spread -= np.outer(apart_a[:, k], apart_b[:, k])
        yield centre, spread


def best_within(a: Summaries, b: Summaries, allowed, low: np.ndarray, high: np.ndarray, k: int):
    """For each anchor and interval ``low <= score <= high`` the ``k`` best rows, ties to the earlier row, and how many pairs were scored.

    ``low`` and ``high`` are anchors by intervals; an interval with ``low > high`` asks for nothing. ``allowed(anchors, rows)``
    says which pairs may meet. Gives arrays of anchor, interval, row and score.
    """
    best = [np.zeros(0, np.int64)] * 4
    low, scored = low.copy(), 0
    error = 1e-9 * (1 + np.sqrt((a.values**2).sum(axis=1)).max(initial=0)) * (1 + np.sqrt((b.values**2).sum(axis=1)).max(initial=0))
    for first in range(0, len(b.whole), TILE):
        rows = np.arange(first, min(first + TILE, len(b.whole)))
        tile = b.rows(rows)
        for start in range(0, len(a.whole), TILE):
            anchors = np.arange(start, min(start + TILE, len(a.whole)))
            asks = low[anchors] <= high[anchors]
            least = np.where(asks, low[anchors], MOST).min(axis=1).astype(np.float64) - error
            most = np.where(asks, high[anchors], -MOST).max(axis=1).astype(np.float64) + error
            alive = allowed(anchors, rows) & asks.any(axis=1)[:, None]
            for centre, spread in _refined(a.rows(anchors), tile):
                if not alive.any():
                    break
                alive &= (centre + spread >= least[:, None]) & (centre - spread <= most[:, None])
            of, row = np.nonzero(alive)
            scored += len(of)
            of, row = anchors[of], rows[row]
            score = np.concatenate([np.zeros(0, np.int64), *[
                np.einsum("ij,ij->i", a.whole[of[p : p + PAIRS]], b.whole[row[p : p + PAIRS]]) for p in range(0, len(of), PAIRS)]])
            found = []
            for j in range(low.shape[1]):
                fits = (low[of, j] <= score) & (score <= high[of, j])
                found.append([of[fits], np.full(int(fits.sum()), j), row[fits], score[fits]])
            best = [np.concatenate(x) for x in zip(best, *found)]
            order = np.lexsort((best[2], -best[3], best[1], best[0]))
            best = [x[order] for x in best]
            change = np.append(True, (np.diff(best[0]) != 0) | (np.diff(best[1]) != 0))[: len(best[0])]
            turn = np.arange(len(change)) - np.maximum.accumulate(np.where(change, np.arange(len(change)), 0))
            best = [x[turn < k] for x in best]
            last = turn[turn < k] == k - 1
            low[best[0][last], best[1][last]] = best[3][last]
    return *best, scored


def _vectors(table, scale: int) -> np.ndarray:
    """Whole numbers; components beyond their range stay at its end."""
    flat = table.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.clip(np.floor(scale * flat), -(2.0**62), 2.0**62).astype(np.int64).reshape(table.num_rows, -1)


def _one_per_id(table):
    """Rows by id; of those with one id the one with the least label, then vector."""
    import pyarrow.compute as pc

    table = table.take(pc.sort_indices(table, [("id", "ascending"), ("label", "ascending")]))
    ids = table.column("id").to_numpy()
    if len(ids) == len(np.unique(ids)):
        return table
    keep, vectors = {}, table.column("vec")
    for i, key in enumerate(zip(ids.tolist(), table.column("label").to_pylist())):
        rank = (key[1], vectors[i].as_py())
        if key[0] not in keep or rank < keep[key[0]][0]:
            keep[key[0]] = rank, i
    return table.take([i for _, i in keep.values()])


def _met(left, right, k: int, same_label: bool, scale: int):
    """The best rows of each anchor's intervals among the rows of a block."""
    of, a_label = left.column("id").to_numpy(), left.column("label").to_numpy()
    ids, b_label = right.column("id").to_numpy(), right.column("label").to_numpy()
    bounds = left.column("asks").to_pylist()
    most = max(map(len, bounds))
    low, high = np.full((len(of), most), MOST), np.full((len(of), most), -MOST)
    for i, asks in enumerate(bounds):
        for j, ask in enumerate(asks):
            low[i, j], high[i, j] = ask["floor"], ask["high"]

    def allowed(a, b):
        return ((a_label[a][:, None] == b_label[b][None, :]) == same_label) & (of[a][:, None] != ids[b][None, :])

    anchor, interval, row, score, _ = best_within(
        Summaries(_vectors(left, scale)), Summaries(_vectors(right, scale)), allowed, low, high, k)
    asked = [bounds[i][j] for i, j in zip(anchor, interval)]
    return pa.table([of[anchor], np.array([a["low"] for a in asked], np.int64), np.array([a["high"] for a in asked], np.int64),
                     ids[row], score], schema=FOUND)


def _search(anchors: DataFrame, rows: DataFrame, k: int, same_label: bool, scale: int, across: int, down: int) -> DataFrame:
    """``anchor_id, low, high, vec_id, score``: at least the ``k`` best of each anchor's intervals within each block of rows."""

    def meet(left, right):
        import pyarrow.compute as pc

        left, right, found = left.sort_by("id"), _one_per_id(right), []
        for dim in pc.unique(left.column("dim")).to_pylist():
            some, others = (x.filter(pc.equal(x.column("dim"), dim)) for x in (left, right))
            if others.num_rows:
                found.append(_met(some, others, k, same_label, scale))
        return pa.concat_tables([*found, FOUND.empty_table()])

    block = F.pmod(F.xxhash64("id"), F.lit(across)).cast("int")
    turn = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(down)).cast("int")
    one = rows.select("*", block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(down - 1))).alias("turn"))
    many = anchors.select("*", F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("block"), turn.alias("turn"))
    keys = ["block", "turn"]
    return many.groupBy(keys).cogroup(one.groupBy(keys)).applyInArrow(
        meet, "anchor_id long, low long, high long, vec_id long, score long")


def _best(anchors: DataFrame, rows: DataFrame, sample: DataFrame, k: int, same_label: bool, scale: int, count: int,
          asked: int) -> DataFrame:
    """``anchor_id, low, high, rank, vec_id, score``: the ``k`` best of each anchor's intervals."""
    keys = ["anchor_id", "low", "high"]
    down = max(1, -(-asked // ANCHORS_PER_BLOCK))
    first = _search(_asking(anchors), sample, k, same_label, scale, 1, down)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")))
    floors = ranked.where(F.col("rank") == k).select(*keys, F.col("score").alias("floor"))
    wide = anchors.select("id", F.explode("asks").alias("ask")).select(
        F.col("id").alias("anchor_id"), "ask.low", "ask.high").join(floors, keys, "left")
    bounds = wide.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(
        F.struct("low", "high", F.coalesce("floor", "low").alias("floor"))).alias("asks"))
    across = max(LEAST_BLOCKS, -(-count // ROWS_PER_BLOCK))
    pairs = _search(anchors.drop("asks").join(bounds, "id"), rows, k, same_label, scale, across, down)
    best = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _asking(anchors: DataFrame) -> DataFrame:
    return anchors.withColumn("asks", F.transform("asks", lambda a: F.struct(a["low"], a["high"], a["low"].alias("floor"))))


def hard_negatives(df: DataFrame, is_anchor: Column, *, positives: int = 5, negatives: int = 5, share: tuple[int, int] = (80, 100),
                   scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                   label: Column | None = None) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` over ``floor(scale * x)``.

    ``is_anchor`` is a condition on the column ``id``. An anchor's positives are its first ``positives`` other rows of its
    label, by score, ties to the smaller id (all, if fewer). A positive's negatives are the first ``negatives`` of the rows of
    other labels whose score is at most the positive's and at least ``share[0]`` of ``share[1]`` parts of it. ``label`` may
    replace the label by an expression on ``id`` and ``label``.

    Rows without an id, a label or a vector, and vectors that are empty or hold null or non-finite components, take no part. Of
    rows with one id the one with the least label, then vector, counts. Vectors of other dimensions never meet. Scores are
    exact while the sums of absolute products stay below 2^63. Other columns are not read; an empty table gives no rows.
    """
    vec = F.col(vec_col)
    good = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = (df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), vec.alias("vec"))
            .where(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("vec") > 0) & good))
    if label is not None:
        rows = rows.withColumn("label", label.cast("long"))
    anchors = stored(rows.where(is_anchor).groupBy("id").agg(F.min(F.struct("label", "vec")).alias("row"))
                     .select("id", "row.label", "row.vec", F.size("row.vec").alias("dim")), "negatives-anchors")
    rows = rows.withColumn("dim", F.size("vec"))
    count, asked = rows.count(), anchors.count()
    turn = F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1 << 30))
    sample = stored(rows.where(turn < F.lit(min(1.0, SAMPLE / max(1, count)) * (1 << 30))), "negatives-sample")
    anything = F.array(F.struct(F.lit(-MOST).alias("low"), F.lit(MOST).alias("high")))
    found = _best(anchors.withColumn("asks", anything), rows, sample, positives, True, scale, count, asked)
    pairs = stored(found.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")),
                   "negatives-positives")
    # The least whole number at or above the share; division cuts towards zero.
    score, (part, of) = F.col("positive_score"), share
    wide = f"cast({part} AS decimal(18, 0)) * cast(positive_score AS decimal(20, 0))"
    low = F.expr(f"({wide}) div {of}") + F.expr(f"({wide}) % {of} > 0").cast("long")
    asks = (pairs.select(F.col("anchor_id").alias("id"), low.alias("low"), score.alias("high")).where("low <= high").distinct()
            .groupBy("id").agg(F.collect_list(F.struct("low", "high")).alias("asks")))
    near = _best(anchors.join(asks, "id"), rows, sample, negatives, False, scale, count, asked)
    return (pairs.join(near.select("anchor_id", F.col("high").alias("positive_score"), "rank", F.col("vec_id").alias("negative_id"),
                                   F.col("score").alias("negative_score")), ["anchor_id", "positive_score"])
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
