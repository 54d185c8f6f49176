"""Approximate nearest neighbours by collision counting with query-centred windows.

Each block projects its vectors, scaled to length 1, on one line per hash and keeps every projection as a sorted array.
A query's window on an array is centred on its own projection and reaches as far as the search radius; virtual rehashing
widens all windows by a larger radius. A vector inside enough windows has collided often enough and is verified by its
exact cosine. A query is done when its ``k`` best verified lie within the radius: with the threshold used, a vector
within the radius is missed with a chance of about one in twenty. There is no cap on candidates.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .grid import search_blocks, usable

HASHES = 64
RADII = (0.4, 0.8, 1.0, 1.15, 1.3, 1.5, 2.0)  # distance of vectors of length 1; 2 reaches all
MISS = 0.05
SEED = 20


def _lines(dim: int, hashes: int, seed: int):
    """Directions, orthogonal in groups of ``dim``, scaled so that a projected distance has the distance as deviation."""
    import numpy as np

    random = np.random.default_rng(seed)
    groups = [np.linalg.qr(random.normal(size=(dim, dim)))[0] for _ in range(-(-hashes // dim))]
    return np.concatenate(groups, axis=1)[:, :hashes] * np.sqrt(dim)


def threshold(hashes: int, miss: float) -> int:
    """Collisions that a vector at the radius exceeds with a chance of ``1 - miss``."""
    inside = 2 * NormalDist().cdf(1) - 1
    return int(hashes * inside - NormalDist().inv_cdf(1 - miss) * (hashes * inside * (1 - inside)) ** 0.5)


def _finder(k: int, hashes: int, miss: float, seed: int):
    def find(query_ids, queries, ids, vectors):
        import numpy as np

        scale = lambda x: np.abs(x).max(axis=1, keepdims=True)  # noqa: E731  so that squares neither overflow nor vanish
        queries, vectors = queries / scale(queries), vectors / scale(vectors)
        lengths, query_lengths = (np.sqrt((x * x).sum(axis=1)) for x in (vectors, queries))
        lines, enough = _lines(vectors.shape[1], hashes, seed), threshold(hashes, miss)
        projected = (vectors / lengths[:, None]) @ lines
        centres = (queries / query_lengths[:, None]) @ lines
        order = np.argsort(projected, axis=0)
        arrays = np.take_along_axis(projected, order, axis=0)
        place = np.empty(order.shape, np.int32)
        np.put_along_axis(place, order, np.arange(len(ids), dtype=np.int32)[:, None], axis=0)
        place = np.ascontiguousarray(place.T)
        out = []
        for first in range(0, len(query_ids), 64):
            todo = np.arange(first, min(first + 64, len(query_ids)))
            scores = np.full((len(todo), len(ids)), -np.inf)
            waiting = np.arange(len(todo))
            for radius in RADII:
                hits = np.zeros((len(waiting), len(ids)), np.int16)
                for h in range(hashes):
                    centre = centres[todo[waiting], h]
                    low = np.searchsorted(arrays[:, h], centre - radius, "left").astype(np.int32)
                    high = np.searchsorted(arrays[:, h], centre + radius, "right").astype(np.int32)
                    hits += (place[h] - low[:, None]).view(np.uint32) < (high - low).astype(np.uint32)[:, None]
                candidate = (hits >= enough) | (radius >= RADII[-1])
                candidate &= np.isneginf(scores[waiting])
                candidate &= query_ids[todo[waiting], None] != ids[None, :]
                a, b = np.nonzero(candidate)
                q = todo[waiting[a]]
                scores[waiting[a], b] = (queries[q] * vectors[b]).sum(axis=1) / (query_lengths[q] * lengths[b])
                near = (scores[waiting] >= 1 - radius * radius / 2).sum(axis=1)
                waiting = waiting[near < k]
                if not len(waiting):
                    break
            for row, q in enumerate(todo):
                best = np.argsort(-scores[row], kind="stable")[:k]  # ids ascend, so ties go to the smaller
                best = best[~np.isneginf(scores[row, best])]
                out.append((np.full(len(best), query_ids[q]), ids[best], scores[row, best]))
        return [np.concatenate(x) for x in zip(*out, strict=True)]

    return find


def nearest(df: DataFrame, is_query, k: int = 5, *, id_col: str = "vec_id", vec_col: str = "embedding",
            hashes: int = HASHES, miss: float = MISS, seed: int = SEED) -> DataFrame:
    """The ``k`` nearest found of each query by cosine: ``query_id, rank, vec_id, score``.

    ``is_query`` is a condition on the column ``id``. Every row but those of the query's id is a candidate; every row is
    indexed. Vectors that are null, empty, zero, or hold null or non-finite components, and rows without an id, take no
    part; an id repeated with one vector counts once; ties go to the smaller id. Vectors of other dimensions never meet.
    An empty table gives no rows. Other columns are not read.
    """
    rows = usable(df, id_col, vec_col).where(F.exists("vec", lambda x: x != 0))
    return search_blocks(rows, is_query, k, _finder(k, hashes, miss, seed), "double")
