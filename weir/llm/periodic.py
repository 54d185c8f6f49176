"""Periodic runs of words by suffix trees, and texts with each run cut to one period.

A run of exponent 3 or more and 24 or more words repeats 16 of its words one period on, wherever it is looked at. So every run
lies within a stretch covered by windows of 16 words that occur more than once in the document, and ends inside it; other
words never enter a tree. Each stretch gets two suffix trees (Ukkonen), of its words and of their reversal. A tour over a tree
gives its leaves in order and the depth of the lowest common ancestor of neighbours; the least depth between two leaves, in
constant time from a table of minima, is the longest common extension of the two places. Every run holds, for one of the two
orders of the words, a root that is the longest Lyndon word at its place; each place's two longest Lyndon words are therefore
the candidates, and are extended to both sides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

LEAST_WORDS, LEAST_EXPONENT = 24, 3
WINDOW = 16  # LEAST_WORDS * (LEAST_EXPONENT - 1) / LEAST_EXPONENT: what a run has in common with itself one period on
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
SPREAD = np.uint64(0x9E3779B97F4A7C15)
BATCH = 1 << 24  # bytes of answers in one Arrow batch


def suffix_order(s: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and the depth of the lowest common ancestor of each and the one before it.

    Builds the suffix tree by Ukkonen's rule and walks it. The last value of ``s`` must occur once and be the smallest.
    """
    n = len(s)
    start, end, link, kids = [0], [0], [0], [{}]
    node = edge = length = left = 0
    for i, c in enumerate(s):
        last = 0
        left += 1
        while left:
            if not length:
                edge = i
            below = kids[node]
            k = below.get(s[edge])
            if k is None:
                below[s[edge]] = len(start)
                start.append(i); end.append(n); link.append(0); kids.append(None)  # noqa: E702
                if last:
                    link[last] = node
                last = 0
            else:
                reach = (end[k] if end[k] <= i else i + 1) - start[k]
                if length >= reach:
                    edge += reach
                    length -= reach
                    node = k
                    continue
                at = start[k] + length
                if s[at] == c:
                    if last and node:
                        link[last] = node
                    length += 1
                    break
                split = len(start)
                start += (start[k], i); end += (at, n); link += (0, 0)  # noqa: E702
                kids += ({c: split + 1, s[at]: k}, None)
                start[k] = at
                below[s[edge]] = split
                if last:
                    link[last] = split
                last = split
            left -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - left + 1
    order, depths, todo = [], [], [(0, 0)]
    push, pop, fresh, low = todo.append, todo.pop, False, 0
    while todo:
        node, above = pop()
        if fresh:  # the first branch after a leaf leaves from the common ancestor
            low, fresh = above, False
        below = kids[node]
        if below is None:
            order.append(n - above - (n - start[node]))
            depths.append(low)
            fresh = True
        else:
            depth = above + end[node] - start[node]
            for c in sorted(below, reverse=True):
                push((below[c], depth))
    return np.array(order), np.array(depths)


class Extensions:
    """Longest common extensions to the right of any two places."""

    def __init__(self, s: list[int]):
        order, depths = suffix_order(s)
        self.rank = np.empty(len(s), np.int64)
        self.rank[order] = np.arange(len(s))
        self.minima = [depths.astype(np.int32)]
        while 2 << len(self.minima) - 1 <= len(s):
            half, below = 1 << len(self.minima) - 1, self.minima[-1]
            self.minima.append(np.minimum(below[:-half], below[half:]))

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words are the same from ``i`` and ``j`` on; ``i`` and ``j`` differ."""
        a, b = self.rank[i], self.rank[j]
        first, last = np.minimum(a, b) + 1, np.maximum(a, b)
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level):
            here = np.nonzero(level == k)[0]
            table = self.minima[k]
            out[here] = np.minimum(table[first[here]], table[last[here] - (1 << k) + 1])
        return out


def _next_below(rank: list[int], end: int) -> np.ndarray:
    """For each place the next one of lower rank, or ``end``."""
    out, stack = np.full(len(rank), end, np.int64), []
    for i, r in enumerate(rank):
        while stack and rank[stack[-1]] > r:
            out[stack.pop()] = i
        stack.append(i)
    return out


def runs_of_stretch(words: np.ndarray, least: int = LEAST_WORDS, exponent: int = LEAST_EXPONENT) -> np.ndarray:
    """``start, length, period`` of every run of a sequence of whole numbers."""
    n = len(words)
    symbols = np.unique(words, return_inverse=True)[1].reshape(-1) + 1
    onward, back = Extensions([*symbols.tolist(), 0]), Extensions([*symbols[::-1].tolist(), 0])
    rank = onward.rank[:n]
    at = np.arange(n)
    # The longest Lyndon word at a place ends before the next smaller suffix, in either order of the words.
    place = np.concatenate([at, at])
    period = np.concatenate([_next_below(rank.tolist(), n) - at, _next_below((-rank).tolist(), n) - at])
    keep = period * exponent <= n
    place, period = place[keep], period[keep]
    right = np.zeros(len(place), np.int64)
    inner = place + period < n
    right[inner] = onward(place[inner], place[inner] + period[inner])
    left = np.zeros(len(place), np.int64)
    inner = place > 0
    left[inner] = back(n - place[inner], n - place[inner] - period[inner])
    length = left + period + right
    long = (length >= least) & (length >= exponent * period)
    found = np.unique(np.stack([place[long] - left[long], length[long], period[long]], 1), axis=0)
    # Where words end with the run, multiples of its period come up too; the smallest comes first.
    return found[np.append(True, (found[1:, :2] != found[:-1, :2]).any(axis=1))[:len(found)]]


def runs(words: list) -> np.ndarray:
    """``start, length, period`` of every run of a document's words, by start, then period."""
    n = len(words)
    if n < LEAST_WORDS:
        return np.zeros((0, 3), np.int64)
    values = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    window = values
    for step in (1, 2, 4, 8):  # equal windows get equal values; unequal ones that do only widen a stretch
        window = (window[:-step] * SPREAD ^ window[:-step] >> np.uint64(31)) + window[step:]
    order = np.argsort(window)
    same = window[order[1:]] == window[order[:-1]]
    if not same.any():
        return np.zeros((0, 3), np.int64)
    change = np.zeros(n + 1, np.int64)
    again = np.zeros(len(window), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    change[:len(window)] += again
    change[WINDOW:] -= again[: n + 1 - WINDOW]
    covered = np.cumsum(change) > 0
    edges = np.nonzero(np.diff(covered, prepend=False, append=False))[0].reshape(-1, 2)
    found = [np.zeros((0, 3), np.int64)]
    for first, end in edges[edges[:, 1] - edges[:, 0] >= LEAST_WORDS]:
        known: dict = {}
        part = np.array([known.setdefault(w, len(known)) for w in words[first:end]])
        found.append(runs_of_stretch(part) + [first, 0, 0])
    every = np.concatenate(found)
    return every[np.lexsort((every[:, 2], every[:, 0]))]


def _kept(words: list, found: np.ndarray) -> bytes:
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, found[:, 0] + found[:, 2], 1)
    np.add.at(change, found[:, 0] + found[:, 1], -1)
    return b" ".join([words[i] for i in np.nonzero(np.cumsum(change[:-1]) == 0)[0]])


def find_runs(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_words, runs, collapsed`` per row: its runs by start, then period, and its words without the repeats.

    Words are divided by blanks and the control characters 9 to 13. A run is a longest stretch of at least 24 words and
    three periods with that smallest period. ``collapsed`` joins by one blank the words that lie in no run behind its first
    period. A null text is empty and has no runs. Each row is looked at by itself, so null and repeated ids and equal rows
    come back as they are; an empty table gives no rows. Other columns are not read. A task holds one Arrow batch, and
    trees of one stretch of one text at a time, about 1 kB a word of it.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def look(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).cast(pa.large_binary())
            first, size, columns = 0, 0, ([], [], [])
            for i, text in enumerate(texts):
                words = text.as_py().split()
                found = runs(words)
                kept = _kept(words, found) if len(found) else b" ".join(words)
                for column, value in zip(columns, (len(words), found, kept)):
                    column.append(value)
                size += len(kept) + 24 * len(found)
                if size > BATCH or i + 1 == len(texts):
                    yield _answer(ids.slice(first, i + 1 - first), *columns)
                    first, size, columns = i + 1, 0, ([], [], [])

    return df.select(F.col(id_col), text_of(text_col).alias("text")).mapInArrow(
        look, f"`{id_col}` {kind}, n_words long, runs {RUNS}, collapsed string")


def _answer(ids, n_words, found, kept):
    flat = np.concatenate([*found, np.zeros((0, 3), np.int64)])
    offsets = np.cumsum([0, *map(len, found)], dtype=np.int32)
    parts = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"])
    listed = pa.ListArray.from_arrays(pa.array(offsets), parts)
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(n_words, pa.int64()), listed, pa.array(kept, pa.binary()).cast(pa.string())],
        ["id", "n_words", "runs", "collapsed"])


def digest() -> list[Column]:
    """The number of runs, the one of greatest exponent (then least start, then period) and hashes of runs and kept words."""
    def best(so_far, run):
        # Whole numbers: length / period against length / period; runs come by start, then period.
        more = run["length"] * so_far["period"] > so_far["length"] * run["period"]
        return F.when(so_far["period"].isNull() | more, run).otherwise(so_far)

    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    found = F.aggregate("runs", none, best)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return [F.size("runs").cast("long").alias("n_runs"), *[found[c].alias(c) for c in ("start", "length", "period")],
            F.floor(1000 * found["length"] / found["period"]).cast("long").alias("exponent_milli"),
            *[F.sha2(F.encode(text, "UTF-8"), 256).alias(f"{name}_sha256")
              for name, text in (("runs", F.array_join(lines, "")), ("collapsed", F.col("collapsed")))]]


def repeat_tails(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, text_col`` with the words of every tenth id, by its crc32, repeated from a place on; rows without an id stay.

    With g a tenth of the crc32 and n words, those from a = g % n on repeat with period 1 + (n - a) // (3 + g % 8).
    """
    h = F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8"))
    words = F.filter(F.split(text_of(text_col), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")  # size -1 or null where not asked
    some = df.select(F.col(id_col), F.col(text_col), F.floor(h / 10).alias("__g"),
                     F.when(h % 10 == 0, words).alias("__words"))
    n = F.size("__words").cast("long")
    some = some.withColumn("__a", F.when(n > 0, F.col("__g") % n)).withColumn(
        "__p", 1 + F.floor((n - F.col("__a")) / (3 + F.col("__g") % 8)))
    a, p = F.col("__a"), F.col("__p")
    again = F.transform(
        F.sequence(F.lit(0).cast("long"), F.when(n > 0, n - 1)),
        lambda i: F.get("__words", F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
    return some.select(id_col, F.when(n > 0, F.array_join(again, " ")).otherwise(F.col(text_col)).alias(text_col))
