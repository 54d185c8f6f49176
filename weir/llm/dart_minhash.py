"""Near-duplicates by DartMinHash signatures and a banded join.

A document is a weighted set of word shingles. Every element throws darts at the plane of weight and rank, cell by cell
with one dart expected in each; only darts below the element's weight count, and only cells up to the rank that leaves
enough darts for all coordinates are opened. Each coordinate keeps its earliest dart. Two sets agree in a coordinate
with the chance of their weighted Jaccard similarity. Documents that share a band of coordinates become neighbours of
the band's leader and are verified exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import sieve, stored, text_of
from .components import components
from .hashing import Prefixes, mix

WORDS = 5
LEAST = 0.8
COORDINATES, ROWS = 128, 4  # 32 bands of 4: a pair at 0.8 shares none with a chance of 5e-8
CHUNK = 1 << 20  # bytes of text at a time
LEADERS = 1, 8  # leaders of a bucket in each round; what they leave unsettled is compared in blocks
BLOCK = 1 << 20  # bytes of shingles in a block

# Chances of up to so many darts in a cell, one expected.
_DARTS = np.cumsum([np.exp(-1) / np.prod(np.arange(1, k + 1), initial=1.0) for k in range(12)])


def normal(text: Column) -> Column:
    """The words of a text: letters and digits in lower case, one space between them."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


class Shingler:
    """Hashed word shingles of normal texts, in bounded memory beside the words' hashes."""

    def __init__(self, words: int = WORDS):
        self.words, self.prefixes = words, Prefixes(2 * CHUNK)

    def _word_hashes(self, data: bytes) -> np.ndarray:
        """One value per word of ``data``, in which every word ends in a space."""
        out, at = [], 0
        while at < len(data):
            end = len(data) if len(data) - at <= CHUNK else data.rfind(b" ", at, at + CHUNK) + 1
            if end <= at:  # a word longer than the chunk: hashed as a whole
                end = data.find(b" ", at) + 1
                out.append(np.array([hash_long(data[at : end - 1])], np.uint64))
            else:
                part = np.frombuffer(data, np.uint8, end - at, at)
                sums = self.prefixes.sums(part)
                ends = np.nonzero(part == 32)[0]
                starts = np.concatenate([[0], ends[:-1] + 1])
                out.append(mix(self.prefixes.slices(sums, starts, ends)))
            at = end
        return np.concatenate(out) if out else np.zeros(0, np.uint64)

    def sets(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """The distinct shingles of each text, sorted, and how often each occurs. Fewer words make one shingle."""
        hashes = self._word_hashes("".join(t + " " for t in texts if t).encode())
        counts = [t.count(" ") + 1 if t else 0 for t in texts]
        found, at = [], 0
        for n in counts:
            own, at = hashes[at : at + n], at + n
            if not n:
                found.append((own, np.zeros(0, np.int64)))
                continue
            last = max(1, n - self.words + 1)
            total = np.zeros(last, np.uint64)
            for k in range(min(self.words, n)):
                total = mix(total ^ own[k : k + last], k)
            found.append(np.unique(total, return_counts=True))
        return found


def hash_long(word: bytes) -> int:
    import hashlib

    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


def _throw(x: np.ndarray, w: np.ndarray, level: int, rank: float):
    """The darts of elements in the weight cell of a level, up to a rank: their hashes and ranks.

    Level 0 is the weight from 0 to 1, level v from 2^(v-1) to 2^v. Cells of a level are as much flatter as they are wider.
    """
    low, width = (0.0, 1.0) if not level else (2.0 ** (level - 1), 2.0 ** (level - 1))
    rows = int(np.ceil(rank * width))
    seeds = mix((x[:, None] + mix(np.arange(rows, dtype=np.uint64), 101 + level)[None, :]).ravel(), 7)
    count = np.searchsorted(_DARTS, (seeds >> np.uint64(11)) * 2.0**-53, "right")
    own = np.repeat(np.arange(len(seeds)), count)
    turn = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
    darts = mix(seeds[own] + turn.astype(np.uint64), 11)
    ranks = ((own % rows) + (mix(darts, 13) >> np.uint64(11)) * 2.0**-53) / width
    keep = ranks <= rank
    if level or w.min() < 1:
        keep &= low + (mix(darts, 17) >> np.uint64(11)) * 2.0**-53 * width <= w[own // rows]
    return darts[keep], ranks[keep]


def signature(x: np.ndarray, w: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """The earliest dart of each coordinate for elements ``x`` with weights ``w`` above 0."""
    rank = (coordinates * np.log(coordinates) + 2 * coordinates) / w.sum()
    while True:
        levels = range(1 + max(0, int(np.ceil(np.log2(max(w.max(), 1))))))
        thrown = [_throw(x[use], w[use], v, rank) for v in levels for use in [w > (2.0 ** (v - 1) if v else 0)]
                  if use.any()]
        darts, ranks = (np.concatenate(part) for part in zip(*thrown, strict=True))
        order = np.lexsort((darts, ranks))
        where, first = np.unique(darts[order] % np.uint64(coordinates), return_index=True)
        if len(where) == coordinates:
            return darts[order[first]]
        rank *= 2


def bands(signed: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One value per band of ``rows`` coordinates, different for different bands."""
    total = np.arange(len(signed) // rows, dtype=np.uint64)
    for k in range(rows):
        total = mix(total ^ signed[k::rows], k)
    return total.view(np.int64)


def _chunks(batches: Iterator) -> Iterator:
    """Ids and texts of about ``CHUNK`` bytes together."""
    for batch in batches:
        sizes, first = batch.column(2).to_pylist(), 0
        while first < len(sizes):
            last, size = first + 1, sizes[first]
            while last < len(sizes) and size + sizes[last] <= CHUNK:
                size, last = size + sizes[last], last + 1
            yield batch.slice(first, last - first)
            first = last


def _sketcher(words: int, weighted: bool, coordinates: int, rows: int):
    def sketch(batches: Iterator) -> Iterator:
        import pyarrow as pa

        shingler = Shingler(words)
        for part in _chunks(batches):
            found = []
            for x, count in shingler.sets(part.column(1).to_pylist()):
                w = count.astype(float) if weighted else np.ones(len(x))
                found.append(bands(signature(x, w, coordinates), rows) if len(x) else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(3), part.column(4),
                                              pa.array(found, pa.list_(pa.int64()))], ["doc", "node", "raw", "bands"])

    return sketch


def _lister(words: int):
    def shingles(batches: Iterator) -> Iterator:
        import pyarrow as pa

        shingler = Shingler(words)
        for part in _chunks(batches):
            found = shingler.sets(part.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([x.tobytes() for x, _ in found], pa.binary()),
                 pa.array([c.astype(np.int32).tobytes() for _, c in found], pa.binary())], ["id", "x", "w"])

    return shingles


def _verifier(least: float, weighted: bool):
    def verify(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            sides = [[np.frombuffer(v, kind) for v in batch.column(name).to_pylist()]
                     for name, kind in (("x", np.uint64), ("w", np.int32), ("y", np.uint64), ("v", np.int32))]
            keep = [similarity(*pair, weighted) >= least for pair in zip(*sides, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(keep, pa.bool_())],
                                             ["a", "b", "alike"])

    return verify


def similarity(x: np.ndarray, w: np.ndarray, y: np.ndarray, v: np.ndarray, weighted: bool = False) -> float:
    """Jaccard similarity of two sorted sets, by their weights if asked for."""
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    if not weighted:
        return len(i) / max(1, len(x) + len(y) - len(i))
    both = np.minimum(w[i], v[j]).sum()
    return both / max(1, w.sum() + v.sum() - both)


def _block_links(least: float, weighted: bool):
    def links(table):
        """Links ``a, b`` that connect the classes of two blocks (or of one with itself): a spanning forest of them."""
        import pyarrow as pa

        ids, roots = table.column("id").to_pylist(), table.column("root").to_pylist()
        left, right = np.array(table.column("left")), np.array(table.column("right"))
        sets = [np.frombuffer(x, np.uint64) for x in table.column("x").to_pylist()]
        if weighted:
            sets = [_counted(x, np.frombuffer(w, np.int32))
                    for x, w in zip(sets, table.column("w").to_pylist(), strict=True)]
        size = np.array([len(x) for x in sets])
        names, own = np.unique(np.array(roots, object), return_inverse=True)
        above = np.arange(len(names))  # each class, and the one it was connected to

        inside = np.nonzero(right)[0]
        values = np.concatenate([sets[k] for k in inside]) if len(inside) else np.zeros(0, np.uint64)
        order = np.argsort(values, kind="stable")
        values, holder = values[order], np.repeat(inside, size[inside])[order]
        found = []
        for k in np.nonzero(left)[0]:
            first, last = np.searchsorted(values, sets[k]), np.searchsorted(values, sets[k], "right")
            n = last - first
            at = np.arange(n.sum()) + np.repeat(first - np.cumsum(n) + n, n)
            both = np.bincount(holder[at], minlength=len(sets))
            close = (both > 0) & (both / np.maximum(1, size + size[k] - both) >= least)
            hits = np.nonzero(close & (above[own] != above[own[k]]))[0]
            for j in hits:
                low, high = sorted((above[own[k]], above[own[j]]))
                if low != high:
                    above[above == high] = low
                    found.append((ids[k], ids[j]))
        kind = table.schema.field("id").type
        return pa.table({"a": pa.array([a for a, _ in found], kind), "b": pa.array([b for _, b in found], kind)})

    return links


def _counted(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """One value per occurrence, so that the similarity of these sets is the weighted one."""
    turn = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
    return mix(np.repeat(x, w) ^ mix(turn.astype(np.uint64), 23))


def _in_blocks(state: DataFrame, sets: DataFrame, least: float, weighted: bool) -> DataFrame:
    """Links between members of different classes in each bucket, by pairs of blocks of about ``BLOCK`` bytes."""
    sized = state.select("bucket", "id", "root").join(sets.select("id", F.octet_length("x").alias("size")), "id")
    blocks = sized.groupBy("bucket").agg(F.ceil(F.sum("size") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("id", "bucket"), F.greatest("blocks", F.lit(1))).cast("int")
    placed = (sized.join(blocks, "bucket").withColumn("own", own)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.greatest("blocks", F.lit(1)) - 1)))
              .select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "id", "root",
                      (F.col("own") <= F.col("other")).alias("left"), (F.col("own") >= F.col("other")).alias("right")))
    columns = ["id", "x", "w"] if weighted else ["id", "x"]
    return stored(placed.join(sets.select(*columns), "id").groupBy("bucket", "i", "j")
                  .applyInArrow(_block_links(least, weighted), "a long, b long").distinct(), "dart-block-links")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST,
                    words: int = WORDS, weighted: bool = True, coordinates: int = COORDINATES,
                    rows: int = ROWS) -> DataFrame:
    """One row per id: the id, ``class_id`` (the smallest id of its class) and ``class_size`` (ids in it).

    Two documents are linked if their word shingles, weighted by how often each occurs, have a Jaccard similarity of at least
    ``least``; without ``weighted`` every shingle counts once. A class is what links connect. Texts equal in words are linked; texts without words
    are linked if equal, null being empty. Each text is compared by itself, and an id belongs with all texts of its rows;
    equal rows change nothing. Rows without an id are left out. An empty table gives no rows. Other columns are not read.

    A bucket of equal bands is searched from leaders: first the member that meets most others, then, where a bucket still
    holds several classes, some further members against those of other classes. Members of different classes that no
    leader has met are compared in blocks of bounded size, which return only links that connect classes. So no link
    that connects texts of one bucket is lost, and no bucket is expanded into its pairs.
    """
    text = text_of(text_col)
    base = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc"), text.alias("text"), F.xxhash64(text).alias("raw"))
    kind = base.schema["doc"].dataType.simpleString()

    def normalised(rows: DataFrame) -> DataFrame:
        """``doc, normal, size, node, raw``: texts that count as equal have one node, 128 bits of hash."""
        plain = rows.select("doc", "text", normal(F.col("text")).alias("normal"), "raw")
        same = F.when(F.col("normal") == "", F.concat(F.lit(" "), F.col("text"))).otherwise(F.col("normal"))
        halves = [F.lpad(F.hex(F.xxhash64(same, *seed)), 16, "0") for seed in ((), (F.lit(1),))]
        return plain.select("doc", "normal", F.octet_length("normal").alias("size"), F.unhex(F.concat(*halves)).alias("node"), "raw")

    sketches = stored(normalised(base).mapInArrow(_sketcher(words, weighted, coordinates, rows),
                                                  f"doc {kind}, node binary, raw long, bands array<long>"), "dart-sketches")
    # From here on a text goes by a number.
    copies = stored(sketches.groupBy("node").agg(F.min(F.struct("doc", "raw")).alias("row"), F.first("bands").alias("bands"))
                    .select("node", "row.*", "bands", F.monotonically_increasing_id().alias("id")), "dart-copies")
    entries = copies.select("id", F.explode("bands").alias("bucket"))
    crowded = entries.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    shared = stored(entries.join(crowded, "bucket").select("bucket", "id", "n"), "dart-buckets")
    met = stored(shared.groupBy("id").agg(F.sum("n").alias("met")), "dart-met")
    members = stored(shared.join(met, "id").select("bucket", "id", "met"), "dart-members")

    # One row that holds each text; words are looked for only where it is found.
    holders = stored(met.select("id").join(copies, "id").select("id", "doc", "raw"), "dart-holders")
    texts = (sieve(base, holders, "doc").join(holders.hint("merge"), ["doc", "raw"])
             .select("id", normal(F.col("text")).alias("normal")).select("id", "normal", F.octet_length("normal").alias("size")))
    sets = stored(texts.mapInArrow(_lister(words), "id long, x binary, w binary").dropDuplicates(["id"]), "dart-sets")
    first = sets.select(F.col("id").alias("a"), "x", "w")
    second = sets.select(F.col("id").alias("b"), F.col("x").alias("y"), F.col("w").alias("v"))

    def alike(pairs: DataFrame) -> DataFrame:
        """The pairs ``a, b`` at or above the threshold, verified on their whole sets."""
        whole = pairs.join(first, "a").join(second, "b")
        return (whole.mapInArrow(_verifier(least, weighted), "a long, b long, alike boolean")
                .where("alike").select("a", "b"))

    # Texts of one id are linked through the first of them.
    several = (sketches.groupBy("doc").agg(F.min(F.xxhash64("node")).alias("low"), F.max(F.xxhash64("node")).alias("high"))
               .where("low <> high").select("doc"))
    own = stored(sketches.select("doc", "node").join(several, "doc").distinct()
                 .join(copies.select("node", "id"), "node").select("doc", "id"), "dart-own")
    own_links = (own.join(own.groupBy("doc").agg(F.min("id").alias("a")), "doc").where("a <> id")
                 .select("a", F.col("id").alias("b")))
    links, tested, state = None, None, members.withColumn("root", F.col("id")).withColumn("tried", F.lit(False))
    for leaders in LEADERS:
        turn = F.pmod(F.xxhash64("id"), F.lit(leaders)).cast("int")
        chosen = (state.where("not tried").groupBy("bucket", turn.alias("turn"))
                  .agg(F.max(F.struct("met", "id", "root")).alias("top"))
                  .select("bucket", F.col("top.id").alias("a"), F.col("top.root").alias("a_root")))
        pairs = (state.join(chosen, "bucket").where("root <> a_root")
                 .select(F.least("a", "id").alias("a"), F.greatest("a", "id").alias("b")).distinct())
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "dart-pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        found = stored(alike(pairs), "dart-links")
        links = found if links is None else links.unionByName(found)
        roots = components(links)
        tried = chosen.select("bucket", F.col("a").alias("id"), F.lit(True).alias("now"))
        state = (state.drop("root").join(roots, "id", "left").join(tried, ["bucket", "id"], "left")
                 .select("bucket", "id", "met", F.coalesce("root", "id").alias("root"),
                         (F.col("tried") | F.coalesce("now", F.lit(False))).alias("tried")))
        state = stored(state, "dart-state")
        # What was tried has met its whole bucket: only untried members of different classes are left.
        open_ = (state.where("not tried").groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"))
                 .where("low <> high").select("bucket"))
        state = stored(state.join(open_, "bucket", "left_semi"), "dart-state")
    links = links.unionByName(_in_blocks(state.where("not tried"), sets, least, weighted))

    roots = components(links.unionByName(own_links))
    nodes = copies.join(roots, "id", "left").select("node", F.coalesce("root", "id").alias("root"))
    labelled = stored(sketches.select("doc", "node").join(nodes, "node").select("doc", "root").distinct(), "dart-classes")
    classes = labelled.groupBy("root").agg(F.min("doc").alias("class_id"), F.count("*").alias("class_size"))
    return labelled.join(classes, "root").select(F.col("doc").alias(id_col), "class_id", "class_size")


def keep_first(docs: DataFrame, classes: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """The rows but those whose id is not the smallest of its class."""
    others = classes.where(F.col(id_col) != F.col("class_id")).select(F.col(id_col).alias("__other__"))
    return docs.join(others, docs[id_col] == F.col("__other__"), "left_anti")
