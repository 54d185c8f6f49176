"""Best-fit packing of tokenized documents into sequences of a fixed length.

Pieces and gaps are sorted by length. A sweep takes the pieces of one length, longest lengths first, and matches them
with the smallest gaps that hold them (their successors in the order of gaps): the piece of rank r goes to the gap of
rank r, so no two pieces claim one gap; the gaps shrink, are sorted in anew, and the sweep repeats until the length is
placed. Pieces of one length and gaps of one size are alike, so a sweep moves whole runs of ranks and its state is at
most a few runs per length, however many documents there are. Ranks are assigned and resolved by Spark.

Where documents have places in an order, the ranks of each length follow it, and so do the numbers of the sequences.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from string import punctuation

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import buckets_for, small_table, stored, text_of

CAPACITY = 4096
END_ID = 1
WORDS_KEPT = 400_000  # of a worker's memory of words; it starts anew beyond, with the same results
AT_ONCE = 2000  # words for the tokenizer


class WordEncoder:
    """Ids of texts as little-endian bytes, word by word, each word by the tokenizer once.

    The tokenizer drops white space and no token spans it, so the ids of a text are those of its words in turn. It lowers
    letters, so the spellings of a word in texts of Latin-1 characters share one entry, unless the text may hold a special
    token, which is looked for before that. Marks after letters are a piece of their own there, whatever they are: a word of
    Latin-1 letters and ASCII marks behind them has the ids of the letters, then of the marks. Small Latin-1 letters are left
    as they are by all that comes before the tokenizer's model, so the model alone takes them.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.known = Tokenizer.from_file(path), {"": b""}
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelling = {i: spell(chr(i))[0][0] for i in range(33, 256) if chr(i).isalpha()}

    def _words(self, text: str) -> list[str]:
        words = text.replace("\n", " ")
        return (words if "<|" in text or not _is_latin(text) else words.lower()).split(" ")

    def _learn(self, words: list[str]) -> None:
        import numpy as np

        known, rest, tailed, tokenize, spelling = self.known, [], [], self.tokenizer.model.tokenize, self.spelling
        for word in words:
            stem = word.lower().rstrip(punctuation)
            if not (stem.isalpha() and stem.islower() and _is_latin(word)) or "<|" in word:
                rest.append(word)
                continue
            ids = known.get(stem)
            if ids is None:
                ids = known[stem] = b"".join([t.id.to_bytes(4, "little") for t in tokenize(stem.translate(spelling))])
            if len(stem) < len(word):
                tailed.append((word, ids, word[len(stem):]))
            else:
                known[word] = ids
        rest += {tail for _, _, tail in tailed}.difference(known, rest)
        for i in range(0, len(rest), AT_ONCE):
            part = rest[i : i + AT_ONCE]
            found = self.tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
            data = np.array(found.ids, "<u4").tobytes()
            cuts = (4 * np.searchsorted(np.array(found.word_ids, np.int64), np.arange(len(part) + 1))).tolist()
            for word, start, end in zip(part, cuts, cuts[1:], strict=False):
                known[word] = data[start:end]
        for word, ids, tail in tailed:
            known[word] = ids + known[tail]

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self._words(t) for t in texts]
        self._learn(list(set().union(*split).difference(self.known)))
        done = [b"".join(map(self.known.__getitem__, words)) for words in split]
        if len(self.known) > WORDS_KEPT:
            self.known = {"": b""}
        return done


def _is_latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _pieces_of(path: str, capacity: int, end_id: int):
    def pieces(batches: Iterator) -> Iterator:
        import pyarrow as pa

        encoder, end = WordEncoder(path), end_id.to_bytes(4, "little")
        for batch in batches:
            ids, lengths, places = batch.column(0), batch.column(1).to_pylist(), batch.column(3)
            first = 0
            while first < len(lengths):
                last, size = first, 0
                while last < len(lengths) and (last == first or size + lengths[last] <= 1 << 20):
                    size, last = size + lengths[last], last + 1
                texts = batch.column(2).slice(first, last - first).to_pylist()
                rows: list[list[int]] = [[], [], [], [], []]
                for i, data in enumerate(encoder.encode(texts)):
                    data += end
                    for k, at in enumerate(range(0, len(data), 4 * capacity)):
                        part = data[at : at + 4 * capacity]
                        for column, value in zip(rows, (first + i, k, at // 4, len(part) // 4, zlib.crc32(part)),
                                                 strict=True):
                            column.append(value)
                at_row = pa.array(rows[0], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids.take(at_row), pa.array(rows[1], pa.int32()), *(pa.array(c, pa.int64()) for c in rows[2:]),
                     places.take(at_row)], ["id", "piece", "start", "length", "crc", "place"])
                first = last

    return pieces


def token_pieces(docs: DataFrame, path: str, *, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id",
                 text_col: str = "text", place: Column | None = None) -> DataFrame:
    """``id, piece, start, length, crc, place`` of every document's ids; only longer ones are cut."""
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.octet_length(text).alias("size"), text.alias("text"),
                       (F.lit(None) if place is None else place).cast("long").alias("place"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_pieces_of(path, capacity, end_id),
                           f"id {kind}, piece int, start long, length long, crc long, place long")


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, count, first sequence, offset): where the pieces of each length go."""
    runs: dict[int, list[tuple[int, int]]] = {}  # gap -> (first sequence, count)
    sizes: list[int] = []
    moves, opened = [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(sizes, length)
            if at < len(sizes):
                gap = sizes[at]
                sequence, have = runs[gap].pop()
                if not runs[gap]:
                    del runs[gap], sizes[at]
                used = min(have, left)
                if have > used:
                    if gap not in runs:
                        insort(sizes, gap)
                    runs.setdefault(gap, []).append((sequence + used, have - used))
            else:
                # As many new sequences as the rest of this length fills whole, else one more.
                gap, sequence, used = capacity, opened, max(1, left // (capacity // length))
                opened += used
            moves.append((length, rank, used, sequence, capacity - gap))
            rank, left = rank + used, left - used
            if gap > length:
                if gap - length not in runs:
                    insort(sizes, gap - length)
                runs.setdefault(gap - length, []).append((sequence, used))
    return moves


def _cut_at(df: DataFrame, place: str, buckets: int) -> list[int]:
    """Places that cut the rows of ``df`` into about even parts."""
    shares = [i / buckets for i in range(1, buckets)]
    found = df.agg(F.percentile_approx(place, shares, 10 * buckets)).first()[0] if shares else None
    return sorted(set(found or []))


def _bucket(place: Column, cuts: list[int]) -> Column:
    """How many cuts lie at or below the place, by halving."""
    bounds, steps = F.array(*map(F.lit, cuts)).cast("array<long>"), [1 << i for i in reversed(range(len(cuts).bit_length()))]

    def step(at: Column, width: Column) -> Column:
        fits = (at + width <= len(cuts)) & (F.get(bounds, at + width - 1) <= place)
        return F.when(fits, at + width).otherwise(at)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step) if cuts else F.lit(0)


def _by_place(placed: DataFrame) -> DataFrame:
    """The sequences numbered by the place of their earliest piece."""
    placed = stored(placed, "pack-placed")
    first = stored(placed.groupBy("sequence_id").agg(F.min(F.struct("place", "piece")).alias("first")), "pack-firsts")
    cuts = _cut_at(first, "first.place", buckets_for(first.count(), 32))
    first = first.withColumn("bucket", _bucket(F.col("first.place"), cuts))
    before, ahead = [], 0
    for r in sorted(first.groupBy("bucket").agg(F.count("*").alias("n")).collect()):
        before.append((r["bucket"], ahead))
        ahead += r["n"]
    offsets = small_table(placed.sparkSession, before, "bucket int, before long")
    inside = Window.partitionBy("bucket").orderBy("first")
    numbers = (first.withColumn("own", F.row_number().over(inside) - 1).join(F.broadcast(offsets), "bucket")
               .select("sequence_id", (F.col("own") + F.col("before")).alias("number")))
    return (placed.join(numbers, "sequence_id").withColumn("sequence_id", F.col("number"))
            .select(*[c for c in placed.columns if c != "place"]))


def pack(docs: DataFrame, path: str, *, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id",
         text_col: str = "text", place: Column | None = None) -> DataFrame:
    """One row per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.

    ``place``, an integer of each row, is the order in which pieces of one length are dealt to the gaps and sequences are
    numbered, by their earliest piece; without it a hash of id and piece decides. A null or empty text is the end id
    alone. Repeated rows are packed each for itself; ties in rank go by id and piece. An empty table gives no rows.
    Columns other than id, text and those of ``place`` are not read.
    """
    spark = docs.sparkSession
    pieces = stored(token_pieces(docs, path, capacity=capacity, end_id=end_id, id_col=id_col, text_col=text_col,
                                 place=place), "pack-pieces")
    lengths = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    moves = best_fit(lengths, capacity)
    by_length: dict[int, list] = {}
    for length, rank, _, sequence, offset in moves:
        by_length.setdefault(length, []).append((rank, sequence, offset))
    # At most ``capacity`` rows, with a few runs each.
    plan = small_table(spark, [(n, [x[0] for x in m], [x[1] for x in m], [x[2] for x in m])
                               for n, m in by_length.items()],
                       "_length long, ranks array<long>, sequences array<long>, offsets array<long>")

    buckets = buckets_for(max(lengths.values(), default=0), 32)
    if place is None:
        bucket = lambda _: F.pmod(F.xxhash64("id", "piece"), F.lit(buckets)).cast("int")
    else:
        # Where the buckets are cut decides only which task ranks a piece.
        cuts = _cut_at(pieces, "place", buckets)
        bucket = lambda at: _bucket(at, cuts)
    dealt = pieces.withColumn("bucket", bucket(F.col("place")))
    sums = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("length", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "bucket").orderBy("place", "id", "piece")
    ranked = (dealt.withColumn("own", F.row_number().over(inside) - 1)
              .join(offsets, ["length", "bucket"]).withColumn("rank", F.col("own") + F.col("before")))
    run = F.expr("cast(array_size(filter(ranks, r -> r <= rank)) as int)")
    placed = (ranked.join(F.broadcast(plan), F.col("length") == F.col("_length"))
              .withColumn("run", run)
              .select("id", "piece", "start", "length", F.col("crc").alias("ids_crc32"),
                      (F.expr("sequences[run - 1] + rank - ranks[run - 1]")).cast("long").alias("sequence_id"),
                      F.expr("offsets[run - 1]").alias("offset"), "place"))
    return (placed.drop("place") if place is None else _by_place(placed)).withColumnRenamed("id", id_col)
