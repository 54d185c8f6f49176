"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

Suffixes are ordered only through the first ``depth`` bytes, by most-significant-digit passes, and a group that is down to
one member leaves the sort. Digits are fingerprints of byte ranges, so a pass is a shuffle by a number.

1. Digit one is the gram of 32 bytes with the least hash inside the suffix's depth, and stands for the place it has there.
   All suffixes next to each other with the same such gram travel as one run. Suffixes equal through the depth hold the
   same gram at the same place.
2. Digit two is the whole run. Equal runs hold equal suffixes one by one; all but the first run are repeats.
3. Where a gram has several different runs, the first of each is opened and its suffixes are sorted by all ``depth`` bytes:
   within the gram's group where it is small, else spread by a fingerprint of those bytes.

Equal groups are then exactly the repeated windows. Each task first merges what repeats within a piece of its input, so a
window shared by very many documents sends at most one row per piece, and a gram with many runs in one piece is opened at
once instead of being gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, text_of
from .hashing import Prefixes, mix

DEPTH = 100
GRAM = 32
PIECE = 1 << 20  # bytes sorted at a time; two pieces together stay below 2^21
MANY_RUNS = 8  # of one gram in one piece
GATHERED = 64  # different runs of one gram that are sorted in one place, as texts
OPENED = 4096  # runs opened at a time
PLACE = np.uint64((1 << 21) - 1)

# Kinds of rows between the passes.
RUN, CROWDED, REPEAT, OPEN, SPREAD, WINDOW = range(6)
ROW = "kind int, key long, sub long, doc long, at long, span int"
NAMES = ["kind", "key", "sub", "doc", "at", "span"]


TEXT_ROW = f"{ROW}, text binary"


def _batch(*parts: tuple):
    """A batch of rows from tuples of arrays in the order of ``NAMES``."""
    import pyarrow as pa

    kinds = [np.int32, np.int64, np.int64, np.int64, np.int64, np.int32]
    columns = [np.concatenate([np.broadcast_to(np.asarray(p[i]), len(p[3])).astype(k, copy=False) for p in parts])
               for i, k in enumerate(kinds)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], NAMES)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, depth: int, prefixes: Prefixes):
    """Gram, run hash, first and last suffix of each run in the strings ``data[starts:ends]``."""
    none = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(len(data) + 1, np.int32)
    long = ends - starts >= depth
    np.add.at(edge, starts[long], 1)
    np.add.at(edge, ends[long] - depth + 1, -1)
    suffixes = np.nonzero(np.cumsum(edge[:-1]) > 0)[0]
    if not len(suffixes):
        return none
    gram = min(GRAM, depth)
    sums = prefixes.sums(data)
    places = np.arange(len(data) - gram + 1)
    grams = mix(prefixes.slices(sums, places, places + gram))
    # The least hash, leftmost first: minimums over spans that double, with the place in the low bits.
    least, covered, wanted = (grams & ~PLACE) | places.astype(np.uint64), 1, depth - gram + 1
    while covered < wanted:
        step = min(covered, wanted - covered)
        least, covered = np.minimum(least[:-step], least[step:]), covered + step
    anchor = (least[suffixes] & PLACE).astype(np.int64)
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (suffixes[1:] != suffixes[:-1] + 1)])
    first = np.nonzero(new)[0]
    last = np.concatenate([first[1:], [len(suffixes)]]) - 1
    low, high, place = suffixes[first], suffixes[last], anchor[first]
    shape = ((place - low) * depth + (high - low)).astype(np.uint64)
    return grams[place], mix(prefixes.slices(sums, low, high + depth) ^ mix(shape, 3)), low, high


def _pieces(batches: Iterator, depth: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Documents as id, place of the bytes, bytes; about ``PIECE`` bytes together, long documents in overlapping parts."""
    kept: list[tuple[int, int, bytes]] = []
    size = 0
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for doc, value in zip(ids, batch.column(1), strict=True):
            text = value.as_buffer()
            for at in range(0, max(1, len(text) - depth + 1), PIECE - depth):
                part = text.slice(at, min(PIECE, len(text) - at)).to_pybytes()
                if len(part) >= depth:
                    kept.append((doc, at, part))
                    size += len(part)
                if size >= PIECE:
                    yield kept
                    kept, size = [], 0
    if kept:
        yield kept


def _first_pass(depth: int):
    def sort(batches: Iterator) -> Iterator:
        prefixes = Prefixes(2 * PIECE)
        for pieces in _pieces(batches, depth):
            pieces.sort(key=lambda p: p[:2])
            sizes = np.array([len(p[2]) for p in pieces])
            ends = np.cumsum(sizes)
            starts = ends - sizes
            data = np.frombuffer(b"".join(p[2] for p in pieces), np.uint8)
            gram, run, low, high = runs(data, starts, ends, depth, prefixes)
            own = np.searchsorted(starts, low, "right") - 1
            doc = np.array([p[0] for p in pieces], np.int64)[own]
            at = low - starts[own] + np.array([p[1] for p in pieces], np.int64)[own]
            span = high - low
            order = np.lexsort((at, doc, run, gram))
            gram, run, doc, at, span = (x[order] for x in (gram, run, doc, at, span))
            again, later = _repeats(gram, run, doc, at)
            key, sub = _signed(gram[~again]), _signed(run[~again])
            grams, turn, count = np.unique(key, return_inverse=True, return_counts=True)
            crowded = count > MANY_RUNS
            yield _batch(
                (REPEAT, mix(doc[later].astype(np.uint64)).view(np.int64), 0, doc[later], at[later], span[later] + depth),
                (CROWDED, grams[crowded], 0, np.zeros(int(crowded.sum()), np.int64), 0, 0),
                (np.where(crowded[turn], SPREAD, RUN), key, sub, doc[~again], at[~again], span[~again]))

    return sort


def _repeats(key, sub, doc, at):
    """Of rows in order: which continue a group of equal key and sub, and which of those lie after its first row."""
    again = np.zeros(len(key), bool)
    again[1:] = (key[1:] == key[:-1]) & (sub[1:] == sub[:-1])
    first = np.maximum.accumulate(np.where(again, 0, np.arange(len(key)))) if len(key) else np.zeros(0, np.int64)
    return again, again & ((doc != doc[first]) | (at != at[first]))


def _group_pass(depth: int):
    """Over rows sorted by key, sub, doc and place: repeats, and the runs to open."""
    def settle(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kept = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([kept, table]) if kept is not None else table
            keys = table.column("key").to_numpy()
            # The last key may go on in the next batch.
            whole = int(np.searchsorted(keys, keys[-1], "left")) if len(keys) else 0
            kept = table.slice(whole)
            if whole:
                yield _settled(table.slice(0, whole), depth)
        if kept is not None and len(kept):
            yield _settled(kept, depth)

    return settle


def _settled(table, depth: int):
    kind, key, sub, doc, at, span = (table.column(n).to_numpy() for n in NAMES)
    passed = (kind == REPEAT) | (kind == SPREAD)
    out = [tuple(x[passed] for x in (kind, key, sub, doc, at, span))]
    if "text" in table.column_names:
        use = np.nonzero(kind == OPEN)[0]
        for first in range(0, len(use), OPENED):
            # A gram's runs stay together: a part ends where the gram does.
            low, high = (int(np.searchsorted(key[use], key[use[i]], "left")) if i < len(use) else i
                         for i in (first, first + OPENED))
            rows = use[low:high]
            if len(rows):
                out.append(_sorted_runs(*(x[rows] for x in (key, doc, at, span)), table.column("text").take(rows), depth))
    else:
        k, s, d, a, n = (x[kind == RUN] for x in (key, sub, doc, at, span))
        again, later = _repeats(k, s, d, a)
        out.append((REPEAT, k[later], 0, d[later], a[later], n[later] + depth))
        k, s, d, a, n = (x[~again] for x in (k, s, d, a, n))
        grams, turn, count = np.unique(k, return_inverse=True, return_counts=True)
        spread = np.isin(grams, key[kind == CROWDED]) | (count > GATHERED)
        opened = (spread | (count > 1))[turn]
        out.append((np.where(spread[turn[opened]], SPREAD, OPEN), *(x[opened] for x in (k, s, d, a, n))))
    k, s, d, a = (x[kind == WINDOW] for x in (key, sub, doc, at))
    _, later = _repeats(k, s, d, a)
    out.append((REPEAT, k[later], 0, d[later], a[later], depth))
    return _batch(*out)


def _suffixes(span: np.ndarray, depth: int):
    """Run, place in the run and place in the runs' joined texts of every suffix."""
    own = np.repeat(np.arange(len(span)), span + 1)
    shift = np.arange(len(own)) - np.repeat(np.cumsum(span + 1) - span - 1, span + 1)
    return own, shift, (np.cumsum(span + depth) - span - depth)[own] + shift


def _sorted_runs(gram, doc, at, span, texts, depth: int) -> tuple:
    """Repeats among the suffixes of runs, given as texts, of several grams; next to each other they are one range."""
    data = np.frombuffer(b"".join(texts.to_pylist()), np.uint8)
    span = span.astype(np.int64)
    own, shift, start = _suffixes(span, depth)
    prefixes = Prefixes(len(data))
    full = mix(prefixes.slices(prefixes.sums(data), start, start + depth))
    order = np.lexsort((at[own] + shift, doc[own], full, gram[own]))
    _, later = _repeats(gram[own[order]], full[order], doc[own[order]], (at[own] + shift)[order])
    hit = np.zeros(len(own), bool)
    hit[order] = later
    new = hit & ~np.concatenate([[False], hit[:-1] & (own[1:] == own[:-1])])
    end = hit & ~np.concatenate([hit[1:] & (own[1:] == own[:-1]), [False]])
    low, high = np.nonzero(new)[0], np.nonzero(end)[0]
    run = own[low]
    return REPEAT, gram[run], 0, doc[run], at[run] + shift[low], high - low + depth


def _opener(depth: int):
    """Opened runs as texts, and the suffixes of those to be spread, from documents with their lists of runs."""
    def open_runs(batches: Iterator) -> Iterator:
        prefixes = Prefixes(OPENED * 3 * depth)
        for batch in batches:
            todo: list[tuple[int, int, int, int, int, bytes]] = []
            for doc, value, found in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(),
                                         strict=True):
                text = value.as_buffer()
                for run in found or ():
                    todo.append((run["kind"], doc, run["at"], run["key"], run["span"],
                                 text.slice(run["at"], run["span"] + depth).to_pybytes()))
                    if len(todo) == OPENED:
                        yield from _opened(todo, depth, prefixes)
                        todo = []
            yield from _opened(todo, depth, prefixes)

    return open_runs


def _opened(todo: list, depth: int, prefixes: Prefixes):
    import pyarrow as pa

    columns = lambda rows: (np.array([t[i] for t in rows], np.int64) for i in range(1, 5))
    if whole := [t for t in todo if t[0] == OPEN]:
        doc, at, gram, span = columns(whole)
        rows = _batch((OPEN, gram, 0, doc, at, span))
        yield rows.append_column("text", pa.array([t[5] for t in whole], pa.binary()))
    if rest := [t for t in todo if t[0] == SPREAD]:
        data = np.frombuffer(b"".join(t[5] for t in rest), np.uint8)
        doc, at, gram, span = columns(rest)
        own, shift, start = _suffixes(span, depth)
        key = _signed(mix(prefixes.slices(prefixes.sums(data), start, start + depth)))
        sub, doc, at = gram[own], doc[own], at[own] + shift
        order = np.lexsort((at, doc, sub, key))
        key, sub, doc, at = (x[order] for x in (key, sub, doc, at))
        again, later = _repeats(key, sub, doc, at)
        rows = _batch((REPEAT, key[later], 0, doc[later], at[later], depth),
                      (WINDOW, key[~again], sub[~again], doc[~again], at[~again], 0))
        yield rows.append_column("text", pa.nulls(rows.num_rows, pa.binary()))


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted ranges without overlaps; ranges that touch are one."""
    out: list[list[int]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return [(a, b) for a, b in out]


def _cutter(depth: int):
    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            kept, removed, spans = [], [], []
            for value, found in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                text = value.as_buffer()
                ranges = merged([(r["at"], r["at"] + r["span"]) for r in found or ()])
                parts, at = [], 0
                for low, high in ranges:
                    parts.append(text.slice(at, low - at).to_pybytes())
                    at = high
                parts.append(text.slice(at).to_pybytes())
                kept.append(b"".join(parts))
                removed.append(sum(b - a for a, b in ranges))
                spans.append(ranges)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(k) + r for k, r in zip(kept, removed, strict=True)], pa.int64()),
                 pa.array(removed, pa.int64()), pa.array([len(s) for s in spans], pa.int64()),
                 pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()), pa.array(kept, pa.binary())],
                ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return cut


def _sorted_by_group(rows: DataFrame) -> DataFrame:
    # Rows that only pass through are dealt by their place, so a crowded gram's do not meet in one task.
    salt = F.when(F.col("kind") == SPREAD, F.xxhash64("doc", "at")).otherwise(F.lit(0))
    return rows.repartition(F.col("key"), salt).sortWithinPartitions("key", "sub", "doc", "at")


def _one_per_text(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each text of an id once, as documents ``id, text`` numbered in the order of id and text hash, and ``doc, own, copies``."""
    own = ["own", "hash", "hash2"]
    rows = texts.withColumns({"hash": F.xxhash64("text"), "hash2": F.xxhash64("text", F.lit(1))})
    once = stored(rows.groupBy(*own).agg(F.first("text").alias("text"), F.count("*").alias("copies")), "suffix-texts")
    narrow = stored(once.select(*own, "copies").repartitionByRange(*own).sortWithinPartitions(*own)
                    .withColumn("part", F.spark_partition_id()), "suffix-rows")
    parts = narrow.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    ahead = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("part").orderBy(*own)
    number = (F.row_number().over(inside) + F.col("ahead")).cast("long")
    numbers = stored(narrow.join(F.broadcast(ahead), "part").withColumn("doc", number).drop("part", "ahead"), "suffix-numbers")
    same = [once[c].eqNullSafe(numbers[c]) for c in own]
    documents = stored(once.join(numbers, same[0] & same[1] & same[2]).select(numbers["doc"].alias("id"), "text"), "suffix-documents")
    return documents, numbers.select("doc", "own", "copies")


def remove_repeats(docs: DataFrame, *, depth: int = DEPTH, id_col: str = "doc_id", text_col: str = "text",
                   with_kept: bool = True) -> DataFrame:
    """One row per input row: id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and the ``kept`` bytes.

    A byte goes if a string of ``depth`` bytes (32 to 100) that covers it also starts earlier: in a smaller id, or earlier in
    the same document. Strings are judged on the input and never cross documents. Ids are whole numbers; a null id comes
    before all others. A null text is empty. Each row is a document of its own: rows of one id come in the order of a hash of
    their texts, equal rows one after the other. An empty table gives no rows. Other columns are not read.
    """
    if depth < GRAM or depth > DEPTH:
        raise ValueError(f"depth must be {GRAM} to {DEPTH}")
    texts = docs.select(F.col(id_col).cast("long").alias("own"), text_of(text_col).cast("binary").alias("text"))
    least = F.lit(-(1 << 63))
    again = texts.select(F.coalesce("own", least).alias("id")).groupBy("id").agg(F.count("*").alias("n")).where("n > 1")
    numbers = None
    if again.limit(1).count():
        texts, numbers = _one_per_text(texts)
    else:
        texts = texts.select(F.coalesce("own", least).alias("id"), "text")
    rows = texts.mapInArrow(_first_pass(depth), ROW)
    marks = stored(_sorted_by_group(rows).mapInArrow(_group_pass(depth), ROW), "suffix-marks")

    ranges = lambda df, *more: df.groupBy("doc").agg(  # noqa: E731  a document's own ranges, as long as it is at most
        F.collect_list(F.struct("at", "span", *more)).alias("found"))
    opened = ranges(marks.where(F.col("kind").isin(OPEN, SPREAD)), "kind", "key")
    # Both joins read the texts from one shuffle.
    whole = (texts.join(opened, F.col("id") == F.col("doc"), "left").select("id", "text", "found")
             .mapInArrow(_opener(depth), TEXT_ROW))
    windows = _sorted_by_group(whole).mapInArrow(_group_pass(depth), ROW)
    repeats = (windows.unionByName(marks).where(F.col("kind") == REPEAT).select("doc", "at", "span"))
    done = (texts.join(ranges(repeats), F.col("id") == F.col("doc"), "left").select("id", "text", "found")
            .mapInArrow(_cutter(depth), "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"))
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * with_kept]
    if numbers is None:
        return done.select(F.when(F.col("id") != least, F.col("id")).alias(id_col), *names)
    # A further copy repeats the first one from end to end.
    long = F.col("n_bytes") >= depth
    nothing = F.lit(b"").cast("binary")
    later = {"n_removed": F.col("n_bytes"), "n_spans": F.lit(1).cast("long"), "kept_sha256": F.sha2(nothing, 256), "kept": nothing}
    every = (done.join(numbers, F.col("id") == F.col("doc"))
             .withColumn("turn", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))))
    return every.withColumns({c: F.when((F.col("turn") > 1) & long, v).otherwise(F.col(c)) for c, v in later.items()}
                             ).select(F.col("own").alias(id_col), *names)
