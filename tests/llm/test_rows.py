"""Rows that share an id, have none or are equal; very long texts; large numbers."""

import hashlib
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from weir.llm import common, dart_minhash, mixing, packing, suffixes, topk, toxicity


def words(n, seed, size=300):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{x}" for x in rng.integers(0, size, n))


def plain_repeats(rows, depth):
    """``rows`` in order; each a document of its own."""
    seen, out = set(), []
    for own, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - depth + 1):
            part = data[s : s + depth]
            if part in seen:
                gone[s : s + depth] = b"\1" * depth
            seen.add(part)
        kept = bytes(c for c, g in zip(data, gone) if not g)
        spans = sum(1 for g, _ in itertools.groupby(gone) if g)
        out.append((own, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


@pytest.mark.parametrize("depth", [40, 100])
def test_repeats_among_rows_of_one_id(spark, depth):
    line, other = words(40, 1), words(60, 2)
    rows = [(1, f"{words(20, 3)} {line}"), (1, f"{line} {words(50, 4)}"), (1, "short"), (1, other), (1, other), (1, other),
            (2, f"{words(5, 5)} {line} {words(5, 6)} {other}"), (None, line), (None, line), (None, words(30, 7)), (None, None),
            (3, "x" * 80), (4, "x" * 80), (4, "x" * 80), (5, None), (5, ""), (-(1 << 63), words(9, 8))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    ordered = [tuple(r)[:2] for r in df.orderBy(F.col("doc_id").asc_nulls_first(), F.xxhash64(F.coalesce("text", F.lit("")).cast("binary")))
               .collect()]
    got = [(r[0], *r[1:5], bytes(r[5])) for r in suffixes.remove_repeats(df, depth=depth).collect()]
    assert sorted(got, key=str) == sorted(plain_repeats(ordered, depth), key=str)


def test_repeats_shorter_than_the_contract(spark):
    df = spark.createDataFrame([(1, "ab" + "c" * 30 + words(9, 1)), (2, words(9, 1) + words(12, 2)[:40])], "doc_id long, text string")
    rows = [tuple(r) for r in df.orderBy("doc_id").collect()]
    got = [(r[0], *r[1:5], bytes(r[5])) for r in suffixes.remove_repeats(df, depth=32).orderBy("doc_id").collect()]
    assert got == plain_repeats(rows, 32)


def test_repeats_over_pieces_of_long_texts(spark):
    rng = np.random.default_rng(1)
    long = bytes(rng.integers(97, 123, (1 << 20) + 5000).astype(np.uint8)).decode()
    df = spark.createDataFrame([(1, long), (2, "z" * 50 + long[(1 << 20) - 300 : (1 << 20) + 300]), (3, long[-2000:])], "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in suffixes.remove_repeats(df, with_kept=False).collect()}
    assert got == {1: (0, 0), 2: (600, 1), 3: (2000, 1)}


def test_each_text_of_an_id_keeps_its_links(spark):
    base = words(120, 1).split()
    near = [*base[:59], "changed", *base[60:]]
    rows = [(7, " ".join(base)), (7, words(120, 2)), (8, " ".join(near)), (9, words(120, 2)), (10, words(80, 3)), (10, words(80, 3)),
            (None, " ".join(base)), (11, None), (12, "")]
    got = {r.doc_id: (r.class_id, r.class_size) for r in
           dart_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {7: (7, 3), 8: (7, 3), 9: (7, 3), 10: (10, 1), 11: (11, 2), 12: (11, 2)}


@pytest.mark.parametrize("weighted", [True, False])
def test_classes_are_those_of_all_pairs(spark, sf_dir, weighted):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    shingler = dart_minhash.Shingler()
    rows = docs.select("doc_id", dart_minhash.normal(F.col("text")).alias("n"), "text").collect()
    sets = dict(zip([r.doc_id for r in rows], shingler.sets([r.n for r in rows])))
    above = {r.doc_id: r.doc_id for r in rows}

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    for a, b in itertools.combinations(rows, 2):
        both = a.text == b.text if not (a.n and b.n) else (
            dart_minhash.similarity(*sets[a.doc_id], *sets[b.doc_id], weighted) >= dart_minhash.LEAST)
        if both:
            low, high = sorted((top(a.doc_id), top(b.doc_id)))
            above[high] = low
    got = {r.doc_id: r.class_id for r in dart_minhash.near_duplicates(docs, weighted=weighted).collect()}
    assert got == {i: top(i) for i in above}
    assert len(set(got.values())) < len(got)


def test_products_up_to_the_bound():
    rng = np.random.default_rng(3)
    vectors = np.floor(rng.normal(size=(4096, 2)) * 2.0**23)
    vectors[17] = [2.0**25, 2.0**25 - 1]
    ids, exact = np.arange(4096), (vectors.astype(np.int64)[:8] @ vectors.astype(np.int64).T)
    query_ids, found, score = topk._finder(5, 256)(ids[:8], vectors[:8], ids, vectors)
    assert 2**49 < exact.max() < 2**53
    for q in range(8):
        want = sorted((-int(exact[q, i]), i) for i in range(4096) if i != q)[:5]
        assert sorted((-int(s), int(i)) for s, i in zip(score[query_ids == q], found[query_ids == q])) == want


def test_ties_beyond_the_composite_order():
    score = np.array([[5, 5, 5, 1], [1 << 61, 7, 1 << 61, 7]])
    place = np.array([[3, 1, 2, 0], [9, 2, 4, 1]])
    top, at = topk._first(score, place, 2, 10)
    assert sorted(zip(top[0], at[0])) == [(5, 1), (5, 2)] and sorted(zip(top[1], at[1])) == [(1 << 61, 4), (1 << 61, 9)]


def test_the_text_a_repeated_id_is_learned_by_is_fixed(spark):
    rows = [(i, f"fool {words(8, i)}" if i % 2 else words(8, i)) for i in range(120)] + [(2, "fool fool"), (4, "aaa")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)] + [(2, None), (999, 1), (None, 1)], "doc_id long, toxic int")
    models = [toxicity.learn(spark.createDataFrame(r, "doc_id long, text string").repartition(n), labels)
              for r, n in ((rows, 1), (rows[::-1], 5))]
    assert models[0].lexicon == models[1].lexicon and "fool" in models[0].lexicon.words
    texts = ["you fool", "nothing here", ""]
    scores = [toxicity.score_toxicity(spark.createDataFrame([(t,) for t in texts], "text string"), m).collect() for m in models]
    assert sorted(scores[0]) == sorted(scores[1])


def test_the_sieve_keeps_every_id_and_few_others(spark):
    texts = spark.range(20000).withColumn("text", F.lit("t"))
    ids = spark.range(0, 20000, 10)
    kept = common.sieve(texts, ids, "id").select("id")
    assert ids.join(kept, "id", "left_anti").count() == 0 and kept.count() < 0.3 * 20000


def test_places_follow_the_files(spark, tmp_path):
    df = spark.range(1000).repartitionByRange(7, F.desc("id")).sortWithinPartitions(F.desc("id"))
    df.write.option("maxRecordsPerFile", 40).parquet(str(tmp_path / "t"))
    placed = mixing.row_place(spark.read.parquet(str(tmp_path / "t")))
    assert [r.id for r in placed.orderBy("place").collect()] == list(range(999, -1, -1))
    assert mixing.row_place(spark.createDataFrame([(1,), (2,)], "place long")).select("place").distinct().count() == 2


def test_cuts_are_found_by_halving(spark):
    for cuts in ([], [5], [1, 4, 6, 9, 20], list(range(0, 300, 3))):
        got = spark.range(-3, 310).select("id", packing._bucket(F.col("id"), cuts).alias("b")).collect()
        assert all(r.b == sum(c <= r.id for c in cuts) for r in got)


def test_more_sources_get_finer_weights():
    weights = mixing.tempered({i: 1 for i in range(600)}, 1.0)
    assert len(set(weights.values())) == 1
    spread = mixing.tempered({i: 100 if i else 150 for i in range(600)}, 1.0)
    assert spread[0] / spread[1] > 1.4
