"""The store of keys against a dictionary, over many micro-batches."""

import os
import random

import pytest
from pyspark.sql import types as T

from weir.streaming.store import KeyStore, live_runs, merges_after

KEYS, VALUES = [T.StructField("k", T.StringType())], [T.StructField("v", T.LongType())]


def test_runs_cover_every_micro_batch_once():
    for fanout in (2, 3, 8):
        made = set()
        for n in range(200):
            covered = [b for level, first in live_runs(n, fanout) for b in range(first, first + fanout**level)]
            assert covered == list(range(n)) and set(live_runs(n, fanout)) <= made
            made |= {(0, n), *merges_after(n, fanout)}
        assert len(list(live_runs(8**4 - 1))) == 28


def frame(spark, rows, fields):
    return spark.createDataFrame(rows, T.StructType(fields))


@pytest.mark.parametrize("remember", [None, 4])
def test_like_a_dictionary(spark, tmp_path, remember):
    rng, want, written = random.Random(remember or 0), {}, {}
    names = [None, *map(str, range(12))]

    def step(n, store, puts, gone):
        store.put(frame(spark, puts, KEYS + VALUES))
        store.remove(frame(spark, [(k,) for k in gone], KEYS))
        store.save()

    for n in range(9):
        if remember is not None:
            want = {k: v for k, v in want.items() if written[k] >= n - remember}
        asked = rng.sample(names, 4)
        store = KeyStore(spark, str(tmp_path), KEYS, VALUES, n, remember=remember, fanout=2)
        assert {r.k: r.v for r in store.rows().collect()} == want
        assert {r.k: r.v for r in store.lookup(frame(spark, [(k,) for k in asked], KEYS)).collect()} == {
            k: v for k, v in want.items() if k in asked}
        new = store.unknown(frame(spark, [(k,) for k in asked], KEYS), ["k"])
        assert sorted(map(str, [r.k for r in new.collect()])) == sorted(map(str, [k for k in asked if k not in want]))
        touched = rng.sample(names, 4)
        puts, gone = [(k, 100 * n + i) for i, k in enumerate(touched[:3])], touched[3:]
        if n % 5 == 3:  # a micro-batch that failed after it had written
            step(n, KeyStore(spark, str(tmp_path), KEYS, VALUES, n, remember=remember, fanout=2), [("lost", 1)], [])
        step(n, store, puts, gone)
        for k, v in puts:
            want[k], written[k] = v, n
        for k in gone:
            want.pop(k, None)
    store = KeyStore(spark, str(tmp_path), KEYS, VALUES, 9, remember=remember, fanout=2)
    if remember is None:
        assert store.count() == len(want)
    store.clear()
    store.save()
    assert KeyStore(spark, str(tmp_path), KEYS, VALUES, 10, remember=remember, fanout=2).rows().count() == 0


def test_no_key_and_no_value(spark, tmp_path):
    for n in range(3):
        store = KeyStore(spark, str(tmp_path / "one"), [], VALUES, n, fanout=2)
        assert [r.v for r in store.rows().collect()] == ([n - 1] if n else [])
        store.put(frame(spark, [(n,)], VALUES))
        store.save()
        seen = KeyStore(spark, str(tmp_path / "set"), KEYS, [], n, fanout=2)
        assert seen.count() == n
        seen.put(frame(spark, [(str(n),)], KEYS))
        seen.save()


def test_what_is_written_follows_what_changed(spark, tmp_path):
    def size(path):
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(path) for f in files if f.endswith(".parquet"))

    big = spark.range(50_000).selectExpr("cast(id AS string) AS k", "id AS v")
    for n in range(5):
        store = KeyStore(spark, str(tmp_path), KEYS, VALUES, n)
        store.put(big if n == 0 else frame(spark, [(str(n), -n)], KEYS + VALUES))
        store.save()
    assert size(tmp_path / "level=0" / "first=4") < 0.01 * size(tmp_path / "level=0" / "first=0")
    assert KeyStore(spark, str(tmp_path), KEYS, VALUES, 5).rows().where("v < 0").count() == 4


def test_merged_runs_go(spark, tmp_path):
    for n in range(7):
        store = KeyStore(spark, str(tmp_path), KEYS, VALUES, n, fanout=2)
        store.put(frame(spark, [(str(n), n)], KEYS + VALUES))
        store.save()
    left = {(int(level[6:]), int(first[6:])) for level in os.listdir(tmp_path) for first in os.listdir(tmp_path / level)}
    assert set(live_runs(7, 2)) <= left and (0, 0) not in left and (1, 0) not in left and len(left) <= 6
