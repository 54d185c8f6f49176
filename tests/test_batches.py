"""Batches by size or age against one pass over the records."""

import datetime as dt
import random

import pytest

from weir import batch_by_size_or_age

BEGIN = dt.datetime(2024, 1, 1)


def one_by_one(rows, max_bytes, seconds):
    """``rows``: (shard, i, time or None, record), in order within a shard."""
    state, out = {}, {}
    for shard, i, time, record in rows:
        batch, size, first, latest = state.get(shard, (-1, 0, None, dt.datetime(1970, 1, 1)))
        latest = max(latest, time or latest)
        if batch < 0 or size >= max_bytes or (latest - first).total_seconds() >= seconds:
            batch, size, first = batch + 1, 0, latest
        state[shard] = batch, size + len(record) + 1, first, latest
        out[shard, i] = batch
    return out


@pytest.mark.parametrize("max_bytes, seconds", [(60, 10**6), (10**6, 300), (80, 240)])
def test_cut_by_whichever_comes_first(spark, max_bytes, seconds):
    rng, rows, clock = random.Random(max_bytes), [], 0
    for i in range(400):
        clock += rng.choice([0, 0, 5, 60, 400])
        time = BEGIN + dt.timedelta(seconds=clock - rng.choice([0, 0, 0, 90]))
        rows.append((rng.choice(["hot", "hot", "a", "b", None]), i, time if rng.random() > 0.1 else None, "x" * rng.randint(0, 25)))
    df = spark.createDataFrame(rows, "shard_id string, i long, arrival_ts timestamp, record string")
    got = batch_by_size_or_age(df.repartition(5), max_bytes, seconds, ["i"])
    assert got.columns == [*df.columns, "batch"]
    assert {(r.shard_id, r.i): r.batch for r in got.collect()} == one_by_one(rows, max_bytes, seconds)


def test_edges(spark):
    schema = "shard_id string, i long, arrival_ts timestamp, record string, batch string"
    assert batch_by_size_or_age(spark.createDataFrame([], schema), 10, 10, ["i"]).count() == 0
    same = spark.createDataFrame([("a", 1, BEGIN, "xxxx", "old")] * 5, schema)
    assert sorted(r.batch for r in batch_by_size_or_age(same, 10, 10, ["i"], scope=[]).collect()) == [0, 0, 1, 1, 2]
    with pytest.raises(ValueError):
        batch_by_size_or_age(same, 0, 10, ["i"])
