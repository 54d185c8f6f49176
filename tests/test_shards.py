"""Shard logs: appends, positions, limits, restarts."""

import datetime as dt
import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from weir import append_records, read_once, read_shards, shard_stream
from weir.sinks.once import OnceSink
from weir.sources import shards
from weir.sources.envelope import ENVELOPE
from weir.sources.shards import SegmentLog, ShardReader, read_json


def envelopes(spark, rows):
    at = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(s, str(n), "k", at, f"{s}{n}".encode()) for s, n in rows], ENVELOPE)


def everything(reader, start, end):
    out = []
    for part in reader.partitions(start, end):
        for batch in reader.read(part):
            out += zip(batch.column("shard_id").to_pylist(), map(int, batch.column("sequence_number").to_pylist()))
    return sorted(out)


def test_appends_are_seen_whole_or_not_at_all(spark, tmp_path):
    folder = str(tmp_path / "log")
    rows = [("a", n) for n in range(5, 120)] + [("b", 10**30 + n) for n in range(10)]
    assert append_records(envelopes(spark, rows), folder, segment_records=20) >= 7
    assert append_records(envelopes(spark, []), folder) == 0
    envelopes(spark, [("a", 500)]).write.parquet(f"{folder}/data/left-by-a-crash")
    assert read_shards(spark, folder).count() == len(rows)
    assert SegmentLog(folder).tails() == {"a": "119", "b": str(10**30 + 9)}
    for behind in ([("a", 119)], [("a", 120), ("b", 7)], [(None, 1)]):
        with pytest.raises(ValueError):
            append_records(envelopes(spark, behind), folder)
    assert append_records(envelopes(spark, [("a", 120), ("c", 1)]), folder) == 2
    assert read_shards(spark, folder).count() == len(rows) + 2
    assert read_shards(spark, str(tmp_path / "none")).count() == 0


def test_offsets_follow_positions_and_limits(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "log")
    rows = [("hot", n) for n in range(1, 301)] + [("cold", n) for n in range(1, 11)]
    append_records(envelopes(spark, rows), folder, segment_records=40)
    monkeypatch.setattr(shards, "TASK_RECORDS", 15)
    reader = ShardReader({"path": folder, "records": "60", "progress": str(tmp_path / "p")})
    at, steps, seen = reader.initialOffset(), 0, []
    while (end := reader.latestOffset()) != at:
        parts = reader.partitions(at, end)
        assert all(p.rows <= 15 for p in parts)  # a hot shard is read by several tasks
        got = everything(reader, at, end)
        assert 0 < len(got) <= 60
        seen, at, steps = seen + got, end, steps + 1
    assert sorted(seen) == sorted(rows) and steps >= 6
    for start, first in (("AT", 250), ("AFTER", 251)):
        reader = ShardReader({"path": folder, "start": start, "positions": json.dumps({"hot": "250"})})
        got = everything(reader, reader.initialOffset(), reader.latestOffset())
        assert got == sorted([("hot", n) for n in range(first, 301)] + [("cold", n) for n in range(1, 11)])
    reader = ShardReader({"path": folder, "start": "LATEST"})
    start = reader.initialOffset()
    assert everything(reader, start, reader.latestOffset()) == []
    append_records(envelopes(spark, [("hot", 301), ("new", 1)]), folder)
    assert everything(reader, start, reader.latestOffset()) == [("hot", 301), ("new", 1)]


def test_a_restarted_reader_goes_on_where_spark_stands(spark, tmp_path):
    folder, options = str(tmp_path / "log"), {"path": str(tmp_path / "log"), "records": "10", "progress": str(tmp_path / "p")}
    append_records(envelopes(spark, [("a", n) for n in range(1, 101)]), folder, segment_records=10)
    reader = ShardReader(options)
    first = reader.latestOffset()
    reader.partitions(reader.initialOffset(), first)
    second = ShardReader({**options, "records": "5"}).latestOffset()
    assert everything(ShardReader(options), first, second) and order(second) > order(first)
    # A batch that was planned but not finished is planned again as it was.
    assert everything(ShardReader(options), {}, first) == [("a", n) for n in range(1, order(first) + 1)]


def order(offset):
    return int(offset["a"]["sequence"])


def test_every_row_once_over_stops_and_starts(spark, tmp_path):
    folder, out = str(tmp_path / "log"), str(tmp_path / "out")
    spark.dataSource.register(OnceSink)
    rows = [(s, n) for s in "abc" for n in range(1, 60 if s != "a" else 400)]
    append_records(envelopes(spark, rows), folder, segment_records=25)
    for upto in (3, 5, None):
        stream = shard_stream(spark, folder, records=50, progress=f"{tmp_path}/source")
        query = (stream.writeStream.format("weir_once").option("path", out).option("checkpointLocation", f"{tmp_path}/p")
                 .trigger(processingTime="0 seconds").start())
        if upto is None:
            query.processAllAvailable()
        for _ in range(1200):
            if upto is None or not query.isActive or (query.lastProgress or {"batchId": -1})["batchId"] + 1 >= upto:
                break
            query.awaitTermination(0.05)
        assert query.exception() is None
        query.stop()
    got = [(r.shard_id, int(r.sequence_number), bytes(r.data)) for r in read_once(spark, out, ENVELOPE).collect()]
    assert sorted(got) == sorted((s, n, f"{s}{n}".encode()) for s, n in rows)
    assert len(os.listdir(f"{out}/batches/default")) >= 10
    assert set(read_json(f"{tmp_path}/source", "committed.json")) == {"a", "b", "c"}


def test_arguments(spark, tmp_path):
    for bad in ({"start": "AT"}, {"start": "NOW"}, {"positions": {"a": "1"}}, {"records": 5}):
        with pytest.raises(ValueError):
            shard_stream(spark, str(tmp_path), **bad)


@pytest.mark.parametrize("groups", [50_000, 7_000])
def test_a_task_holds_little_of_a_large_segment(tmp_path, groups):
    n, file = 50_000, f"{tmp_path}/segment.parquet"
    pq.write_table(pa.table({
        "shard_id": ["s"] * n, "sequence_number": [str(i) for i in range(n)], "partition_key": ["k"] * n,
        "arrival_ts": pa.array(range(n), pa.timestamp("us", "UTC")), "data": [b"%d" % i for i in range(n)]}), file, row_group_size=groups)
    reader = shards.ShardReader({"path": str(tmp_path)})
    whole = [*reader.read(shards._Part(file, 20_500, 25_000, None, None))]
    assert [v for b in whole for v in b.column("data").to_pylist()] == [b"%d" % i for i in range(20_500, 45_500)]
    assert max(map(len, whole)) <= shards.READ_ROWS
    cut = [*reader.read(shards._Part(file, 20_500, 25_000, {"sequence": "30000", "inclusive": True}, "40000"))]
    assert [v for b in cut for v in b.column("sequence_number").to_pylist()] == [str(i) for i in range(30_000, 40_001)]


def test_only_the_segment_with_the_position_is_looked_through(tmp_path):
    folder = str(tmp_path)
    entry = [{"file": f"data/{i}", "shard": "s", "first": str(i), "last": str(i + 9), "at": 0, "rows": 10} for i in range(10, 60, 10)]
    shards.write_json(f"{folder}/log", "000000000000.json", entry)
    found = shards.ShardReader({"path": folder}).partitions(
        {"s": {"sequence": "24", "inclusive": False}}, {"s": {"sequence": "45", "inclusive": False}})
    assert [(p.file[-2:], p.after and p.after["sequence"], p.upto) for p in found] == [("20", "24", None), ("30", None, None), ("40", None, "45")]
