import datetime as dt
import gzip
import json
import os

import pytest

from weir import (
    Rule, RuleSet, SEND_ALL, apply_rule, call, concat, emit_envelope, publish, read_batches, register_function,
    register_sink, register_source, route, source, write_batches,
)
from weir.operators import metrics


def frame(spark, n=60):
    at = dt.datetime(2024, 1, 1, 0, 5)
    rows = [(i, f"s{i % 2}", at + dt.timedelta(seconds=i), json.dumps({"i": i})) for i in range(n)]
    return spark.createDataFrame(rows, "i int, shard_id string, arrival_ts timestamp, record string")


def test_batch_files(spark, tmp_path):
    sent = apply_rule(frame(spark), Rule("all", "batch", send=SEND_ALL))
    path = str(tmp_path / "out")
    write_batches(sent, path, ["i"], seconds=30, max_bytes=64)
    lines = read_batches(spark, path).collect()
    assert sorted(json.loads(r.value)["i"] for r in lines) == list(range(60))
    assert {(r.dt, r.hm) for r in lines} == {("2024-01-01", "0005")}
    files = [os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".gz")]
    assert len(files) == len({r.batch for r in lines})
    for name in files:
        body = gzip.open(name, "rt").read()
        numbers = [json.loads(line)["i"] for line in body.splitlines()]
        assert body.endswith("\n") and numbers == sorted(numbers)
        assert max(numbers) // 30 == min(numbers) // 30 and len({n % 2 for n in numbers}) == 1
        assert len(body) - len(body.splitlines()[-1]) - 1 < 64


def test_records_without_a_time_are_kept(spark, tmp_path):
    sent = spark.createDataFrame([(1, "s", None, "a"), (2, "s", dt.datetime(1969, 12, 31, 23, 59, 59), "b")],
                                 "i int, shard_id string, arrival_ts timestamp, outbound string")
    write_batches(sent, str(tmp_path / "o"), ["i"])
    assert {(r.value, r.hm) for r in read_batches(spark, str(tmp_path / "o")).collect()} == {("a", None), ("b", "2359")}


def test_emit_envelope(spark):
    out = emit_envelope(spark.createDataFrame([(1, "é"), (2, ""), (3, None)], "i int, outbound string")).collect()
    assert [None if r.data is None else gzip.decompress(bytes(r.data)).decode() for r in out] == ["é", "", None]
    assert len({r.partition_key for r in out}) == 3


def test_publish_follows_the_checkpoint_flag(spark, tmp_path):
    got = {}

    def broken(matches, batch_id, params):
        raise OSError("full")

    register_sink("broken", broken)
    register_sink("list", lambda m, b, p: got.setdefault(b, []).extend(r.outbound for r in m.collect()))
    rules = RuleSet([Rule("bad", "broken", checkpoint=False), Rule("good", "list", send=lambda r: {"i": r.json("i")}),
                     Rule("log", "debug", send=SEND_ALL),
                     Rule("out", "emit", send=SEND_ALL, params={"format": "parquet", "path": str(tmp_path / "e")})])
    routed = route(frame(spark, 4), rules)
    assert publish(routed, rules, 7) == ["bad"]
    assert publish(routed, RuleSet([Rule("good", "list"), Rule("log", "list")]), 8) == []
    assert len(got[8]) == 8
    assert sorted(got[7]) == [f'{{"i":{i}}}' for i in range(4)]
    assert spark.read.parquet(f"{tmp_path}/e/b7").count() == 4
    with pytest.raises(OSError):
        publish(routed, RuleSet([Rule("bad", "broken", checkpoint=True)]))
    with pytest.raises(KeyError):
        publish(routed, RuleSet([Rule("x", "nowhere")]))


def test_registries(spark):
    register_function("SHOUT", lambda x: concat(x, "!"))
    register_source("numbers", lambda s, n: frame(s, n))
    out = apply_rule(source("numbers", spark, n=2), Rule("r", "debug", send=lambda r: {"x": call("SHOUT", r.json("i"))}))
    assert sorted(r.outbound for r in out.collect()) == ['{"x":"0!"}', '{"x":"1!"}']


def test_metric_reduction(spark):
    at = dt.datetime(2024, 1, 1)
    points = spark.createDataFrame([
        ("a", "gauge", 1.0, {"x": "1", "y": "2"}, at), ("a", "gauge", 5.0, {"y": "2", "x": "1"}, at + dt.timedelta(seconds=1)),
        ("b", "counter", 2.0, None, at), ("b", "counter", 3.0, {}, at), ("b", "counter", 4.0, {"r": "own"}, at),
    ], metrics.METRIC_SCHEMA)
    assert [(r.name, r.dims, r.value) for r in metrics.gauges(points).collect()] == [("a", {"x": "1", "y": "2"}, 5.0)]
    based = metrics.counters(metrics.with_dims(points, {"r": "base"})).collect()
    assert sorted((r.dims["r"], r.value) for r in based) == [("base", 5.0), ("own", 4.0)]


def test_batches_of_records_without_a_time_obey_the_size(spark, tmp_path):
    df = spark.range(40).selectExpr("id", "'s' AS shard_id", "CAST(NULL AS timestamp) AS arrival_ts",
                                    "repeat('x', 99) AS outbound")
    write_batches(df, str(tmp_path / "b"), ["id"], max_bytes=1000)
    per_batch = read_batches(spark, str(tmp_path / "b")).groupBy("batch").count().collect()
    assert sum(r["count"] for r in per_batch) == 40 and len(per_batch) >= 4
    assert max(r["count"] for r in per_batch) <= 11
