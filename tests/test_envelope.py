import datetime as dt
import random

import pyarrow as pa
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from weir import ENVELOPE, decode_snappy, deaggregate, drop_empty, from_position, tail_positions
from weir.operators import progress
from weir.sources import aggregated as split

MAGIC = b"\xf3\x89\x9a\xc2"


def varint(n):
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out + bytes([n]))


def field(number, body):
    return varint(number << 3 | 2) + varint(len(body)) + body


def aggregated(payloads, digest=b"\0" * 16):
    tag = field(4, field(1, b"tag") + field(2, b"x" * 300))
    records = b"".join(field(3, varint(8) + varint(200) + varint(16) + varint(1) + field(3, p) + tag) for p in payloads)
    return MAGIC + field(1, b"pk1") + field(1, b"pk2") + field(2, b"ehk") + records + digest


def envelopes(spark, datas):
    at = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([("s", str(i), "p", at, d) for i, d in enumerate(datas)], ENVELOPE)


def unpacked(df):
    return sorted((int(r.sequence_number), r.sub_seq, None if r.data is None else bytes(r.data)) for r in df.collect())


def test_deaggregate(spark):
    datas = [b"plain", aggregated([b"a", b"", b"c" * 500]), b"abc", b"", aggregated([]), None, MAGIC[:3]]
    out = deaggregate(envelopes(spark, datas))
    assert out.columns == ["shard_id", "sequence_number", "partition_key", "arrival_ts", "data", "sub_seq"]
    assert sorted(unpacked(out), key=str) == sorted(
        [(0, 0, b"plain"), (1, 0, b"a"), (1, 1, b""), (1, 2, b"c" * 500), (2, 0, b"abc"), (3, 0, b""), (5, 0, None),
         (6, 0, MAGIC[:3])], key=str)


@pytest.mark.parametrize("bad", [MAGIC, MAGIC + b"\0" * 5, aggregated([b"a"])[:-20] + b"\0" * 3,
                                 MAGIC + field(3, b"\x08\x01") + b"\0" * 16])
def test_malformed_aggregates(spark, bad):
    df = envelopes(spark, [b"ok", bad, aggregated([b"x"])])
    with pytest.raises(PythonException):
        deaggregate(df).collect()
    assert unpacked(deaggregate(df, mode="DROPMALFORMED")) == [(0, 0, b"ok"), (2, 0, b"x")]
    assert unpacked(deaggregate(df, mode="PERMISSIVE")) == [(0, 0, b"ok"), (1, 0, None), (2, 0, b"x")]


def test_snappy(spark):
    codec = pa.Codec("snappy")
    texts = ["", "{}", "é" * 5000]
    datas = [codec.compress(t.encode(), asbytes=True) for t in texts]
    out = decode_snappy(envelopes(spark, datas))
    assert {int(r.sequence_number): r.record for r in out.collect()} == dict(enumerate(texts))
    assert drop_empty(out).count() == 2
    bad = envelopes(spark, [*datas, b"\xff\xff\xff\xff\x0f", b"\x05abc", b"", None])
    with pytest.raises(PythonException):
        decode_snappy(bad).collect()
    assert decode_snappy(bad, mode="DROPMALFORMED").count() == 3
    assert decode_snappy(bad, mode="PERMISSIVE").where("record is null").count() == 4
    with pytest.raises(ValueError):
        decode_snappy(bad, mode="LENIENT")


def test_every_event_of_ten_shards_exactly_once(spark):
    rng = random.Random(1)
    codec = pa.Codec("snappy")
    rows, at = [], dt.datetime(2024, 1, 1)
    pending = list(range(2750))
    while pending:
        size = rng.randint(1, 9)
        part, pending = pending[:size], pending[size:]
        packed = [codec.compress(str(n).encode(), asbytes=True) for n in part]
        rows.append((f"shard-{rng.randint(0, 9)}", str(part[0] + 1), "k", at, packed[0] if size == 1 else aggregated(packed)))
    out = decode_snappy(deaggregate(spark.createDataFrame(rows, ENVELOPE).repartition(8)))
    assert sorted(int(r.record) for r in out.select("record").collect()) == list(range(2750))


def test_positions_follow_number_order_of_texts(spark):
    df = spark.createDataFrame([("a", n) for n in ("9", "10", "100")] + [("b", "7"), ("c", "1" * 60), ("c", "2" * 60)],
                               "shard_id string, sequence_number string")
    assert {tuple(r) for r in tail_positions(df).collect()} == {("a", "100"), ("b", "7"), ("c", "2" * 60)}
    at = spark.createDataFrame([("a", "10"), ("b", None), ("c", "1" * 60)], df.schema)
    read = lambda mode: {tuple(r) for r in from_position(df, mode, at).collect()}
    assert read("AFTER") == {("a", "100"), ("b", "7"), ("c", "2" * 60)}
    assert read("AT") == read("AFTER") | {("a", "10"), ("c", "1" * 60)}
    assert from_position(df, "LATEST").count() == 0 and from_position(df, "TRIM_HORIZON").count() == 6
    with pytest.raises(ValueError):
        from_position(df, "AT")


def test_progress_life_cycle(spark):
    state = spark.createDataFrame([], progress.PROGRESS_SCHEMA)
    clock = iter(range(10))

    def commit(state, *moves):
        batch = spark.createDataFrame(list(moves), "shard_id string, sequence_number string")
        at = F.timestamp_seconds(F.lit(next(clock)))
        return spark.createDataFrame(progress.commit(state, batch, at).collect(), progress.PROGRESS_SCHEMA)

    def seen(state):
        return {r.shard_id: (r.sequence_number, r.last_update.second) for r in state.collect()}

    state = commit(state, ("a", "9"), ("b", "5"))
    state = commit(state, ("a", "9"))
    assert seen(state) == {"a": ("9", 0), "b": ("5", 0)}
    state = commit(state, ("a", "10"), ("b", "4"))
    assert seen(state) == {"a": ("10", 2), "b": ("5", 0)}
    ends = spark.createDataFrame([("a", "10"), ("b", "6")], "shard_id string, final_sequence string")
    done = progress.finish(state, ends)
    assert [r.shard_id for r in progress.finished_shards(done).collect()] == ["a"]


def test_array_steps_agree_with_a_plain_loop(monkeypatch):
    rng = random.Random(3)
    bodies = [[rng.randbytes(rng.choice([0, 1, 40, 300])) for _ in range(rng.choice([0, 1, 3, 30]))] for _ in range(600)]
    values = [aggregated(b) for b in bodies]
    assert split.payloads(pa.array(values), True).to_pylist() == bodies
    for i in range(0, 600, 3):
        broken = bytearray(values[i])
        broken[rng.randrange(4, len(broken))] = rng.randrange(256)
        values[i] = bytes(broken[:rng.randrange(4, len(broken))] if i % 2 else broken)
    # Numbers of ten bytes, unknown wire types, sizes beyond the end, a record without a payload.
    values += [MAGIC + b + b"\0" * 16 for b in (
        field(1, b"k") + b"\x10" + b"\xff" * 9 + b"\x01" + field(3, field(3, b"long")), b"\x1b\x00", b"\x1a\xff\xff\xff\xff\xff\xff\xff\xff\x7f",
        field(3, b"\x08\x01"), b"\x1a", b"\x80" * 30, b"\x09" + b"\0" * 8 + b"\x0d" + b"\0" * 4 + field(3, field(3, b"a") + field(3, b"b")))]
    values[5::50] = [None] * len(values[5::50])
    batch = pa.array(values, pa.binary())
    monkeypatch.setattr(split, "_FEW", 10**9)
    wanted = split.payloads(batch, False)
    monkeypatch.setattr(split, "_FEW", 0)
    assert split.payloads(batch, False).equals(wanted)
    assert split.payloads(batch.slice(100, 50), False).equals(pa.concat_arrays([wanted.slice(100, 50)]))
    assert wanted.to_pylist()[-7:] == [[b"long"], None, None, None, None, None, [b"b"]]
    for empty in ([], [None, None], [MAGIC, None]):
        assert split.payloads(pa.array(empty, pa.binary()), False).to_pylist() == [None] * len(empty)
