import datetime as dt
import json
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from catalog.state import _in_ten_turns
from weir import Rule, RuleSet, StreamCache, eq, join_, register_sink, route, run_router, stream_cache, stream_unique, unique_flag
from weir.operators import metrics, progress

SCHEMA = "i long, u string, ts timestamp, record string"


def add(spark, folder, numbers):
    rows = [(n, "abc"[n % 3], dt.datetime(2024, 1, 1) + dt.timedelta(minutes=n), json.dumps({"i": n, "odd": n % 2}))
            for n in numbers]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def test_failure_repeats_the_micro_batch_and_loses_nothing(spark, tmp_path):
    folder, where = str(tmp_path / "in"), str(tmp_path / "progress")
    got, state = {}, {"fail": True}

    def keep(matches, batch_id, params):
        rows = [json.loads(r.outbound)["i"] for r in matches.collect()]
        if state["fail"] and batch_id == 1:
            raise OSError("sink is down")
        got[batch_id] = rows

    register_sink("kept", keep)
    rules = RuleSet([Rule("odd", "kept", when=lambda r: eq(r.json("odd"), 1), send=lambda r: {"i": r.json("i")})])
    for part in (range(0, 10), range(10, 20), range(20, 30)):
        add(spark, folder, part)
    with pytest.raises(StreamingQueryException):
        run_router(stream(spark, folder), rules, where).awaitTermination()
    assert sorted(got) == [0]
    state["fail"] = False
    run_router(stream(spark, folder), rules, where).awaitTermination()
    assert sorted(n for rows in got.values() for n in rows) == list(range(1, 30, 2))
    add(spark, folder, range(30, 36))
    committed = []
    run_router(stream(spark, folder), rules, where, after=lambda b, i: committed.append(
        progress.last_sequences(b.select(F.col("u").alias("shard_id"), F.col("i").cast("string").alias("sequence_number"))).collect())
    ).awaitTermination()
    assert sorted(n for rows in got.values() for n in rows) == list(range(1, 36, 2))
    assert {(r.shard_id, r.sequence_number) for r in committed[0]} == {("a", "33"), ("b", "34"), ("c", "35")}


def test_failure_of_a_rule_without_checkpoint_is_passed_over(spark, tmp_path):
    folder = str(tmp_path / "in")
    add(spark, folder, range(5))

    def broken(matches, batch_id, params):
        raise OSError("down")

    register_sink("broken", broken)
    run_router(stream(spark, folder), RuleSet([Rule("r", "broken", checkpoint=False)]), str(tmp_path / "p")).awaitTermination()


def test_errors_are_kept_once_when_a_micro_batch_repeats(spark, tmp_path):
    folder, where, errors = str(tmp_path / "in"), str(tmp_path / "p"), str(tmp_path / "errors")
    got, state = {}, {"fail": True}

    def keep(matches, batch_id, params):
        if state["fail"] and batch_id == 1:
            raise OSError("sink is down")
        got[batch_id] = sorted(json.loads(r.outbound)["i"] for r in matches.collect())

    register_sink("sound", keep)
    rules = RuleSet([Rule("joined", "sound", when=lambda r: eq(r.json("odd"), 1), send=lambda r: {"x": join_("DOT", r.json("i"))}),
                     Rule("all", "sound", send=lambda r: {"i": r.json("i")})])
    for part in (range(0, 6), range(6, 12)):
        add(spark, folder, part)
    with pytest.raises(StreamingQueryException):
        run_router(stream(spark, folder), rules, where, errors=errors).awaitTermination()
    state["fail"] = False
    run_router(stream(spark, folder), rules, where, errors=errors).awaitTermination()
    rows = spark.read.parquet(f"{errors}/*").collect()
    assert sorted((r.i, r.rule, r.error, json.loads(r.record)["i"]) for r in rows) == [
        (i, "joined", "i: no array", i) for i in range(1, 12, 2)]
    assert got == {0: list(range(6)), 1: list(range(6, 12))}


def test_rules_that_keep_state_are_refused_on_streams(spark, tmp_path):
    folder = str(tmp_path / "in")
    add(spark, folder, range(3))
    rules = RuleSet([Rule("r", "debug", when=lambda r: eq(r.unique(r.json("i")), True))])
    with pytest.raises(ValueError):
        route(stream(spark, folder), rules, order=["i"])


def test_rules_that_keep_state_remember_earlier_micro_batches(spark, tmp_path):
    folder, where = str(tmp_path / "in"), str(tmp_path / "progress")
    got, state = {}, {"fail": True}

    def keep(matches, batch_id, params):
        rows = [(r.rule, r.i, r.outbound) for r in matches.collect()]
        got[batch_id] = [*got.get(batch_id, []), *rows]

    def flaky(matches, batch_id, params):
        if state["fail"] and batch_id == 2:
            got.pop(2, None)
            raise OSError("down")

    register_sink("remembered", keep)
    register_sink("flaky", flaky)
    rules = RuleSet([
        Rule("first", "remembered", when=lambda r: eq(r.unique(r.json("k")), True), send=lambda r: {"k": r.json("k")}),
        Rule("seen", "remembered", send=lambda r: {"last": r.fetch("odd"), "before": r.fetch("all")}),
        Rule("odd", "flaky", when=lambda r: eq(r.json("odd"), 1), cache=lambda r: {"odd": r.json("i")},
             cache_matching_only=True),
        Rule("all", "flaky", cache=lambda r: {"all": r.json("maybe")}),
    ])
    numbers = list(range(40))
    rows = [(n, "ab"[n % 2 if n % 7 else 0], dt.datetime(2024, 1, 1),
             json.dumps({"i": n, "odd": n % 2, "k": n % 6 if n < 20 else n % 9, "maybe": n if n % 3 else None}))
            for n in numbers]
    for i in range(0, 40, 10):
        spark.createDataFrame(rows[i:i + 10], SCHEMA).coalesce(1).write.mode("append").parquet(folder)

    def start():
        return run_router(stream(spark, folder), rules, where, scope=["u"], order=["i"], remember=None, keep=["i"])

    with pytest.raises(ValueError):
        run_router(stream(spark, folder), rules, where, order=["i"])
    with pytest.raises(StreamingQueryException):
        start().awaitTermination()
    state["fail"] = False
    start().awaitTermination()
    sent = [r for part in got.values() for r in part]

    keys, cache, first, seen = set(), {}, {}, {}
    for n, u, _, record in rows:
        doc, own = json.loads(record), cache.setdefault(u, {})
        if doc["k"] not in keys:
            first[n] = {"k": doc["k"]}
        keys.add(doc["k"])
        seen[n] = {"before": own.get("all"), "last": own.get("odd")}
        if doc["odd"]:
            own["odd"] = n
        own["all"] = doc["maybe"]
    assert {i: json.loads(o) for rule, i, o in sent if rule == "first"} == first
    assert {i: json.loads(o) for rule, i, o in sent if rule == "seen"} == seen
    assert len(sent) == len(first) + len(seen)


def test_seen_keys_are_forgotten_as_told(spark, tmp_path):
    folder, got = str(tmp_path / "in"), []
    register_sink("forgetful", lambda m, b, p: got.extend((b, r.outbound) for r in m.collect()))
    for part in (range(0, 2), range(0, 1), range(3, 4), range(0, 2)):
        add(spark, folder, part)
    rules = RuleSet([Rule("r", "forgetful", when=lambda r: eq(r.unique(r.json("odd")), True), send=lambda r: {"o": r.json("odd")})])
    run_router(stream(spark, folder), rules, str(tmp_path / "p"), order=["i"], remember=2).awaitTermination()
    assert sorted(got) == [(0, '{"o":0}'), (0, '{"o":1}'), (3, '{"o":0}'), (3, '{"o":1}')]


def test_unique_flags_every_row_across_micro_batches(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    rng = random.Random(1)
    rows = [(n, rng.choice(["hot"] * 3 + ["a", "b", None, f"k{n % 40}"]), dt.datetime(2024, 1, 1), "{}") for n in range(400)]
    rows += [(None, "only", None, "x"), (None, "only", None, "x"), (7, "tie", None, "x"), (7, "tie", None, "x")]
    rng.shuffle(rows)  # most rows come after later ones of their key
    turn = {}
    for k in range(10):
        part = rows[k::10]
        turn.update({r: min(k, turn.get(r, k)) for r in part})
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    stream_unique(stream(spark, folder), ["u"], ["i"], f"{tmp_path}/p", out, remember=None).awaitTermination()
    got = spark.read.parquet(out)
    assert got.select("batch").distinct().count() == 10
    # The same as the operator for tables, the number of the micro-batch first in the order.
    want = unique_flag(got.drop("first_seen"), ["u"], ["batch", "i"])
    assert sorted(map(str, want.select(*got.columns).collect())) == sorted(map(str, got.collect()))
    assert got.count() == len(rows) and got.where("first_seen = 'true'").count() == len({r[1] for r in rows})


def test_unique_forgets_as_told_and_repeats_a_failed_micro_batch(spark, tmp_path):
    folder, got, state = str(tmp_path / "in"), {}, {"fail": True}

    def sink(rows, batch):
        if state["fail"] and batch == 2:
            raise OSError("down")
        got[batch] = sorted((r.i, r.first_seen) for r in rows.collect())

    for part in ([0], [3], [6], [9]):
        add(spark, folder, part)
    start = lambda: stream_unique(stream(spark, folder), ["u"], ["i"], f"{tmp_path}/p", sink, remember=2)
    with pytest.raises(StreamingQueryException):
        start().awaitTermination()
    state["fail"] = False
    start().awaitTermination()
    assert got == {0: [(0, "true")], 1: [(3, "false")], 2: [(6, "false")], 3: [(9, "true")]}


def test_cache_in_the_order_of_micro_batches(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in (range(0, 7), range(7, 8), range(8, 20)):
        add(spark, folder, reversed(part))
    stream_cache(stream(spark, folder), "i", ["u"], ["i"], f"{tmp_path}/p", out, into="before").awaitTermination()
    assert {r.i: r.before for r in spark.read.parquet(out).collect()} == {n: n - 3 if n > 2 else None for n in range(20)}


@pytest.mark.parametrize("scope", [["u"], []])
def test_cache_in_the_order_of_events(spark, tmp_path, scope):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    own = spark.newSession()
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    rng = random.Random(2)
    begin = dt.datetime(2024, 1, 1)
    # One scope has most rows; null is a scope and a value; times tie; every row is up to 30 minutes late.
    rows = [(n, "hot" if n % 3 else rng.choice(["a", None, "b"]), begin + dt.timedelta(minutes=n // 2), str(n) if n % 5 else None)
            for n in range(600)]
    arrival = sorted(rows, key=lambda r: (r[2] + dt.timedelta(minutes=rng.randint(0, 30)), rng.random()))
    for k in range(10):
        spark.createDataFrame(arrival[60 * k : 60 * k + 60], SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    cache = StreamCache("record", scope, ["i"], f"{tmp_path}/p", into="before", ts="ts", delay="31 minutes")
    cache.start(stream(own, folder), out).awaitTermination()
    cache.flush(spark, spark.read.parquet(folder).schema, out)
    last, want = {}, {}
    for n, u, _, record in rows:
        key = u if scope else 0
        want[n] = last.get(key)
        last[key] = record
    got = spark.read.parquet(out)
    assert {r.i: r.before for r in got.collect()} == want and got.count() == len(rows)
    assert got.select("batch").distinct().count() == 11


def test_rows_that_come_too_late_read_the_cache_and_leave_it(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    at = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    for part in ([(1, "a", at(0), "x"), (2, "a", at(10), "y")], [(3, "a", at(30), "z")], [(4, "a", at(5), "late"), (5, "a", None, "w")],
                 [(6, "a", at(40), "v"), (7, "b", at(6), "late")]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    cache = StreamCache("record", ["u"], ["i"], f"{tmp_path}/p", into="before", ts="ts", delay="5 minutes")
    cache.start(stream(spark, folder), out).awaitTermination()
    cache.flush(spark, spark.read.parquet(folder).schema, out)
    got = {r.i: (r.before, r.batch) for r in spark.read.parquet(out).collect()}
    assert got[1] == (None, 0) and got[2] == ("x", 1) and got[4] == ("y", 2) and got[5] == ("y", 2) and got[7] == (None, 3)
    assert got[3] == ("w", 3) and got[6] == ("z", 4)


def test_listener_counts(spark, tmp_path):
    listener = metrics.RouterListener()
    spark.streams.addListener(listener)
    try:
        folder = str(tmp_path / "in")
        add(spark, folder, range(5))
        query = run_router(stream(spark, folder), RuleSet([Rule("r", "debug")]), str(tmp_path / "p"))
        query.awaitTermination()
        for _ in range(100):
            if listener.record_count == 5:
                break
            import time
            time.sleep(0.1)
        assert listener.record_count == 5 and listener.checkpoint_count >= 1 and listener.critical_error_count == 0
    finally:
        spark.streams.removeListener(listener)


def test_turns_of_a_stream_are_written_by_many_tasks_and_read_as_one_batch_each(spark, tmp_path):
    rows, seen = spark.range(0, 4000, 1, 4).withColumn("turn", F.col("id") % 10).where("turn <> 7"), []
    folder, files = str(tmp_path), 0
    for k, stream in enumerate(_in_ten_turns(spark, rows, F.col("turn"), folder)):
        files, before = len(list((tmp_path / "in").glob("*.parquet"))), files
        assert files - before >= (4 if k != 7 else 1)
        out = stream.writeStream.foreachBatch(lambda b, n: seen.append((n, b.count(), [r[0] for r in b.select("turn").distinct().collect()])))
        out.option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start().awaitTermination()
    assert seen == [(k, 400 if k != 7 else 0, [k] if k != 7 else []) for k in range(10)]


def test_turns_of_a_table_of_one_row_group_are_read_by_many_tasks(spark, tmp_path):
    spark.range(0, 4000, 1, 1).withColumn("text", F.concat(F.lit("t"), F.col("id"))).write.parquet(str(tmp_path / "table"))
    rows, seen = spark.read.parquet(str(tmp_path / "table")), []
    assert rows.rdd.getNumPartitions() == 1
    for stream in _in_ten_turns(spark, rows, F.col("id") % 11, str(tmp_path)):
        out = stream.writeStream.foreachBatch(lambda b, n: seen.append((n, b.rdd.getNumPartitions(), sorted(b.collect()))))
        out.option("checkpointLocation", str(tmp_path / "progress")).trigger(availableNow=True).start().awaitTermination()
    assert [n for n, _, _ in seen] == list(range(10)) and min(tasks for _, tasks, _ in seen) >= 4
    assert [got for _, _, got in seen] == [[(i, f"t{i}") for i in range(k, 4000, 11)] for k in range(10)]
