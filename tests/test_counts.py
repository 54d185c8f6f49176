"""What micro-batches count, over failures, restarts and rules that keep state."""

import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from weir import Rule, RuleSet, SEND_ALL, count_points, eq, read_counts, read_failures, register_sink, run_router
from weir.operators import metrics

SCHEMA = "i long, at timestamp, record string"


def add(spark, folder, first, last, text=None):
    rows = spark.range(first, last).select(
        F.col("id").alias("i"), F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("at"),
        F.lit(text).alias("record") if text is not None else F.to_json(F.struct(F.col("id").alias("i"))).alias("record"))
    rows.coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def total(points, name):
    return {r.name: r.value for r in metrics.counters(points).collect()}[name]


@pytest.mark.parametrize("sinks", ["files", "mixed"])
def test_counts_survive_a_failure_and_a_restart(spark, tmp_path, sinks):
    folder, counts = str(tmp_path / "in"), str(tmp_path / "counts")
    path = tmp_path / "out" / "odd"
    rules = [Rule("odd", "files", when=lambda r: F.get_json_object(r.text, "$.i").cast("int") % 2 == 1, send=SEND_ALL,
                  params={"path": str(path)}),
             Rule("lost", "files", checkpoint=False, params={"path": str(tmp_path / "in" / "_none" / "x")})]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "_none").write_text("no folder")
    if sinks == "mixed":
        register_sink("nothing", lambda m, b, p: None)
        rules.append(Rule("n", "nothing", send=SEND_ALL))
    rules = RuleSet(rules)

    def go():
        run_router(stream(spark, folder), rules, str(tmp_path / "p"), counts=counts, ts="at").awaitTermination()

    add(spark, folder, 0, 10)
    go()
    (tmp_path / "out" / "odd" / "batches" / "default").rename(tmp_path / "aside")
    (tmp_path / "out" / "odd" / "batches" / "default").write_text("no folder")
    add(spark, folder, 10, 25)
    with pytest.raises(StreamingQueryException):
        go()
    (tmp_path / "out" / "odd" / "batches" / "default").rename(tmp_path / "broken")
    (tmp_path / "aside").rename(tmp_path / "out" / "odd" / "batches" / "default")
    go()
    got = {r.batch: r for r in read_counts(spark, counts).collect()}
    matches = {0: 5 + 10, 1: 7 + 15} if sinks == "files" else {0: 5 + 20, 1: 7 + 30}
    assert {b: (r.records, r.matches, r.errors, r.failed_rules) for b, r in got.items()} == {
        0: (10, matches[0], 0, ["lost"]), 1: (15, matches[1], 0, ["lost"])}
    assert got[1].bytes == sum(len(json.dumps({"i": i}, separators=(",", ":"))) for i in range(10, 25))
    assert got[1].newest == (1_700_000_000 + 24) * 1000 and got[1].millis_behind == got[1]["at"] - got[1].newest
    failures = read_failures(spark, counts)
    assert [(r.batch, "odd" in r.error) for r in failures.collect()] == [(1, True)]
    points = count_points(read_counts(spark, counts), failures)
    assert (total(points, "record_count"), total(points, "checkpoint_count"), total(points, "failed_batch_count")) == (25, 2, 1)
    latest = {r.name: r.value for r in metrics.gauges(points).collect()}
    assert latest["millis_behind"] == max(got.values(), key=lambda r: r["at"]).millis_behind


def test_counts_of_rules_that_keep_state(spark, tmp_path):
    folder, counts = str(tmp_path / "in"), str(tmp_path / "counts")
    register_sink("nothing", lambda m, b, p: None)
    rules = RuleSet([Rule("first", "nothing", when=lambda r: eq(r.unique(r.json("i")), True)),
                     Rule("none", "nothing", where=F.lit(False))])
    for _turn in range(2):
        add(spark, folder, 0, 6)
    add(spark, folder, 0, 3, "{")
    run_router(stream(spark, folder), rules, str(tmp_path / "p"), order=["i"], remember=None, counts=counts,
               errors=str(tmp_path / "e")).awaitTermination()
    assert [(r.records, r.matches, r.newest, r.millis_behind) for r in read_counts(spark, counts).orderBy("batch").collect()] == [
        (6, 6, None, None), (6, 0, None, None), (3, 1, None, None)]  # an absent key is a key
    assert read_counts(spark, counts).agg(F.sum("errors")).first()[0] == 3
    assert read_failures(spark, counts).count() == 0


def test_no_match_for_any_record(spark, tmp_path):
    folder, counts = str(tmp_path / "in"), str(tmp_path / "counts")
    rules = RuleSet([Rule("none", "files", where=F.lit(False), params={"path": str(tmp_path / "o")})])
    add(spark, folder, 0, 6)
    add(spark, folder, 0, 0)
    run_router(stream(spark, folder), rules, str(tmp_path / "p"), counts=counts).awaitTermination()
    found = read_counts(spark, counts).orderBy("batch").collect()
    assert [(r.matches, r.sent_bytes) for r in found][:1] == [(0, 0)]
    assert found[0].records == 6
