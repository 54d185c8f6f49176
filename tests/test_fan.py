"""Many folders in one pass: repeats, folders that fail, many folders, skew."""

import os

import pytest
from pyspark.sql import functions as F

from weir import Rule, RuleSet, SEND_ALL, publish, read_once, register_sink, route, write_each
from weir.sinks import fan

SCHEMA = "id long, text string"


def some(spark, n, targets, parts=4):
    return spark.range(0, n, numPartitions=parts).select(
        "id", F.concat(F.lit("t"), "id").alias("text"), F.pmod("id", F.lit(targets)).alias("target"))


def ids_in(spark, path):
    return sorted(r.id for r in read_once(spark, path, SCHEMA).collect())


def data_files(path):
    return [f for _, _, files in os.walk(f"{path}/data") for f in files if f.endswith(".parquet")]


def test_each_row_goes_to_its_folder_once(spark, tmp_path):
    paths = {i: str(tmp_path / f"f{i}") for i in range(4)}
    for _again in range(2):
        assert write_each(some(spark, 100, 3), paths, 0) == {}
    assert write_each(some(spark, 9, 3, 1), paths, 1, rows_per_file=1) == {}
    assert write_each(some(spark, 0, 3), paths, 2) == {}
    for i in range(3):
        assert ids_in(spark, paths[i]) == sorted([*range(i, 100, 3), *range(i, 9, 3)])
        assert len(data_files(paths[i])) == len(read_once(spark, paths[i], SCHEMA).inputFiles())
    assert ids_in(spark, paths[3]) == []
    assert sorted(os.listdir(f"{paths[3]}/batches/default")) == [f"{i:012d}.json" for i in range(3)]


def test_a_failed_folder_fails_alone_and_is_written_when_it_is_back(spark, tmp_path):
    paths = {i: str(tmp_path / f"f{i}") for i in range(3)}
    os.makedirs(paths[1])
    (tmp_path / "f1" / "data").write_text("a file where the folder should be")
    assert set(write_each(some(spark, 30, 3), paths, 0)) == {1}
    assert not os.path.exists(f"{paths[1]}/batches")
    assert [ids_in(spark, paths[i]) for i in (0, 2)] == [list(range(i, 30, 3)) for i in (0, 2)]
    os.rename(tmp_path / "f1" / "data", tmp_path / "aside")
    before = {i: data_files(paths[i]) for i in (0, 2)}
    assert write_each(some(spark, 30, 3), paths, 0) == {}
    assert ids_in(spark, paths[1]) == list(range(1, 30, 3))
    assert before == {i: data_files(paths[i]) for i in (0, 2)}


def test_rows_without_a_folder_and_failing_rows_add_nothing(spark, tmp_path):
    paths = {i: str(tmp_path / f"f{i}") for i in range(2)}
    with pytest.raises(Exception, match="no folder"):
        write_each(some(spark, 9, 3), paths, 0)
    with pytest.raises(Exception, match="no folder"):
        write_each(some(spark, 9, 2).withColumn("target", F.lit(None).cast("int")), paths, 0)
    broken = some(spark, 40, 2).withColumn("text", F.when(F.col("id") == 39, F.raise_error(F.lit("down"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="down"):
        write_each(broken, paths, 0)
    assert [ids_in(spark, p) for p in paths.values()] == [[], []]


def test_more_folders_than_open_files_with_little_memory(tmp_path, monkeypatch):
    import pyarrow as pa
    import pyarrow.parquet as pq

    monkeypatch.setattr(fan, "HELD_BYTES", 500)
    monkeypatch.setattr(fan, "OPEN_FILES", 3)
    paths = {i: str(tmp_path / f"f{i}") for i in range(20)}
    # Half of the rows are of folder 0.
    batches = [pa.RecordBatch.from_pydict({"id": list(range(k, k + 20)), "target": [0 if i % 2 else i for i in range(20)]})
               for k in range(0, 400, 20)]
    report = [r for b in fan._task(paths, "target", 1000, "zstd")(iter(batches)) for r in b.to_pylist()]
    found = {}
    for r in report:
        assert r["error"] is None
        read = pq.read_table(f"{paths[r['target']]}/{r['file']}")
        assert len(read) == r["rows"]
        found.setdefault(r["target"], []).extend(read.column("id").to_pylist())
    want = {}
    for b in batches:
        for r in b.to_pylist():
            want.setdefault(r["target"], []).append(r["id"])
    assert {k: sorted(v) for k, v in found.items()} == want


def test_publishing_to_files_reads_the_matches_once(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(len(b))
            yield b

    got = []
    register_sink("listed", lambda m, b, p: got.extend(r.outbound for r in m.collect()))
    base = spark.range(0, 20, numPartitions=3).select(F.to_json(F.struct(F.col("id").alias("i"))).alias("record"))

    def rules(*extra):
        return RuleSet([
            *[Rule(f"r{i}", "files", when=lambda r, i=i: F.get_json_object(r.text, "$.i").cast("int") % 5 == i, send=SEND_ALL,
                   checkpoint=False, params={"path": str(tmp_path / f"d{i % 4}")}) for i in range(5)], *extra])

    (tmp_path / "d3").write_text("no folder")
    only = rules()
    routed = route(base.mapInArrow(counted, base.schema), only)
    assert publish(routed, only, 0) == ["r3"]
    assert reads.value == 20
    assert sorted(r.outbound for r in read_once(spark, str(tmp_path / "d0"), routed.schema).collect()) == sorted(
        f'{{"i":{i}}}' for i in range(20) if i % 5 in (0, 4))
    mixed = rules(Rule("l", "listed", send=SEND_ALL))
    assert publish(route(base, mixed), mixed, 1) == ["r3"] and len(got) == 20
    assert read_once(spark, str(tmp_path / "d1"), routed.schema).count() == 8
    with pytest.raises(OSError, match="r3"):
        flagged = RuleSet([*only, Rule("r3", "files", params={"path": str(tmp_path / "d3")})])
        publish(route(base, flagged), flagged, 2)
