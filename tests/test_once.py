"""Micro-batches that count once: failures, repeats, several writers."""

import os

import pytest
from pyspark.sql import functions as F

from weir import OnceSink, read_once, write_once

SCHEMA = "id long, text string"


def rows_of(spark, path):
    return sorted(tuple(r) for r in read_once(spark, path, SCHEMA).collect())


def some(spark, first, last):
    return spark.range(first, last, numPartitions=4).withColumn("text", F.concat(F.lit("t"), "id"))


def want(*numbers):
    return sorted((n, f"t{n}") for n in numbers)


def test_repeats_count_once(spark, tmp_path):
    path = str(tmp_path / "out")
    assert rows_of(spark, path) == []
    write_once(some(spark, 0, 10), path, 0)
    write_once(some(spark, 0, 10), path, 0)
    write_once(some(spark, 50, 60), path, 0)  # the number decides
    write_once(some(spark, 10, 12), path, 1, rows_per_file=1)
    write_once(some(spark, 0, 0), path, 2)
    assert rows_of(spark, path) == want(*range(12))
    write_once(some(spark, 12, 13), path, 0, query="other")
    assert rows_of(spark, path) == want(*range(13))
    listed = {f for _, _, files in os.walk(f"{path}/data") for f in files if f.endswith(".parquet")}
    assert len(listed) == len(read_once(spark, path, SCHEMA).inputFiles())  # nothing is left of what was not added


def test_a_failing_task_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "out")
    write_once(some(spark, 0, 10), path, 0)
    broken = some(spark, 10, 30).withColumn("text", F.when(F.col("id") == 29, F.raise_error(F.lit("down"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="down"):
        write_once(broken, path, 1)
    assert rows_of(spark, path) == want(*range(10))
    write_once(some(spark, 10, 30), path, 1)
    assert rows_of(spark, path) == want(*range(30))


def test_a_stream_that_fails_loses_and_doubles_nothing(spark, tmp_path):
    source, path, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "fail")
    spark.dataSource.register(OnceSink)
    for k in range(4):
        some(spark, 10 * k, 10 * k + 10).coalesce(1).write.mode("append").parquet(source)
    open(mark, "w").close()

    @F.udf("string")
    def shaky(n, text):
        if n == 25 and os.path.exists(mark):
            raise OSError("task is down")
        return text

    def start():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        return (stream.repartition(3, "id").withColumn("text", shaky("id", "text")).writeStream.format("weir_once")
                .option("path", path).option("checkpointLocation", f"{tmp_path}/p").trigger(availableNow=True).start())

    with pytest.raises(Exception, match="task is down"):
        start().awaitTermination()
    assert rows_of(spark, path) == want(*range(20))
    os.remove(mark)
    start().awaitTermination()
    assert rows_of(spark, path) == want(*range(40))
