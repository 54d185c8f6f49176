"""Registration of queries and the records they run on."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir import as_envelope, read_records, tune

# Tasks that records are dealt out to; None leaves them in the table's own splits. The benchmark measures both.
PARTITIONS: int | None = None

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, and the SQL that must give the same rows."""
    def register(build):
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(tune(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream. The pattern lets the table be a file or a folder of files."""
    schema = table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events with their nested number ``k`` and a real timestamp."""
    return _with_k(table(spark, sf_dir, "events"))


def _with_k(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "ts": F.col("ts").cast("timestamp"),
        "k": F.get_json_object("props", "$.k").cast("int"),
    })


def records(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """Every event as a JSON record with all the kinds of values rules meet.

    ``maybe`` is sometimes JSON null, ``mixed`` a number as text, plain text, a
    boolean or null, ``list`` an array or plain text.
    """
    df = _with_k(read_records(spark, f"{sf_dir}/events.parquet", partitions=partitions or PARTITIONS))
    turn = F.pmod("event_id", F.lit(4))
    mixed = (
        F.when(turn == 0, F.concat(F.lit(" "), F.col("k").cast("string"), F.lit(" ")).cast("variant"))
        .when(turn == 1, F.col("event_type").cast("variant"))
        .when(turn == 2, F.lit(True).cast("variant"))
    )
    pair = F.array(F.col("event_type").cast("variant"), F.col("k").cast("variant"),
                   F.lit(None).cast("variant"))
    listed = F.when(F.pmod("event_id", F.lit(2)) == 0, pair.cast("variant")).otherwise(
        F.col("event_type").cast("variant"))
    fields = F.struct(
        "event_id", "user_id", "event_type", "value",
        F.struct("k", F.struct("event_type").alias("deep")).alias("props"),
        (F.pmod("event_id", F.lit(3)) == 0).alias("flag"),
        F.when(F.pmod("event_id", F.lit(5)) != 0, F.col("event_type")).alias("maybe"),
        mixed.alias("mixed"),
        listed.alias("list"),
    )
    return df.select("event_id", "user_id", "ts", F.to_json(fields, {"ignoreNullFields": "false"}).alias("record"))


# The same values as columns, for the SQL side. ``vtxt`` is ``value`` as JSON text.
REC = """rec AS (
  SELECT event_id, user_id, ts, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CASE WHEN value = floor(value) THEN CAST(CAST(value AS BIGINT) AS VARCHAR)
              ELSE CAST(value AS VARCHAR) END AS vtxt
  FROM events)"""


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as stream envelopes of eight shards, the payload not compressed."""
    return as_envelope(
        events(spark, sf_dir),
        shard=F.concat(F.lit("shard-"), F.pmod("user_id", F.lit(8)).cast("string")),
        sequence=F.col("event_id") * 37, key="user_id", ts="ts", data=F.encode("props", "UTF-8"))


ENV = """env AS (
  SELECT 'shard-' || (user_id % 8) AS shard_id, CAST(event_id * 37 AS VARCHAR) AS sequence_number,
         CAST(user_id AS VARCHAR) AS partition_key, ts AS arrival_ts, props AS payload, event_id
  FROM events)"""
