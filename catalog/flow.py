"""Sources, batches, progress and metrics."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir import (
    SEND_ALL, OnceSink, Rule, RuleSet, append_records, as_envelope, batch_by_size, batch_by_size_or_age, batch_by_time, batch_key, commit_progress, deaggregate,
    decode_snappy, drop_empty, emit_envelope, from_position, gt, invalid_records, read_once, read_progress,
    read_records, register_source, route, run_router, shard_stream, source, tail_positions, work_folder, write_once,
)
from weir.operators import metrics, progress
from weir.sources.aggregated import AGGREGATED_MAGIC, DIGEST_BYTES
from weir.sources.shards import SEGMENT_RECORDS

from .base import ENV, REC, envelopes, event_stream, events, query

MIDDLE = "2024-01-15"


def _positions(env):
    """Where each shard stood at the middle of the data; one shard was never read."""
    seen = tail_positions(env.where(F.col("arrival_ts") < F.lit(MIDDLE).cast("timestamp")))
    return seen.where("shard_id <> 'shard-7'")


_POSITIONS = f"""positions AS (
  SELECT shard_id, max(event_id) AS event_id FROM env
  WHERE arrival_ts < TIMESTAMP '{MIDDLE}' AND shard_id <> 'shard-7' GROUP BY shard_id)"""


@query("source_envelope", f"WITH {ENV} SELECT shard_id, sequence_number, partition_key, payload FROM env")
def _(spark, d):
    register_source("events", lambda s, folder: envelopes(s, folder))
    env = source("events", spark, folder=d)
    return env.select("shard_id", "sequence_number", "partition_key", F.decode("data", "UTF-8").alias("payload"))


@query("pos_trim_horizon", f"WITH {ENV} SELECT shard_id, sequence_number FROM env")
def _(spark, d):
    return from_position(envelopes(spark, d), "TRIM_HORIZON").select("shard_id", "sequence_number")


@query("pos_latest", f"WITH {ENV} SELECT shard_id, arg_max(sequence_number, event_id) AS sequence_number FROM env GROUP BY shard_id")
def _(spark, d):
    env = envelopes(spark, d).select("shard_id", "sequence_number")
    return from_position(env, "LATEST").union(tail_positions(env))


def _from(name, mode, compare):
    @query(name, f"""
WITH {ENV}, {_POSITIONS}
SELECT shard_id, sequence_number FROM env LEFT JOIN positions p USING (shard_id)
WHERE p.event_id IS NULL OR env.event_id {compare} p.event_id""")
    def _(spark, d):
        env = envelopes(spark, d)
        return from_position(env, mode, _positions(env)).select("shard_id", "sequence_number")


_from("pos_at", "AT", ">=")
_from("pos_after", "AFTER", ">")


def _length_prefixed(number: int, body: bytes) -> bytes:
    size, out = len(body), bytearray([number << 3 | 2])
    while size > 127:
        out.append(size & 127 | 128)
        size >>= 7
    out.append(size)
    return bytes(out) + body


@F.arrow_udf(T.BinaryType())
def _aggregated(payloads: pa.Array) -> pa.Array:
    out = []
    for group in payloads.to_pylist():
        body = b"".join(_length_prefixed(3, b"\x08\x00" + _length_prefixed(3, p)) for p in group)
        out.append(AGGREGATED_MAGIC + _length_prefixed(1, b"key") + body + bytes(DIGEST_BYTES))
    return pa.array(out, pa.binary())


@F.arrow_udf(T.BinaryType())
def _snappy(values: pa.Array) -> pa.Array:
    codec = pa.Codec("snappy")
    return pa.array([codec.compress(v, asbytes=True) for v in values.to_pylist()], pa.binary())


@query("deaggregate", """
SELECT event_id // 16 AS parent, CAST(CASE WHEN (event_id // 16) % 4 = 0 THEN 0 ELSE event_id % 16 END AS INTEGER) AS sub_seq, props AS payload
FROM events""")
def _(spark, d):
    # Sixteen ids to a group; every fourth group is sent record by record.
    rows = events(spark, d).select(
        "event_id", F.floor(F.col("event_id") / 16).alias("parent"), F.encode("props", "UTF-8").alias("data"))
    single = F.pmod("parent", F.lit(4)) == 0
    grouped = rows.where(~single).groupBy("parent").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("event_id", "data"))), lambda x: x["data"]).alias("all"))
    packed = grouped.select("parent", _aggregated("all").alias("data"))
    mixed = packed.unionByName(rows.where(single).select("parent", "data"))
    return deaggregate(mixed).select("parent", "sub_seq", F.decode("data", "UTF-8").alias("payload"))


@query("decode_snappy", "SELECT event_id, props AS record FROM events")
def _(spark, d):
    rows = events(spark, d).select("event_id", _snappy(F.encode("props", "UTF-8")).alias("data"))
    return decode_snappy(rows)


@query("drop_empty", "SELECT event_id, props AS record FROM events WHERE event_type <> 'view'")
def _(spark, d):
    blank = F.when(F.col("event_type") == "view", "").otherwise(F.col("props"))
    return drop_empty(events(spark, d).select("event_id", blank.alias("record")))


@query("invalid_records", "SELECT event_id, left(props, length(props) - 1) AS record FROM events WHERE event_type = 'error'")
def _(spark, d):
    broken = F.when(F.col("event_type") == "error", F.left("props", F.length("props") - 1)).otherwise(F.col("props"))
    return invalid_records(events(spark, d).select("event_id", broken.alias("record")))


@query("batch_by_time", """
SELECT strftime(make_timestamp(CAST(floor(epoch(ts) / 3600) * 3600 AS BIGINT) * 1000000), '%Y-%m-%d %H:%M') AS batch,
       user_id % 8 AS shard_id, count(*) AS records, sum(strlen(props) + 1)::BIGINT AS bytes
FROM events GROUP BY 1, 2""")
def _(spark, d):
    rows = events(spark, d).withColumn("shard_id", F.pmod("user_id", F.lit(8)))
    out = batch_by_time(rows, 3600, ts="ts", record="props")
    return out.select(F.date_format("batch_start", "yyyy-MM-dd HH:mm").alias("batch"), "shard_id", "records", "bytes")


@query("batch_by_size", """
SELECT event_id, CAST(coalesce(sum(strlen(props) + 1) OVER (PARTITION BY user_id % 8 ORDER BY event_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // 500 AS BIGINT) AS batch
FROM events""")
def _(spark, d):
    rows = events(spark, d).select("event_id", F.pmod("user_id", F.lit(8)).alias("shard_id"), "props")
    return batch_by_size(rows, 500, ["event_id"], record="props").select("event_id", "batch")


@query("batch_key", """
SELECT event_id, strftime(ts, '%Y-%m-%d/%H%M') || '/shard-' || (user_id % 8) || '-'
       || CAST(floor(epoch(ts)) AS BIGINT) || '.gz' AS object_key
FROM events""")
def _(spark, d):
    shard = F.concat(F.lit("shard-"), F.pmod("user_id", F.lit(8)))
    return events(spark, d).select("event_id", batch_key("ts", shard).alias("object_key"))


@F.arrow_udf(T.BinaryType())
def _gunzip(values: pa.Array) -> pa.Array:
    import gzip
    return pa.array([gzip.decompress(v) for v in values.to_pylist()], pa.binary())


@query("emit_envelope", "SELECT event_id, props AS outbound, CAST(36 AS INTEGER) AS key_length FROM events")
def _(spark, d):
    sent = emit_envelope(events(spark, d).select("event_id", F.col("props").alias("outbound")))
    return sent.select("event_id", F.decode(_gunzip("data"), "UTF-8").alias("outbound"),
                       F.length("partition_key").alias("key_length"))


# Progress -----------------------------------------------------------------

_OLD, _NEW = "2024-01-15 00:00:00", "2024-01-31 00:00:00"


def _committed(env):
    """A progress table as of the middle of the data."""
    at = F.lit(_OLD).cast("timestamp")
    return _positions(env).select("shard_id", "sequence_number", at.alias("last_update"),
                                  F.lit(None).cast("timestamp").alias("finished"))


def _moved(env):
    """The batch read since then: only even shards, and the one never read."""
    last = progress.last_sequences(env)
    return last.where(F.right("shard_id", F.lit(1)).isin("0", "2", "4", "6", "7"))


@query("progress_last_seq", f"WITH {ENV} SELECT shard_id, arg_max(sequence_number, event_id) AS sequence_number FROM env GROUP BY shard_id")
def _(spark, d):
    return progress.last_sequences(envelopes(spark, d))


_LAST = "last AS (SELECT shard_id, max(event_id) AS event_id FROM env GROUP BY shard_id)"
_COMMITTED = f"""committed AS (
  SELECT shard_id, CASE WHEN right(shard_id, 1) IN ('0','2','4','6','7') THEN l.event_id ELSE p.event_id END AS event_id,
         CASE WHEN right(shard_id, 1) IN ('0','2','4','6','7') AND l.event_id IS DISTINCT FROM p.event_id THEN '{_NEW}' ELSE '{_OLD}' END AS last_update
  FROM last l LEFT JOIN positions p USING (shard_id))"""


def _after_commit(spark, d):
    env = envelopes(spark, d)
    return progress.commit(_committed(env), _moved(env), F.lit(_NEW).cast("timestamp"))


@query("progress_commit", f"""
WITH {ENV}, {_POSITIONS}, {_LAST}, {_COMMITTED}
SELECT shard_id, CAST(event_id * 37 AS VARCHAR) AS sequence_number, last_update FROM committed""")
def _(spark, d):
    out = _after_commit(spark, d)
    return out.select("shard_id", "sequence_number", F.date_format("last_update", "yyyy-MM-dd HH:mm:ss").alias("last_update"))


@query("progress_changed", f"""
WITH {ENV}, {_POSITIONS}, {_LAST}
SELECT shard_id, CAST(l.event_id * 37 AS VARCHAR) AS sequence_number FROM last l LEFT JOIN positions p USING (shard_id)
WHERE l.event_id IS DISTINCT FROM p.event_id""")
def _(spark, d):
    env = envelopes(spark, d)
    return progress.changed(_committed(env), progress.last_sequences(env))


@query("progress_finished", f"""
WITH {ENV}, {_POSITIONS}, {_LAST}, {_COMMITTED}
SELECT c.shard_id FROM committed c JOIN last l USING (shard_id)
WHERE (right(shard_id, 1) < '5' AND c.event_id = l.event_id) OR right(shard_id, 1) = '5'""")
def _(spark, d):
    # Shards 0 to 4 have ended, shard 5 ended without ever being read.
    env = envelopes(spark, d)
    ends = progress.last_sequences(env).where("right(shard_id, 1) <= '5'").select(
        "shard_id", F.when(F.col("shard_id") != "shard-5", F.col("sequence_number")).alias("final_sequence"))
    done = progress.finish(_after_commit(spark, d), ends)
    return progress.finished_shards(done).select("shard_id")


@query("progress_resume", f"""
WITH {ENV}, {_POSITIONS}, {_LAST}, {_COMMITTED}
SELECT env.shard_id, env.sequence_number FROM env JOIN committed c USING (shard_id) WHERE env.event_id > c.event_id""")
def _(spark, d):
    return progress.resume(envelopes(spark, d), _after_commit(spark, d)).select("shard_id", "sequence_number")


@query("progress_repeats", f"WITH {ENV} SELECT shard_id, sequence_number, payload FROM env")
def _(spark, d):
    # Everything after the middle is read twice.
    env = envelopes(spark, d)
    again = env.unionByName(from_position(env, "AFTER", _positions(env)))
    once = progress.drop_repeats(again)
    return once.select("shard_id", "sequence_number", F.decode("data", "UTF-8").alias("payload"))


@query("stream_progress", f"WITH {ENV} SELECT shard_id, arg_max(sequence_number, event_id) AS sequence_number FROM env GROUP BY shard_id")
def _(spark, d):
    out = work_folder(spark, "progress")
    stream = as_envelope(
        event_stream(spark, d),
        shard=F.concat(F.lit("shard-"), F.pmod("user_id", F.lit(8)).cast("string")),
        sequence=F.col("event_id") * 37, key="user_id", ts="ts", data=F.encode("props", "UTF-8"),
    ).withColumn("record", F.decode("data", "UTF-8"))
    rules = RuleSet([Rule("log", "debug", send=SEND_ALL)])
    run_router(stream, rules, f"{out}/stream", after=commit_progress(f"{out}/table")).awaitTermination()
    return read_progress(spark, f"{out}/table").select("shard_id", "sequence_number")


# Everything ---------------------------------------------------------------

@query("route_envelopes", f"""
WITH {REC} SELECT event_id // 16 AS parent, CAST(event_id % 16 AS INTEGER) AS sub_seq, 'high' AS rule, '{{"k":' || k || '}}' AS outbound
FROM rec WHERE k > 50
UNION ALL
SELECT event_id // 16, CAST(event_id % 16 AS INTEGER), 'even', props FROM events WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) % 2 = 0 AND event_type <> 'view'""")
def _(spark, d):
    # Aggregated envelopes of compressed payloads, some of them empty: split, unpack, drop, route, wrap.
    text = F.when(F.col("event_type") == "view", F.concat(F.lit(" "), "props")).otherwise(F.col("props"))
    rows = read_records(spark, f"{d}/events.parquet").select(
        "event_id", F.floor(F.col("event_id") / 16).alias("parent"), _snappy(F.encode(text, "UTF-8")).alias("data"))
    grouped = rows.groupBy("parent").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("event_id", "data"))), lambda x: x["data"]).alias("all"))
    env = grouped.select("parent", _aggregated("all").alias("data"))
    taken = drop_empty(decode_snappy(deaggregate(env)))
    odd = F.pmod(F.get_json_object("record", "$.k").cast("int"), F.lit(2))
    rules = RuleSet([
        Rule("high", "emit", when=lambda r: gt(r.json("k"), 50), send=lambda r: {"k": r.json("k")}),
        Rule("even", "emit", when=lambda r: (odd == 0) & ~r.text.startswith(" "), send=SEND_ALL),
    ])
    sent = emit_envelope(route(taken, rules, keep=["parent", "sub_seq"]))
    return sent.select("parent", "sub_seq", "rule", F.decode(_gunzip("data"), "UTF-8").alias("outbound"))


# Metrics ------------------------------------------------------------------

@query("metric_record_count", f"WITH {ENV} SELECT shard_id, count(*) AS record_count FROM env GROUP BY shard_id")
def _(spark, d):
    return metrics.record_count(envelopes(spark, d))


@query("metric_millis_behind", f"""
WITH {ENV}, newest AS (SELECT shard_id, max(epoch_us(arrival_ts)) AS us FROM env GROUP BY shard_id)
SELECT shard_id, ((SELECT max(us) FROM newest) - us) // 1000 AS millis_behind FROM newest""")
def _(spark, d):
    return metrics.millis_behind(envelopes(spark, d))


def _points(spark, d):
    rows = events(spark, d)
    kind = F.when(F.col("event_type").isin("click", "view"), "counter").otherwise("gauge")
    own = F.create_map(F.lit("shardId"), F.pmod("user_id", F.lit(8)).cast("string"),
                       F.lit("plugin"), F.when(F.pmod("user_id", F.lit(2)) == 0, "batch").otherwise("emit"))
    points = rows.select(F.col("event_type").alias("name"), kind.alias("kind"),
                         F.col("k").cast("double").alias("value"), own.alias("dims"), "ts")
    return metrics.with_dims(points, {"region": "home", "plugin": "none"})


def _metric(name, reduce, kinds, value):
    @query(name, f"""
SELECT event_type AS name, 'home' AS region, CAST(user_id % 8 AS VARCHAR) AS shard,
       CASE WHEN user_id % 2 = 0 THEN 'batch' ELSE 'emit' END AS plugin, {value} AS value
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)
WHERE event_type IN ({kinds}) GROUP BY ALL""")
    def _(spark, d):
        return reduce(_points(spark, d)).select(
            "name", F.col("dims")["region"].alias("region"), F.col("dims")["shardId"].alias("shard"),
            F.col("dims")["plugin"].alias("plugin"), "value")


_metric("metric_gauge", metrics.gauges, "'error', 'signup', 'purchase'", "arg_max(k, ts)")
_metric("metric_counter", metrics.counters, "'click', 'view'", "sum(k)")


SHARD_ROWS = "shard_id string, sequence_number string, partition_key string, data binary"


def _shard_log(spark, d):
    """The events as a shard log, appended in two parts: before and after the middle of the data."""
    env, folder = envelopes(spark, d), work_folder(spark, "shards")
    early = F.col("arrival_ts") < F.lit(MIDDLE).cast("timestamp")
    # Some sixty segments, more where they would be larger than a task reads.
    size = min(max(1, env.count() // 60), SEGMENT_RECORDS)
    for part in (early, ~early):
        append_records(env.where(part), f"{folder}/log", segment_records=size)
    return folder


def _read_on(stream, folder, upto):
    """Run a stream into a sink that takes each micro-batch once, until it has made ``upto`` of them or all there are."""
    spark = stream.sparkSession
    spark.dataSource.register(OnceSink)
    query = (stream.writeStream.format("weir_once").option("path", f"{folder}/out")
             .option("checkpointLocation", f"{folder}/progress").trigger(processingTime="0 seconds").start())
    try:
        if upto is None:
            query.processAllAvailable()
        while upto is not None and query.isActive and (query.lastProgress or {"batchId": -1})["batchId"] + 1 < upto:
            query.awaitTermination(0.05)
        if query.exception() is not None:
            raise query.exception()
    finally:
        query.stop()


@query("stream_source", f"WITH {ENV} SELECT shard_id, sequence_number, partition_key, payload FROM env")
def _(spark, d):
    # Some ten micro-batches, stopped in the middle and started again from the checkpoint.
    folder = _shard_log(spark, d)
    rows = envelopes(spark, d).count()
    for upto in (4, None):
        stream = shard_stream(spark, f"{folder}/log", records=max(1, rows // 10), progress=f"{folder}/source")
        _read_on(stream.drop("arrival_ts"), folder, upto)
    out = read_once(spark, f"{folder}/out", SHARD_ROWS)
    return out.select("shard_id", "sequence_number", "partition_key", F.decode("data", "UTF-8").alias("payload"))


def _stream_from(name, start, compare):
    @query(name, f"""
WITH {ENV}, {_POSITIONS}
SELECT shard_id, sequence_number FROM env LEFT JOIN positions p USING (shard_id)
WHERE p.event_id IS NULL OR env.event_id {compare} p.event_id""")
    def _(spark, d):
        # One row per shard: what a progress table holds.
        positions = {r["shard_id"]: r["sequence_number"] for r in _positions(envelopes(spark, d)).collect()}
        folder = _shard_log(spark, d)
        stream = shard_stream(spark, f"{folder}/log", start=start, positions=positions)
        _read_on(stream.select("shard_id", "sequence_number"), folder, None)
        return read_once(spark, f"{folder}/out", "shard_id string, sequence_number string")


_stream_from("stream_source_at", "AT", ">=")
_stream_from("stream_source_after", "AFTER", ">")


@query("stream_source_latest", f"""
WITH {ENV} SELECT shard_id, sequence_number FROM env WHERE arrival_ts >= TIMESTAMP '{MIDDLE}'""")
def _(spark, d):
    # The query starts when the first half is there, and sees what is appended from then on.
    env, folder = envelopes(spark, d), work_folder(spark, "shards")
    early = F.col("arrival_ts") < F.lit(MIDDLE).cast("timestamp")
    append_records(env.where(early), f"{folder}/log")
    stream = shard_stream(spark, f"{folder}/log", start="LATEST").select("shard_id", "sequence_number")
    _read_on(stream, folder, None)
    append_records(env.where(~early), f"{folder}/log")
    _read_on(stream, folder, None)
    return read_once(spark, f"{folder}/out", "shard_id string, sequence_number string")


@query("emit_once", "SELECT user_id % 3 AS batch, count(*) AS records, sum(strlen(props))::BIGINT AS bytes FROM events GROUP BY 1")
def _(spark, d):
    # Every micro-batch comes twice, as after a failure, and counts once.
    rows = events(spark, d).select(F.pmod("user_id", F.lit(3)).alias("batch"), F.col("props").alias("outbound"))
    folder = work_folder(spark, "once")
    for k in (0, 0, 1, 2, 1, 2):
        write_once(rows.where(F.col("batch") == k), folder, k)
    out = read_once(spark, folder, "batch long, outbound string")
    return out.groupBy("batch").agg(F.count("*").alias("records"), F.sum(F.octet_length("outbound")).alias("bytes"))


@query("batch_by_size_or_age", """
WITH RECURSIVE placed AS (
  SELECT event_id, CASE WHEN user_id % 3 = 0 THEN 8 ELSE user_id % 8 END AS shard, ts,
         row_number() OVER w AS place, sum(strlen(props) + 1) OVER w - strlen(props) - 1 AS before, max(ts) OVER w AS t
  FROM events WINDOW w AS (PARTITION BY CASE WHEN user_id % 3 = 0 THEN 8 ELSE user_id % 8 END ORDER BY ts, event_id)),
opens AS (
  SELECT shard, place FROM placed WHERE place = 1
  UNION ALL
  SELECT n.shard, min(n.place) AS place
  FROM opens o JOIN placed f ON f.shard = o.shard AND f.place = o.place
  JOIN placed n ON n.shard = f.shard AND n.place > f.place
    AND (n.before - f.before >= 800 OR n.t - f.t >= INTERVAL 12 HOURS)
  GROUP BY n.shard)
SELECT event_id, CAST(count(o.place) OVER (PARTITION BY p.shard ORDER BY p.place) - 1 AS BIGINT) AS batch
FROM placed p LEFT JOIN opens o USING (shard, place)""")
def _(spark, d):
    # A third of the records are in one shard.
    shard = F.when(F.col("user_id") % 3 == 0, 8).otherwise(F.col("user_id") % 8)
    rows = events(spark, d).select("event_id", "ts", "props", shard.alias("shard_id"))
    return batch_by_size_or_age(rows, 800, 12 * 3600, ["ts", "event_id"], ts="ts", record="props").select("event_id", "batch")
