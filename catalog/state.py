"""First-seen tests, caches and their streaming forms."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir import (
    KeyStore, Rule, RuleSet, cache_asof, cache_check, cache_clear, cache_fetch, cache_put, cache_remove, eq, gt, key_hash,
    read_counts, register_sink, route, run_router, seen_add, seen_clear, seen_count, seen_lookup, seen_remove,
    StreamCache, stream_unique, unique_filter,
    unique_flag, work_folder,
)

from .base import REC, event_stream, events, query, records, table


@query("unique_flag", """
SELECT doc_id, CASE WHEN row_number() OVER (PARTITION BY source ORDER BY doc_id) = 1 THEN 'true' ELSE 'false' END AS first_seen
FROM documents""")
def _(spark, d):
    return unique_flag(table(spark, d, "documents").select("doc_id", "source"), ["source"], ["doc_id"]).drop("source")


@query("unique_flag_multi", """
SELECT doc_id, CASE WHEN row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) = 1 THEN 'true' ELSE 'false' END AS first_seen
FROM documents""")
def _(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source")
    return unique_flag(docs, ["lang", "source"], ["doc_id"]).select("doc_id", "first_seen")


@query("unique_filter", """
SELECT event_id, user_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1""")
def _(spark, d):
    rows = table(spark, d, "events").select("event_id", "user_id", "event_type")
    return unique_filter(rows, ["user_id", "event_type"], ["event_id"])


def _firsts_by_user(rows, order, first_column):
    """Per user: how many rows are first, how many there are, and a column of the first row."""
    first = F.col("first_seen") == "true"
    flagged = unique_flag(rows, ["user_id"], [order])
    return flagged.groupBy("user_id").agg(
        F.count_if(first).alias("firsts"), F.count("*").alias("n"), F.max(F.when(first, first_column)).alias("first"))


@query("unique_ties", """
SELECT user_id, CAST(1 AS BIGINT) AS firsts, count(*) AS n, CAST(min(CAST(ts AS DATE)) AS VARCHAR) AS first
FROM events GROUP BY user_id""")
def _(spark, d):
    rows = events(spark, d).select("event_id", "user_id", F.to_date("ts").alias("day"))
    return _firsts_by_user(rows, "day", F.col("day").cast("string"))


@query("unique_null_order", """
SELECT user_id, CAST(1 AS BIGINT) AS firsts, count(*) AS n,
       CASE WHEN count(*) FILTER (event_type = 'click') > 0 THEN -1 ELSE min(event_id) END AS first
FROM events GROUP BY user_id""")
def _(spark, d):
    rows = table(spark, d, "events").select(
        "event_id", "user_id", F.when(F.col("event_type") != "click", F.col("event_id")).alias("place"))
    return _firsts_by_user(rows, "place", F.coalesce("place", F.lit(-1).cast("long")))


@query("rule_unique", f"""
WITH {REC} SELECT event_id, '{{"user":' || user_id || '}}' AS outbound
FROM rec WHERE event_type = 'purchase'
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1""")
def _(spark, d):
    def first_purchase(r):
        bought = eq(r.json("event_type"), "purchase")
        return bought & eq(r.unique(r.json("user_id"), given=bought), True)

    rules = RuleSet([Rule("first", "emit", when=first_purchase, send=lambda r: {"user": r.json("user_id")})])
    return route(records(spark, d), rules, keep=["event_id"], order=["event_id"]).select("event_id", "outbound")


CACHING = RuleSet([
    Rule("remember", "batch", when=lambda r: eq(r.json("event_type"), "purchase"),
         send=lambda r: {"now": r.fetch("bought")},
         cache=lambda r: {"bought": r.json("value")}, cache_matching_only=True),
    Rule("after_click", "emit", when=lambda r: eq(r.fetch("before"), "click"),
         send=lambda r: {"bought": r.fetch("bought")}, cache=lambda r: {"before": r.json("event_type")}),
])


@query("rule_cache", f"""
WITH {REC}, kept AS (
  SELECT event_id, user_id, event_type, vtxt,
         last_value(CASE WHEN event_type = 'purchase' THEN vtxt END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id) AS bought,
         lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS before
  FROM rec)
SELECT event_id, 'after_click' AS rule, '{{"bought":' || coalesce(bought, 'null') || '}}' AS outbound FROM kept WHERE before = 'click'
UNION ALL
SELECT event_id, 'remember', '{{"now":' || bought || '}}' FROM kept WHERE event_type = 'purchase'""")
def _(spark, d):
    routed = route(records(spark, d), CACHING, keep=["event_id"], scope=["user_id"], order=["event_id"])
    return routed.select("event_id", "rule", "outbound")


@query("rule_cache_ties", f"""
WITH {REC}, twice AS (SELECT * FROM rec UNION ALL SELECT * FROM rec WHERE event_id % 3 = 0), kept AS (
  SELECT event_id, user_id, event_type, vtxt,
         last_value(CASE WHEN event_type = 'purchase' THEN vtxt END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id) AS bought,
         lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS before
  FROM twice)
SELECT event_id, 'after_click' AS rule, '{{"bought":' || coalesce(bought, 'null') || '}}' AS outbound FROM kept WHERE before = 'click'
UNION ALL
SELECT event_id, 'remember', '{{"now":' || bought || '}}' FROM kept WHERE event_type = 'purchase'""")
def _(spark, d):
    rows = records(spark, d)
    twice = rows.unionByName(rows.where(F.pmod("event_id", F.lit(3)) == 0))
    routed = route(twice, CACHING, keep=["event_id"], scope=["user_id"], order=["event_id"])
    return routed.select("event_id", "rule", "outbound")


@query("stream_rules", f"""
WITH {REC}, kept AS (
  SELECT event_id, user_id, event_type, vtxt,
         last_value(CASE WHEN event_type = 'purchase' THEN vtxt END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id) AS bought,
         lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS before,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS nth
  FROM rec)
SELECT event_id, 'after_click' AS rule, '{{"bought":' || coalesce(bought, 'null') || '}}' AS outbound FROM kept WHERE before = 'click'
UNION ALL
SELECT event_id, 'remember', '{{"now":' || bought || '}}' FROM kept WHERE event_type = 'purchase'
UNION ALL
SELECT event_id, 'first', '{{}}' FROM kept WHERE nth = 1""")
def _(spark, d):
    out = work_folder(spark, "rules")

    def rows(matches, batch_id, params):
        matches.write.mode("overwrite").parquet(f"{out}/rows/{params['rule']}/b{batch_id}")

    register_sink("rows", rows)
    first = Rule("first", "rows", when=lambda r: eq(r.unique(r.json("user_id"), r.json("event_type")), True))
    rules = RuleSet(
        Rule(**{**rule.__dict__, "destination": "rows", "params": {"rule": rule.name}}) for rule in [*CACHING, first])
    stream = event_stream(spark, d).select(
        "event_id", "user_id", F.to_json(F.struct("user_id", "event_type", "value")).alias("record"))
    run_router(stream, rules, f"{out}/progress", keep=["event_id"], scope=["user_id"], order=["event_id"],
               remember=None).awaitTermination()
    return spark.read.parquet(f"{out}/rows/*/*").select("event_id", "rule", "outbound")


_SEEN, _DOCS = "labels", "documents"


@query("seen_lookup", "SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def _(spark, d):
    return seen_lookup(table(spark, d, _DOCS).select("doc_id"), table(spark, d, _SEEN).select("doc_id"))


@query("seen_add", "SELECT source FROM documents UNION SELECT role FROM conversations")
def _(spark, d):
    seen = table(spark, d, _DOCS).select("source").distinct()
    return seen_add(seen, table(spark, d, "conversations").select(F.col("role").alias("source")))


@query("seen_remove", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def _(spark, d):
    return seen_remove(table(spark, d, _DOCS).select("doc_id"), table(spark, d, _SEEN).select("doc_id"))


@query("seen_count", "SELECT count(DISTINCT source) AS keys FROM documents")
def _(spark, d):
    docs = table(spark, d, _DOCS).select("source")
    return seen_count(seen_add(seen_clear(docs), docs))


@query("key_hash", """
SELECT count(DISTINCT source) AS keys, count(DISTINCT source) AS hashes, count(DISTINCT source) AS pairs FROM documents""")
def _(spark, d):
    # One hash per key, and different ones: a constant would not pass.
    docs = table(spark, d, "documents").where("source IS NOT NULL").select("source", key_hash("source").alias("hash"))
    return docs.agg(F.countDistinct("source").alias("keys"), F.countDistinct("hash").alias("hashes"),
                    F.countDistinct("source", "hash").alias("pairs"))


@query("cache_put", """
SELECT conv_id, arg_max(role, turn) AS role, arg_max(text, turn) AS text FROM conversations GROUP BY conv_id""")
def _(spark, d):
    values = {"role": "role", "text": "text", " ": "turn"}
    return cache_put(table(spark, d, "conversations"), values, ["turn"], scope=["conv_id"])


@query("cache_fetch", """
SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS)
                 OVER (PARTITION BY user_id ORDER BY event_id) AS cached
FROM events""")
def _(spark, d):
    rows = table(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    out = cache_fetch(rows, "value", ["event_id"], into="cached", scope=["user_id"],
                      when=F.col("event_type") == "purchase")
    return out.select("event_id", "cached")


@query("cache_fetch_prev", """
SELECT conv_id, turn, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS cached FROM conversations""")
def _(spark, d):
    rows = table(spark, d, "conversations").select("conv_id", "turn", "role")
    out = cache_fetch(rows, "role", ["turn"], into="cached", scope=["conv_id"], include_current=False)
    return out.drop("role")


@query("cache_fetch_own", "SELECT conv_id, turn, role AS cached FROM conversations")
def _(spark, d):
    rows = table(spark, d, "conversations").select("conv_id", "turn", "role")
    return cache_fetch(rows, "role", ["turn"], into="cached", scope=["conv_id"]).drop("role")


@query("cache_fetch_global", """
SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN user_id END IGNORE NULLS) OVER (ORDER BY event_id) AS cached
FROM events""")
def _(spark, d):
    rows = table(spark, d, "events").select("event_id", "user_id", "event_type")
    out = cache_fetch(rows, "user_id", ["event_id"], into="cached", when=F.col("event_type") == "purchase")
    return out.select("event_id", "cached")


@query("cache_asof", """
SELECT r.event_id, w.value AS cached
FROM (SELECT * FROM events WHERE event_type = 'error') r
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') w
  ON r.user_id = w.user_id AND r.event_id >= w.event_id""")
def _(spark, d):
    rows = table(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    readers = rows.where(F.col("event_type") == "error").select("event_id", "user_id")
    writers = rows.where(F.col("event_type") == "purchase").select("event_id", "user_id", "value")
    return cache_asof(readers, writers, "value", ["event_id"], into="cached", scope=["user_id"]).drop("user_id")


def _cached_big(spark, d):
    rows = table(spark, d, "events").select("event_id", "user_id", "value")
    return cache_put(rows, {"last_big": "value"}, ["event_id"], scope=["user_id"], when=F.col("value") >= 100)


@query("cache_check", "SELECT DISTINCT user_id FROM events WHERE value >= 100")
def _(spark, d):
    users = table(spark, d, "events").select("user_id").distinct()
    return cache_check(users, _cached_big(spark, d), ["user_id"])


@query("cache_remove", """
SELECT user_id, arg_max(value, event_id) AS last_big FROM events WHERE value >= 100
GROUP BY user_id HAVING user_id NOT IN (SELECT user_id FROM events WHERE value >= 200)""")
def _(spark, d):
    gone = table(spark, d, "events").where("value >= 200").select("user_id")
    return cache_remove(_cached_big(spark, d), gone, ["user_id"])


@query("cache_clear", "SELECT user_id, value AS last_big FROM events WHERE false")
def _(spark, d):
    return cache_clear(_cached_big(spark, d))


def _in_ten_turns(spark, rows, turn, folder):
    """A stream to which the rows with ``turn`` 0 are appended first, then those with 1, up to 9, as files of many tasks.

    The table is read once and its rows are dealt out, as it may be one row group, which a single task reads; by their hash,
    as dealing them out in turn would sort them in that task. Run to its end after each, the stream makes ten micro-batches
    and goes on from its checkpoint nine times.
    """
    dealt = rows.withColumn("__turn", turn.cast("int")).repartition(spark.sparkContext.defaultParallelism, *rows.columns)
    dealt.write.partitionBy("__turn").parquet(f"{folder}/turns")
    turns = spark.read.schema(T.StructType([*rows.schema, T.StructField("__turn", T.IntegerType())])).parquet(f"{folder}/turns")
    for k in range(10):
        turns.where(F.col("__turn") == k).drop("__turn").write.mode("append").parquet(f"{folder}/in")
        yield spark.readStream.schema(rows.schema).parquet(f"{folder}/in")


@query("stream_unique", """
SELECT event_id, user_id, event_type, CASE WHEN row_number() OVER (
  PARTITION BY user_id, event_type ORDER BY event_id % 10, event_id) = 1 THEN 'true' ELSE 'false' END AS first_seen
FROM events""")
def _(spark, d):
    # Most rows come after later ones of their key: in every micro-batch a tenth of all times.
    rows = events(spark, d).select("event_id", "user_id", "event_type")
    folder = work_folder(spark, "unique")
    for stream in _in_ten_turns(spark, rows, F.pmod("event_id", F.lit(10)), folder):
        stream_unique(stream, ["user_id", "event_type"], ["event_id"], f"{folder}/progress", f"{folder}/out",
                      remember=None).awaitTermination()
    return spark.read.parquet(f"{folder}/out").drop("batch")


@query("stream_cache", """
SELECT event_id, user_id, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS cached FROM events""")
def _(spark, d):
    # Ten micro-batches of three days; every seventh row comes in the one after its own.
    rows = events(spark, d).select("event_id", "user_id", "value", "ts")
    day = F.dayofmonth("ts") - 1
    turn = F.least(F.floor(day / 3) + F.when(F.pmod("event_id", F.lit(7)) == 0, 1).otherwise(0), F.lit(9))
    folder = work_folder(spark, "cache")
    cache = StreamCache("value", ["user_id"], ["event_id"], f"{folder}/progress", into="cached", ts="ts", delay="7 days")
    for stream in _in_ten_turns(spark, rows, turn, folder):
        cache.start(stream, f"{folder}/out").awaitTermination()
    cache.flush(spark, rows.schema, f"{folder}/out")
    return spark.read.parquet(f"{folder}/out").select("event_id", "user_id", "cached")


@query("seen_store", """
SELECT user_id, max(event_id) AS last FROM events WHERE event_id % 20 < 19 GROUP BY user_id
HAVING user_id NOT IN (SELECT user_id FROM events WHERE event_id % 20 = 18 AND event_type = 'error')""")
def _(spark, d):
    # Eighteen micro-batches put each user's last event, one more removes users; then the store is read.
    rows = table(spark, d, "events").select("event_id", "user_id", "event_type")
    folder = work_folder(spark, "store")
    keys, values = [rows.schema["user_id"]], [T.StructField("last", T.LongType())]
    for k in range(20):
        store = KeyStore(spark, folder, keys, values, k)
        part = rows.where(F.pmod("event_id", F.lit(20)) == k)
        if k < 19:
            new = part.groupBy("user_id").agg(F.max("event_id").cast("long").alias("last"))
            old = store.lookup(new.select("user_id")).select("user_id", F.col("last").alias("before"))
            store.put(new.join(old, "user_id", "left").select("user_id", F.greatest("last", "before").alias("last")))
        else:
            store.remove(rows.where("event_id % 20 = 18 AND event_type = 'error'").select("user_id").distinct())
        store.save()
    return KeyStore(spark, folder, keys, values, 20).rows()


@query("stream_counts", """
WITH rec AS (
  SELECT event_id, ts, event_id % 70 = 0 AS cut, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         strlen(props) - CASE WHEN event_id % 70 = 0 THEN 1 ELSE 0 END AS size
  FROM events)
SELECT event_id % 10 AS batch, count(*) AS records, sum(size)::BIGINT AS bytes, epoch_us(max(ts)) // 1000 AS newest,
       (count_if(NOT cut AND k > 50) + count(*))::BIGINT AS matches,
       (coalesce(sum(strlen('{"k":' || k || '}')) FILTER (NOT cut AND k > 50), 0) + 2 * count(*))::BIGINT AS sent_bytes,
       count_if(cut)::BIGINT AS errors
FROM rec GROUP BY 1""")
def _(spark, d):
    # Ten micro-batches with some records cut off: an error each, and a match of the rule that takes everything. The stream stops at a failing sink and starts again.
    text = F.when(F.col("event_id") % 70 == 0, F.expr("left(props, length(props) - 1)")).otherwise(F.col("props"))
    rows = events(spark, d).select("event_id", "ts", text.alias("record"))
    folder = work_folder(spark, "counts")
    down = [4]

    def sink(matches, batch_id, params):
        if down and batch_id == down[0]:
            down.clear()
            raise OSError("down")

    register_sink("counted", sink)
    rules = RuleSet([
        Rule("high", "files", when=lambda r: gt(r.json("k"), 50), send=lambda r: {"k": r.json("k")},
             params={"path": f"{folder}/high"}),
        Rule("all", "counted"),
    ])

    def run(stream):
        run_router(stream, rules, f"{folder}/progress", keep=["event_id"], errors=f"{folder}/errors",
                   counts=f"{folder}/counts", ts="ts").awaitTermination()

    for stream in _in_ten_turns(spark, rows, F.pmod("event_id", F.lit(10)), folder):
        try:
            run(stream)
        except StreamingQueryException:
            run(stream)  # the failed micro-batch is taken again
    return read_counts(spark, f"{folder}/counts").select(
        "batch", "records", "bytes", "newest", "matches", "sent_bytes", "errors")
