"""Rulesets over all records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir import (
    SEND_ALL, ListedRule, Rule, RuleSet, all_of, any_of, apply_rule, eq, fan_out, ge, gt, join_, lt, match_counts, ne, publish, read_once, read_records, route,
    ruleset_table, split_by_destination, split_errors, sprintf, work_folder, write_batches, read_batches, run_router,
)

from .base import REC, event_stream, query, records, table

PURCHASES = Rule(
    "purchases", "emit",
    when=lambda r: all_of(eq(r.json("event_type"), "purchase"), ge(r.json("value"), 20)),
    send=lambda r: {"user": r.json("user_id"), "amount": r.json("value"),
                    "id": sprintf("%v-%v", r.json("user_id"), r.json("event_id"))},
)
RULES = RuleSet([
    PURCHASES,
    Rule("high", "batch", when=lambda r: gt(r.json("props.k"), 50), send=lambda r: {"k": r.json("props.k")}),
    Rule("errors", "batch", when=lambda r: any_of(eq(r.json("event_type"), "error"), lt(r.json("value"), 1)),
         send=lambda r: {"type": r.json("event_type"), "value": r.json("value")}),
    Rule("flagged", "debug", when=lambda r: all_of(eq(r.json("flag"), True), ne(r.json("maybe"), None)),
         send=lambda r: {"id": r.json("event_id")}, checkpoint=False),
    Rule("everything", "debug", send=None, checkpoint=False),
])

_PURCHASE_SQL = """'{"amount":' || vtxt || ',"id":"' || user_id || '-' || event_id || '","user":' || user_id || '}'"""
ROUTED = f"""{REC}, routed AS (
  SELECT event_id, user_id, ts, 'purchases' AS rule, 'emit' AS destination, true AS checkpoint, {_PURCHASE_SQL} AS outbound
  FROM rec WHERE event_type = 'purchase' AND value >= 20
  UNION ALL SELECT event_id, user_id, ts, 'high', 'batch', true, '{{"k":' || k || '}}' FROM rec WHERE k > 50
  UNION ALL SELECT event_id, user_id, ts, 'errors', 'batch', true, '{{"type":"' || event_type || '","value":' || vtxt || '}}'
  FROM rec WHERE event_type = 'error' OR value < 1
  UNION ALL SELECT event_id, user_id, ts, 'flagged', 'debug', false, '{{"id":' || event_id || '}}'
  FROM rec WHERE event_id % 3 = 0 AND event_id % 5 <> 0
  UNION ALL SELECT event_id, user_id, ts, 'everything', 'debug', false, '{{}}' FROM rec)"""


@query("rule_single", f"""
WITH {REC} SELECT event_id, {_PURCHASE_SQL} AS outbound FROM rec WHERE event_type = 'purchase' AND value >= 20""")
def rule_single(spark, d):
    return apply_rule(records(spark, d), PURCHASES).select("event_id", "outbound")


@query("route_all", f"WITH {ROUTED} SELECT event_id, rule, destination, checkpoint, outbound FROM routed")
def _(spark, d):
    return route(records(spark, d), RULES, keep=["event_id"])


@query("route_counts", f"WITH {ROUTED} SELECT rule, count(*) AS matches FROM routed GROUP BY rule")
def _(spark, d):
    return match_counts(route(records(spark, d), RULES))


@query("route_by_dest", f"""
WITH {ROUTED} SELECT destination, count(*) AS sent, sum(length(outbound))::BIGINT AS chars FROM routed GROUP BY destination""")
def _(spark, d):
    routed = route(records(spark, d), RULES)
    parts = [
        part.groupBy("destination").agg(F.count("*").alias("sent"), F.sum(F.length("outbound")).alias("chars"))
        for part in split_by_destination(routed, RULES, work_folder(spark, "split")).values()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


@query("route_many_rules", f"""
WITH {REC}, cuts AS (SELECT unnest(range(60)) AS cut)
SELECT 'over-' || cut AS rule, count(*) AS matches FROM rec JOIN cuts ON k > cut AND value >= cut GROUP BY cut""")
def _(spark, d):
    def over(cut):
        return Rule(f"over-{cut}", "debug", when=lambda r: all_of(gt(r.json("props.k"), cut), ge(r.json("value"), cut)),
                    send=lambda r: {"id": r.json("event_id")})

    return match_counts(route(records(spark, d), RuleSet(over(c) for c in range(60)), keep=[]))


def _listed(n):
    """Rules of three kinds, ``n`` in all: one user's events, a kind of event above a value, values in a narrow band."""
    kinds = ["click", "error", "purchase", "view", "signup"]
    for i in range(n):
        low = 100 + i * 0.1
        yield ListedRule(f"listed-{i}", "debug", [
            [[("user_id", "==", i)], [("value", ">=", i % 50)]],
            [[("event_type", "==", kinds[i % 5]), ("props.k", "==", i % 100)], [("value", ">", low)]],
            [[("value", ">=", low)], [("value", "<", low + 1)], [("maybe", "!=", None)]],
        ][i % 3], {"id": "event_id", "k": "props.k"})


@query("route_thousands", f"""
WITH {REC}, listed AS (SELECT i, ['click', 'error', 'purchase', 'view', 'signup'][i % 5 + 1] AS kind, 100 + i * 0.1::DOUBLE AS low
                       FROM (SELECT unnest(range(2000)) AS i))
SELECT event_id, 'listed-' || i AS rule, '{{"id":' || event_id || ',"k":' || k || '}}' AS outbound
FROM rec JOIN listed ON CASE i % 3 WHEN 0 THEN user_id = i AND value >= i % 50
                                   WHEN 1 THEN (event_type = kind OR k = i % 100) AND value > low
                                   ELSE value >= low AND value < low + 1 AND event_id % 5 <> 0 END""")
def _(spark, d):
    # A record costs some dozens of lookups here, and a file of one row group would be one task.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return fan_out(records(spark, d, tasks), _listed(2000), keep=["event_id"]).select("event_id", "rule", "outbound")


@query("route_errors", f"""
WITH {REC}, kinds AS (SELECT *, CASE WHEN event_id % 7 = 0 THEN 'cut' WHEN event_id % 2 = 0 THEN 'array' ELSE 'text' END AS kind FROM rec)
SELECT event_id, 'tested' AS rule, 'list: no array' AS error FROM kinds WHERE kind <> 'array'
UNION ALL SELECT event_id, 'sent', 'list: no array' FROM kinds WHERE kind = 'text' AND k > 50
UNION ALL SELECT event_id, NULL, 'record: no JSON' FROM kinds WHERE kind = 'cut'
UNION ALL SELECT event_id, 'tested', NULL FROM kinds WHERE kind = 'array' AND event_type = 'error'
UNION ALL SELECT event_id, 'sent', NULL FROM kinds WHERE kind = 'array' AND k > 50
UNION ALL SELECT event_id, 'sound', NULL FROM kinds WHERE kind <> 'cut' AND k > 50""")
def _(spark, d):
    cut = F.when(F.col("event_id") % 7 == 0, F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    rules = RuleSet([
        Rule("tested", "debug", when=lambda r: eq(join_("DASH", r.json("list")), sprintf("error-%v-<nil>", r.json("props.k")))),
        Rule("sent", "debug", when=lambda r: gt(r.json("props.k"), 50), send=lambda r: {"l": join_("DASH", r.json("list"))}),
        Rule("sound", "debug", when=lambda r: gt(r.json("props.k"), 50)),
    ])
    routed = route(records(spark, d).withColumn("record", cut), rules, keep=["event_id"], errors=True)
    matches, failed = split_errors(routed)
    return failed.select("event_id", "rule", "error").unionByName(
        matches.select("event_id", "rule", F.lit(None).cast("string").alias("error")))


@query("route_where", f"""
WITH {ROUTED} SELECT event_id, rule, outbound FROM routed WHERE rule = 'purchases'
UNION ALL SELECT event_id, 'late', '{{"id":' || event_id || '}}' FROM rec
WHERE ts >= TIMESTAMP '2024-01-25 00:00:00' AND k > 50""")
def _(spark, d):
    df = read_records(spark, f"{d}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    body = F.to_json(F.struct("event_id", "user_id", "event_type", "value", F.from_json("props", "k int").alias("props")))
    rules = RuleSet([
        Rule("purchases", "emit", where=(F.col("event_type") == "purchase") & (F.col("value") >= 20),
             send=PURCHASES.send),
        Rule("late", "batch", where=F.col("ts") >= F.lit("2024-01-25").cast("timestamp"),
             when=lambda r: gt(r.json("props.k"), 50), send=lambda r: {"id": r.json("event_id")}),
    ])
    return route(df.withColumn("record", body), rules, keep=["event_id"]).select("event_id", "rule", "outbound")


@query("route_wide", """
SELECT 'returned' AS rule, count(*) AS matches FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 25
UNION ALL SELECT 'open', count(*) FROM lineitem WHERE l_linestatus = 'O' OR l_discount > 0.05""")
def _(spark, d):
    df = read_records(spark, f"{d}/lineitem.parquet")
    df = df.select(F.to_json(F.struct("l_returnflag", "l_linestatus", "l_quantity", "l_discount")).alias("record"))
    rules = RuleSet([
        Rule("returned", "debug", send=SEND_ALL,
             when=lambda r: all_of(eq(r.json("l_returnflag"), "R"), ge(r.json("l_quantity"), 25))),
        Rule("open", "debug", send=SEND_ALL,
             when=lambda r: any_of(eq(r.json("l_linestatus"), "O"), gt(r.json("l_discount"), 0.05))),
    ])
    return match_counts(route(df, rules))


@query("ruleset_table", """
SELECT 'user-' || user_id AS ruleset, event_type || '-rule' AS rule, event_type IN ('error', 'purchase') AS checkpoint
FROM events GROUP BY user_id, event_type""")
def _(spark, d):
    kinds = table(spark, d, "events").select("user_id", "event_type").distinct()
    entry = F.struct(F.concat("event_type", F.lit("-rule")).alias("Rule"),
                     F.col("event_type").isin("error", "purchase").alias("checkpoint"))
    # At most one entry per event type, so a user's list stays short.
    documents = kinds.groupBy("user_id").agg(F.collect_list(entry).alias("RecordRules")).select(
        F.to_json(F.struct(F.concat(F.lit("user-"), "user_id").alias("RuleName"),
                           F.lit("stream").alias("RecordGenerator"), "RecordRules")).alias("ruleset"))
    return ruleset_table(documents).select("ruleset", "rule", "checkpoint")


@query("sink_debug", f"WITH {ROUTED} SELECT rule, count(*) AS matches FROM routed WHERE destination = 'debug' GROUP BY rule")
def _(spark, d):
    shown = RuleSet(r for r in RULES if r.destination == "debug")
    routed = route(records(spark, d), shown)
    publish(routed, shown)
    return match_counts(routed)


_DAY = "CAST(floor(epoch(ts) / 86400) * 86400 AS BIGINT)"


@query("sink_batch_files", f"""
WITH {ROUTED}, sized AS (
  SELECT {_DAY} AS slot, user_id % 4 AS shard, outbound,
         coalesce(sum(strlen(outbound) + 1) OVER (PARTITION BY {_DAY}, user_id % 4 ORDER BY event_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // 20000 AS part
  FROM routed WHERE rule = 'purchases')
SELECT strftime(make_timestamp(slot * 1000000), '%Y-%m-%d') AS dt, strftime(make_timestamp(slot * 1000000), '%H%M') AS hm,
       shard || '-' || slot || '-' || lpad(CAST(CAST(part AS BIGINT) AS VARCHAR), 6, '0') AS batch, count(*) AS lines,
       min(outbound) AS first_line
FROM sized GROUP BY ALL""")
def _(spark, d):
    sent = apply_rule(records(spark, d), PURCHASES).withColumn("shard_id", F.pmod("user_id", F.lit(4)))
    path = work_folder(spark, "batches")
    write_batches(sent, path, ["event_id"], seconds=86400, max_bytes=20000, ts="ts")
    lines = read_batches(spark, path)
    return lines.groupBy("dt", "hm", "batch").agg(F.count("*").alias("lines"), F.min("value").alias("first_line"))


@query("stream_router", f"WITH {ROUTED} SELECT outbound, count(*) AS sent FROM routed WHERE rule IN ('high', 'errors') GROUP BY outbound")
def _(spark, d):
    out = work_folder(spark, "routed")
    rules = RuleSet([
        Rule(**{**RULES[name].__dict__,
                "params": {"path": f"{out}/{name}", "order": ["event_id"], "shard": "shard_id", "ts": "ts", "seconds": 7 * 86400}})
        for name in ("high", "errors")
    ])
    stream = event_stream(spark, d).select(
        "event_id", F.pmod("user_id", F.lit(4)).alias("shard_id"), "ts",
        F.to_json(F.struct("event_type", "value", F.from_json("props", "k int").alias("props"))).alias("record"))
    run_router(stream, rules, f"{out}/progress").awaitTermination()
    lines = read_batches(spark, f"{out}/high/*").unionByName(read_batches(spark, f"{out}/errors/*"))
    return lines.groupBy(F.col("value").alias("outbound")).agg(F.count("*").alias("sent"))


@query("publish_each", f"""
WITH {ROUTED} SELECT CASE WHEN rule = 'purchases' THEN 'own' ELSE destination END AS folder, event_id, rule, outbound FROM routed""")
def _(spark, d):
    # Every rule into the folder of its destination, one rule into its own, all in one pass; the micro-batch is repeated.
    folder = work_folder(spark, "each")
    names = {r.name: "own" if r.name == "purchases" else r.destination for r in RULES}
    rules = RuleSet(Rule(**{**r.__dict__, "destination": "files", "params": {"path": f"{folder}/{names[r.name]}"}}) for r in RULES)
    routed = route(records(spark, d), rules, keep=["event_id"]).select("event_id", "rule", "outbound")
    for _again in range(2):
        publish(routed, rules, 0)
    parts = [read_once(spark, f"{folder}/{n}", routed.schema).withColumn("folder", F.lit(n)) for n in sorted(set(names.values()))]
    return reduce(DataFrame.unionByName, parts)
