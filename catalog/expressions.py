"""Projection, predicates and scalar functions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from weir import (
    SEND_ALL, Rule, all_of, any_of, apply_rule, basename, concat, eq, first_non_null, ge, getdir, gt, join_,
    json_get, le, lt, ne, rand_, sprintf, str_, time_,
)

from .base import REC, events, query, records, table


def _sent(df, send, when=None, keep=("event_id",)):
    rule = Rule("one", "debug", when=when, send=send)
    return apply_rule(df, rule, keep=list(keep)).select(*keep, "outbound")


def _projection(name, send, outbound):
    sql = f"WITH {REC} SELECT event_id, {outbound} AS outbound FROM rec"
    query(name, sql)(lambda spark, d: _sent(records(spark, d), send))


def _predicate(name, when, where):
    sql = f"""WITH {REC} SELECT event_id, '{{"id":' || event_id || '}}' AS outbound FROM rec WHERE {where}"""
    query(name, sql)(lambda spark, d: _sent(records(spark, d), lambda r: {"id": r.json("event_id")}, when))


# Projection ---------------------------------------------------------------

_projection(
    "send_outbound",
    lambda r: {"user": r.json("user_id"), "kind": r.json("event_type"), "absent": r.json("nowhere")},
    """'{"absent":null,"kind":"' || event_type || '","user":' || user_id || '}'""")
_projection("send_empty", None, "'{}'")
_projection("send_alias", lambda r: [("renamed", r.json("event_type")), ("renamed", r.json("user_id"))],
            """'{"renamed":' || user_id || '}'""")
_projection("send_default_name", lambda r: [r.json("props.k"), r.json("event_type")],
            """'{"event_type":"' || event_type || '","props.k":' || k || '}'""")
_projection(
    "send_typed",
    lambda r: {"v": r.json("value"), "flag": r.json("flag"), "obj": r.json("props"), "none": r.json("maybe"),
               "list": r.json("list")},
    """'{"flag":' || CASE WHEN event_id % 3 = 0 THEN 'true' ELSE 'false' END
       || ',"list":' || CASE WHEN event_id % 2 = 0 THEN '["' || event_type || '",' || k || ',null]'
                             ELSE '"' || event_type || '"' END
       || ',"none":' || CASE WHEN event_id % 5 = 0 THEN 'null' ELSE '"' || event_type || '"' END
       || ',"obj":{"deep":{"event_type":"' || event_type || '"},"k":' || k || '},"v":' || vtxt || '}'""")
_projection(
    "send_nested",
    lambda r: {"text": concat(str_("<"), sprintf("%v/%v", r.json("event_type"), concat(r.json("props.k"), "!")), ">"),
               "pick": basename(sprintf("%v/%v", r.json("user_id"), r.json("event_type")))},
    """'{"pick":"' || event_type || '","text":"<' || event_type || '/' || k || '!>"}'""")


@query("send_all", """
SELECT event_id, props AS outbound FROM events""")
def _(spark, d):
    return _sent(events(spark, d).withColumnRenamed("props", "record"), SEND_ALL)


# Predicates ---------------------------------------------------------------

_predicate("pred_eq", lambda r: eq(r.json("event_type"), "purchase"), "event_type = 'purchase'")
_predicate("pred_eq_number", lambda r: eq(r.json("props.k"), "42"), "k = 42")
_predicate("pred_eq_number_spelling", lambda r: eq(r.json("props.k"), "26.00"), "k = 26")
_predicate("pred_eq_null", lambda r: eq(r.json("maybe"), None), "event_id % 5 = 0")
_predicate("pred_eq_missing", lambda r: eq(r.json("nowhere.at.all"), "null"), "true")
_predicate("pred_eq_bool", lambda r: eq(r.json("flag"), True), "event_id % 3 = 0")
_predicate("pred_ne", lambda r: ne(r.json("event_type"), "click"), "event_type <> 'click'")
_predicate("pred_ne_missing", lambda r: ne(r.json("maybe"), "click"), "event_id % 5 = 0 OR event_type <> 'click'")
_predicate("pred_not_null", lambda r: ne(r.json("maybe"), "null"), "event_id % 5 <> 0")
_predicate("pred_lt", lambda r: lt(r.json("value"), 20), "value < 20")
_predicate("pred_le", lambda r: le(r.json("props.k"), "50"), "k <= 50")
_predicate("pred_gt", lambda r: gt(r.json("props.k"), 50), "k > 50")
_predicate("pred_ge", lambda r: ge(r.json("value"), "20"), "value >= 20")
_predicate("pred_fields", lambda r: gt(r.json("value"), r.json("props.k")), "value > k")
_predicate("pred_num_default", lambda r: lt(r.json("mixed"), 10),
           "(CASE WHEN event_id % 4 = 0 THEN k ELSE 0 END) < 10")
_predicate("pred_and", lambda r: all_of(eq(r.json("event_type"), "purchase"), ge(r.json("value"), 20)),
           "event_type = 'purchase' AND value >= 20")
_predicate("pred_or", lambda r: any_of(eq(r.json("event_type"), "purchase"), eq(r.json("props.k"), 42)),
           "event_type = 'purchase' OR k = 42")
_predicate(
    "pred_cnf",
    lambda r: all_of(any_of(eq(r.json("event_type"), "click"), eq(r.json("event_type"), "view")),
                     any_of(gt(r.json("props.k"), 90), lt(r.json("value"), 5)), ne(r.json("maybe"), None)),
    "event_type IN ('click', 'view') AND (k > 90 OR value < 5) AND event_id % 5 <> 0")
_predicate("pred_empty", None, "true")


@query("pred_error_drop", f"""
WITH {REC}
SELECT event_id, '{{"all":"' || event_type || ';' || k || ';<nil>"}}' AS outbound
FROM rec WHERE event_id % 2 = 0""")
def _(spark, d):
    return _sent(records(spark, d), lambda r: {"all": join_("SEMICOLON", r.json("list"))})


# Scalar functions ---------------------------------------------------------

@query("json_get", f"WITH {REC} SELECT event_id, event_type AS found FROM rec")
def _(spark, d):
    return records(spark, d).select("event_id", json_get("event_type").alias("found"))


@query("json_nested", f"WITH {REC} SELECT event_id, event_type AS found FROM rec")
def _(spark, d):
    return records(spark, d).select("event_id", json_get("props.deep.event_type").alias("found"))


@query("json_index", f"WITH {REC} SELECT event_id, CASE WHEN event_id % 2 = 0 THEN CAST(k AS VARCHAR) END AS found FROM rec")
def _(spark, d):
    return records(spark, d).select("event_id", json_get("list.1").alias("found"))


@query("json_missing", "SELECT event_id, CAST(NULL AS VARCHAR) AS found FROM events")
def _(spark, d):
    return records(spark, d).select("event_id", json_get("props.nowhere").alias("found"))


_projection("fn_str", lambda r: {"k": str_(r.json("props.k")), "word": str_("fixed")},
            """'{"k":"' || k || '","word":"fixed"}'""")
_projection("fn_concat", lambda r: {"c": concat(r.json("event_type"), "-", r.json("props.k"), "-", r.json("nowhere"))},
            """'{"c":"' || event_type || '-' || k || '-null"}'""")
_projection("fn_sprintf", lambda r: {"s": sprintf("%v is 100%% %v (%v)", r.json("user_id"), r.json("value"), r.json("no"))},
            """'{"s":"' || user_id || ' is 100% ' || vtxt || ' (null)"}'""")
@query("fn_sprintf_template", f"""
WITH {REC} SELECT event_id, '{{"s":"' || CASE event_type WHEN 'click' THEN event_type || ' 100% ' || k WHEN 'view' THEN 'fixed'
                                            ELSE k || ':' || event_type END || '"}}' AS outbound
FROM rec WHERE event_type <> 'error'""")
def _(spark, d):
    # Click and view bring templates of their own, errors one that wants too much.
    template = (F.when(F.col("event_type") == "click", "%v 100%% %v").when(F.col("event_type") == "view", "fixed")
                .when(F.col("event_type") == "error", "%v%v%v").otherwise(F.concat("k", F.lit(":%v"))))
    df = events(spark, d).select("event_id", F.to_json(F.struct(template.alias("t"), "event_type", "k")).alias("record"))
    return _sent(df, lambda r: {"s": sprintf(r.json("t"), r.json("event_type"), r.json("k"))})


_projection("fn_first_non_null",
            lambda r: {"a": first_non_null(r.json("maybe"), r.json("props.k")), "b": first_non_null(r.json("no"), r.json("way"))},
            """'{"a":' || CASE WHEN event_id % 5 = 0 THEN CAST(k AS VARCHAR) ELSE '"' || event_type || '"' END || ',"b":""}'""")

_BASE, _DIR = "regexp_extract(url, '[^/]*$')", "left(url, length(url) - length(regexp_extract(url, '[^/]*$')) - 1)"


def _paths(name, send, sep, sql):
    @query(name, f"SELECT page_id, CAST(json_object('out', {sql}) AS VARCHAR) AS outbound FROM pages")
    def _(spark, d):
        path = F.translate("url", "/", sep)
        df = table(spark, d, "pages").select("page_id", F.to_json(F.struct(path.alias("path"))).alias("record"))
        return _sent(df, lambda r: {"out": send(r.json("path"))}, keep=["page_id"])


_paths("fn_basename", basename, "/", _BASE)
_paths("fn_basename_windows", lambda p: basename(p, "WINDOWS"), "\\", _BASE)
_paths("fn_basename_other_style", lambda p: basename(p, "WINDOWS"), "/", "url")
_paths("fn_getdir", getdir, "/", _DIR)
_paths("fn_getdir_windows", lambda p: getdir(p, "windows"), "\\", f"replace({_DIR}, '/', chr(92))")
_paths("fn_getdir_other_style", lambda p: getdir(p, "WINDOWS"), "/", "''")


@query("fn_join", """
SELECT vec_id, '{"all":"' || array_to_string(list_transform(embedding,
         lambda x: CAST(floor(CAST(x AS DOUBLE) * 1000) AS BIGINT)), ',') || '"}' AS outbound
FROM embeddings""")
def _(spark, d):
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * 1000))
    df = table(spark, d, "embeddings").select("vec_id", F.to_json(F.struct(scaled.alias("e"))).alias("record"))
    return _sent(df, lambda r: {"all": join_("comma", r.json("e"))}, keep=["vec_id"])


@query("fn_rand", """
SELECT count(*) AS float32_in, count(*) AS float64_in, count(*) AS uint32_in, count(*) AS uint64_in FROM events""")
def _(spark, d):
    drawn = table(spark, d, "events").select(
        rand_("FLOAT32").alias("a"), rand_("FLOAT64").alias("b"), rand_("UINT32").alias("c"), rand_().alias("e"))
    return drawn.agg(
        F.count_if((F.col("a") >= 0) & (F.col("a") < 1)).alias("float32_in"),
        F.count_if((F.col("b") >= 0) & (F.col("b") < 1)).alias("float64_in"),
        F.count_if(F.col("c").between(0, 4294967295)).alias("uint32_in"),
        F.count_if(F.col("e").between(0, Decimal(2**64 - 1))).alias("uint64_in"))


@query("fn_time", """
SELECT event_id, CAST(hour(ts) AS INTEGER) AS h, CAST(minute(ts) AS INTEGER) AS m, CAST(second(ts) AS INTEGER) AS s,
       epoch_us(ts) // 1000 AS ms FROM events""")
def _(spark, d):
    ts = F.col("ts")
    return events(spark, d).select(
        "event_id", time_("H", ts).alias("h"), time_("M", ts).alias("m"), time_("S", ts).alias("s"),
        time_("MS", ts).alias("ms"))


@query("fn_time_now", "SELECT count(*) AS sane FROM events")
def _(spark, d):
    sane = (time_("H").between(0, 23) & time_("M").between(0, 59) & time_("S").between(0, 59)
            & (time_() > F.unix_millis("ts")))
    return events(spark, d).agg(F.count_if(sane).alias("sane"))
