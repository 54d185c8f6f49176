"""Listed rules against the same rules evaluated one by one."""

import json
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from catalog import QUERIES
from weir import SEND_ALL, ListedRule, RuleSet, fan_out, route
from weir.operators import fanout

VALUES = [None, 0, -0.0, 1, 1.5, -3, 7, 1e300, True, False, "", "1", " 1 ", "1.0", "+5", "nan", "null", "inf", "x", "-3", [1], {"k": 2}]
LITERALS = [None, 0, 1, 1.5, 7.0, -3, 2**60, True, "1", " 1 ", "1.0", "+5", "nan", "null", "inf", "x", float("nan")]
test_of = st.tuples(st.sampled_from(["a", "b", "c.d"]), st.sampled_from(["==", "==", "!=", "<", "<=", ">", ">="]),
                    st.sampled_from(LITERALS))
band_of = st.tuples(st.sampled_from([">", ">="]), st.sampled_from(["<", "<="]), st.sampled_from([-3, 0, 1, 7]), st.sampled_from([0, 1, 1.5, 9]))
lines_of = st.one_of(st.lists(st.lists(test_of, min_size=1, max_size=3), max_size=3),
                     band_of.map(lambda b: [[("a", b[0], b[2])], [("b", "!=", "x")], [("a", b[1], b[3])]]))
send_of = st.sampled_from([None, SEND_ALL, {"z": "a", "b": "c.d"}, {"none": "no.such"}])
record_of = st.one_of(st.just("no json"), st.none(), st.builds(
    lambda a, b, d: json.dumps({"a": a, "b": b, "c": {"d": d}}),
    st.sampled_from(VALUES), st.sampled_from(VALUES), st.sampled_from(VALUES)))


def rows_of(df):
    return sorted((r.i, r.rule, r.destination, r.checkpoint, str(r.outbound)) for r in df.collect())


@given(st.lists(record_of, min_size=1, max_size=25), st.lists(st.tuples(lines_of, send_of, st.booleans()), min_size=1, max_size=12))
@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_listed_rules_match_what_route_matches(spark, records, given_rules):
    rules = [ListedRule(f"r{i}", "debug", lines, send, flag) for i, (lines, send, flag) in enumerate(given_rules)]
    df = spark.createDataFrame(list(enumerate(records)), "i int, record string")
    assert rows_of(fan_out(df, rules)) == rows_of(route(df, RuleSet(r.as_rule() for r in rules)))


def test_every_value_against_every_literal(spark):
    rules = [ListedRule(f"{op} {v!r}", "debug", [[("a", op, v)]]) for op in ("==", "!=", "<", "<=", ">", ">=") for v in LITERALS]
    df = spark.createDataFrame([(i, json.dumps({"a": v})) for i, v in enumerate(VALUES)] + [(99, "{}"), (99, "{}")], "i int, record string")
    assert rows_of(fan_out(df, rules)) == rows_of(route(df, RuleSet(r.as_rule() for r in rules)))


def test_an_index_above_the_limit_is_shuffled(spark, monkeypatch):
    rules = [ListedRule(f"r{i}", "debug", [[("a", "==", i)], [("b", ">", i - 3)]], {"a": "a"}) for i in range(20)]
    df = spark.createDataFrame([(i, json.dumps({"a": i % 9, "b": i % 7})) for i in range(200)], "i int, record string")

    def plan():
        return fan_out(df, rules)._jdf.queryExecution().optimizedPlan().toString()

    wanted = rows_of(fan_out(df, rules))
    assert len(wanted) > 50 and "strategy=broadcast" in plan()
    monkeypatch.setattr(fanout, "BROADCAST_BYTES", 0)
    assert rows_of(fan_out(df, rules)) == wanted and "strategy=broadcast" not in plan()


def test_names_that_clash_and_empty_tables(spark):
    df = spark.createDataFrame([(1, 2, "x", '{"a":1}')], "slot int, at int, kind string, record string")
    rule = ListedRule("r", "debug", [[("a", ">=", 1)]])
    assert [tuple(r) for r in fan_out(df, [rule]).collect()] == [(1, 2, "x", "r", "debug", True, "{}")]
    assert fan_out(df.where("false"), [rule]).collect() == []
    with pytest.raises(ValueError):
        fan_out(df.withColumn("rule", df.kind), [rule])
    for bad in (ListedRule("r", "debug", [[]]), ListedRule("r", "debug", [[("a", "~", 1)]]), ListedRule("r", "debug", (), ["a"])):
        with pytest.raises(ValueError):
            fan_out(df, [bad])


def test_plan_does_not_grow_with_the_rules(spark):
    df = spark.createDataFrame([('{"a":1,"b":2}',)], "record string")

    def plan(n):
        rules = [ListedRule(f"r{i}", "debug", [[("a", "==", i)], [("b", ">", i)]], {"a": "a"}) for i in range(n)]
        return fan_out(df, rules)._jdf.queryExecution().analyzed().toString().count("\n")

    assert plan(10) == plan(1000)


def test_rules_that_share_a_value_are_told_apart_by_their_thresholds(spark):
    rules = [ListedRule(f"r{i}", "debug", [[("a", "==", f"k{i % 3}"), ("b", "==", i % 5)], [("c.d", ">", i)]], {"a": "a"}) for i in range(60)]
    rules += [ListedRule(f"n{i}", "debug", [[("b", "==", 7), ("a", "==", None)], [("c.d", ">=", i)], [("c.d", "<", i + 2.5)]]) for i in range(30)]
    # A lookup by the value alone would find twelve or twenty rules, whatever their thresholds.
    alone = Counter((slot, kind, text, node) for slot, kind, text, node, bound, _, _ in fanout._Index(rules).entries if not bound)
    assert max(alone.values()) <= fanout.SHARED_RULES
    records = [{"a": a, "b": b, "c": {"d": d}} for a in ("k0", "k2", None) for b in (0, 3, 7, "7", 7.0, None) for d in (-1, 0, 2.5, 29, "30", "x", None)]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "i int, record string")
    found = rows_of(fan_out(df, rules))
    assert len(found) > 400 and found == rows_of(route(df, RuleSet(r.as_rule() for r in rules)))


def test_records_of_one_split_are_dealt_out(spark, sf_dir):
    plan = QUERIES["route_thousands"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert f"Repartition {spark.conf.get('spark.sql.shuffle.partitions')}, true" in plan
