import json

import pytest
from pyspark.sql import functions as F

from weir import (
    SEND_ALL, Rule, RuleSet, all_of, apply_rule, basename, concat, eq, first_non_null, ge, getdir, gt, join_,
    load_ruleset, lt, ne, rand_, route, split_by_destination, split_errors, sprintf, str_, time_,
)

# Readings of our own making: three of each shape, no two alike.
LEVELS = [json.dumps({"depth": d, "flow": f, "gauge": g}) for d, f, g in ((7, 310, "a7"), (18, 12, "b2"), (-3, 95, "c0"))]
STATIONS = [json.dumps({"station": {"place": {"river": r, "km": km}, "crew": crew}, "open": ok}) for r, km, crew, ok in (
    ("Elbe", 412.5, ["Ida", "Per"], True), ("Tay", 31, [], False), ("Ebro", 640, ["Noa"], True))]


def sent(spark, rows, send, when=None, **options):
    df = spark.createDataFrame(list(enumerate(rows)), "i int, record string")
    out = apply_rule(df, Rule("r", "debug", when=when, send=send), **options)
    return {r.i: r.outbound for r in out.collect()}


@pytest.mark.parametrize("low, high", [(0, 100), (-10, 12), (8, 400), (500, 501)])
def test_ranges_over_levels(spark, low, high):
    got = sent(spark, LEVELS, lambda r: {"at": sprintf("%v/%v", r.json("gauge"), r.json("flow"))},
               lambda r: all_of(ge(r.json("depth"), low), lt(r.json("flow"), high)))
    want = {i: json.dumps({"at": f"{x['gauge']}/{x['flow']}"}, separators=(",", ":"))
            for i, x in enumerate(map(json.loads, LEVELS)) if x["depth"] >= low and x["flow"] < high}
    assert got == want


def test_deep_paths_of_stations(spark):
    got = sent(spark, STATIONS + LEVELS, lambda r: {"km": r.json("station.place.km"), "boat": r.json("station.boat")},
               lambda r: all_of(ne(r.json("station.place"), None), eq(r.json("open"), True)))
    assert got == {0: '{"boat":null,"km":412.5}', 2: '{"boat":null,"km":640}'}


def test_arrays_and_default_names(spark):
    assert sent(spark, STATIONS, lambda r: [r.json("open"), r.json("station.place.river")]) == {
        i: json.dumps({"open": x["open"], "station.place.river": x["station"]["place"]["river"]}, separators=(",", ":"))
        for i, x in enumerate(map(json.loads, STATIONS))}
    assert sent(spark, STATIONS + LEVELS, lambda r: {"who": join_("COMMA", r.json("station.crew"))}) == {
        0: '{"who":"Ida,Per"}', 1: '{"who":""}', 2: '{"who":"Noa"}'}
    assert sent(spark, LEVELS, lambda r: {"v": first_non_null(r.json("width"), r.json("depth"))}) == {
        0: '{"v":7}', 1: '{"v":18}', 2: '{"v":-3}'}


def test_send_all_overrides_and_empty_projection(spark):
    rows = [LEVELS[0], "not json", STATIONS[1]]
    assert sent(spark, rows, SEND_ALL) == dict(enumerate(rows))
    assert sent(spark, rows, lambda r: [("a", r.json("depth")), SEND_ALL]) == dict(enumerate(rows))
    assert sent(spark, rows, None) == dict.fromkeys(range(3), "{}")


def test_paths(spark):
    rows = [json.dumps({"p": p}) for p in ["/a/b.txt", "C:\\Sub\\Folder\\File.zip", "plain", "null", "/nullable/x", 5, None, ""]]
    out = sent(spark, rows, lambda r: {
        "b": basename(r.json("p")), "d": getdir(r.json("p")),
        "wb": basename(r.json("p"), "windows"), "wd": getdir(r.json("p"), " WINDOWS ")})
    got = {i: tuple(json.loads(o)[k] for k in ("b", "d", "wb", "wd")) for i, o in out.items()}
    win = "C:\\Sub\\Folder\\File.zip"
    assert got == {
        0: ("b.txt", "/a", "/a/b.txt", ""), 1: (win, "", "File.zip", "C:\\Sub\\Folder"), 2: ("plain", "", "plain", ""),
        3: ("", "", "", ""), 4: ("x", "/nullable", "/nullable/x", ""), 5: ("", "", "", ""), 6: ("", "", "", ""),
        7: ("", "", "", "")}


def test_join_renders_all_elements(spark):
    row = json.dumps({"l": ["a", None, 2.5, True, [1]], "e": []})
    assert json.loads(sent(spark, [row], lambda r: {"x": join_("Dash", r.json("l")), "e": join_("DOT", r.json("e")),
                                                    "u": join_("unknown", r.json("l"))})[0]) == {
        "x": "a-<nil>-2.5-true-[1]", "e": "", "u": "a<nil>2.5true[1]"}


def test_concat_sprintf_and_str(spark):
    row = json.dumps({"n": 1, "t": "x%vy", "o": {"k": 1}})
    out = json.loads(sent(spark, [row], lambda r: {
        "c": concat(r.json("t"), 7, r.json("no"), str_(r.json("o"))), "s": sprintf("%d %% %v", r.json("t"), "extra")})[0])
    assert out == {"c": 'x%vy7null{"k":1}', "s": "%d % x%vy"}
    with pytest.raises(ValueError):
        sprintf("%v %v", "one")


def test_templates_from_the_record(spark):
    rows = [json.dumps({"t": t}) for t in ("%v", "%v-%v%%", "100%%v", "", "%v%v%v", "plain %d", None)]
    out = sent(spark, rows, lambda r: {"s": sprintf(r.json("t"), "a", r.json("no"))})
    assert {i: json.loads(o)["s"] for i, o in out.items()} == {0: "a", 1: "a-null%", 2: "100%v", 3: "", 5: "plain %d"}
    assert sent(spark, rows[:4], lambda r: {"s": sprintf(r.json("t"))}) == {2: '{"s":"100%v"}', 3: '{"s":""}'}


def test_exact_integers_and_odd_keys(spark):
    row = '{"big": 9007199254740993, "a b": {"it\'s": [10, {"x": 1}]}}'
    out = sent(spark, [row], lambda r: {"big": r.json("big"), "x": r.json("a b.it's.1.x"), "z": r.json("a b.it's.0")})
    assert out == {0: '{"big":9007199254740993,"x":1,"z":10}'}


def test_each_match_is_sent_and_order_of_rules_is_kept(spark, tmp_path):
    rules = RuleSet([
        Rule("a", "one", when=lambda r: gt(r.json("flow"), 0), send=lambda r: {"v": r.json("flow")}),
        Rule("b", "two", send=SEND_ALL, checkpoint=False),
        Rule("c", "one", when=lambda r: eq(r.json("flow"), None)),
    ])
    df = spark.createDataFrame([(0, LEVELS[0]), (1, STATIONS[1]), (2, "")], "i int, record string")
    out = route(df, rules)
    assert out.columns == ["i", "rule", "destination", "checkpoint", "outbound"]
    assert sorted((r.i, r.rule, r.destination, r.checkpoint) for r in out.collect()) == [
        (0, "a", "one", True), (0, "b", "two", False), (1, "b", "two", False), (1, "c", "one", True),
        (2, "b", "two", False), (2, "c", "one", True)]
    parts = split_by_destination(out, rules)
    assert {k: v.count() for k, v in parts.items()} == {"one": 3, "two": 3}
    kept = split_by_destination(out, rules, str(tmp_path / "split"))
    assert {k: v.columns == out.columns and v.count() for k, v in kept.items()} == {"one": 3, "two": 3}


def test_registry_of_rules():
    rules = RuleSet([Rule("a", "x"), Rule("b", "x")])
    rules.add(Rule("a", "y")).remove("b").remove("unknown")
    assert [(r.name, r.destination) for r in rules] == [("a", "y")]


def test_empty_ruleset_and_nested_values(spark):
    df = spark.createDataFrame([(0, LEVELS[0])], "i int, record string")
    with pytest.raises(ValueError):
        route(df, RuleSet())
    out = sent(spark, [LEVELS[0]], lambda r: {"x": sprintf("<%v>", first_non_null(r.json("no"), concat("a", r.json("depth"))))},
               lambda r: eq(first_non_null(r.json("no"), r.json("flow")), 310))
    assert out == {0: '{"x":"<a7>"}'}


def test_record_is_parsed_once(spark):
    df = spark.createDataFrame([(0, LEVELS[0])], "i int, record string")
    rules = RuleSet([
        Rule(f"r{i}", "x", when=lambda r, i=i: all_of(gt(r.json("flow"), i), lt(r.json("depth"), i), ne(r.json("x"), i)),
             send=lambda r: {"a": r.json("flow"), "b": r.json("depth")})
        for i in range(5)
    ])
    plan = route(df, rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson(") == 1


def test_routing_without_state_has_no_shuffle_and_reads_what_it_needs(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/events.parquet").withColumnRenamed("props", "record")
    rules = RuleSet([Rule("a", "x", when=lambda r: gt(r.json("k"), 50), send=lambda r: {"k": r.json("k")})])
    plan = route(df, rules, keep=["event_id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "ReadSchema: struct<event_id:bigint,props:string>" in plan
    with pytest.raises(ValueError):
        route(df.withColumnRenamed("event_type", "rule"), rules)


def test_conditions_on_columns_reach_the_scan(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/events.parquet").withColumnRenamed("props", "record")
    big, error = F.col("value") > 100, F.col("event_type") == "error"
    rules = [Rule("big", "x", where=big, when=lambda r: gt(r.json("k"), 50)),
             Rule("error", "x", where=error, when=lambda r: eq(r.unique(r.json("k")), True), send=lambda r: {"p": r.fetch("k")}),
             Rule("keep", "x", where=error, cache=lambda r: {"k": r.json("k")})]
    plan = route(df, RuleSet(rules[:1]), keep=["event_id"])._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(value,100.0)" in plan
    out = route(df, RuleSet(rules), keep=["event_id"], order=["event_id"]).collect()
    rows = [(r.event_id, r.value, r.event_type, json.loads(r.record)["k"]) for r in df.orderBy("event_id").collect()]
    seen, last, expected = set(), None, set()
    for i, value, kind, k in rows:
        if value > 100 and k > 50:
            expected.add((i, "big", "{}"))
        if kind == "error":
            if k not in seen:
                expected.add((i, "error", '{"p":%s}' % ("null" if last is None else last)))
            seen.add(k)
            expected.add((i, "keep", "{}"))
        last = k
    assert {(r.event_id, r.rule, r.outbound) for r in out} == expected


def test_unique_and_cache_within_rules(spark):
    rows = [(i, json.dumps({"u": u, "t": t, "v": v})) for i, (u, t, v) in enumerate(
        [("a", "x", 1), ("a", "buy", 2), ("b", "buy", None), ("a", "buy", 4), ("b", "x", 5), ("b", "buy", 6)])]
    df = spark.createDataFrame(rows, "i int, record string")
    rules = RuleSet([
        Rule("first", "d", send=lambda r: {"u": r.json("u")},
             when=lambda r: eq(r.unique(r.json("u"), given=eq(r.json("t"), "buy")), True)),
        Rule("store", "d", when=lambda r: lt(r.json("v"), 0), cache=lambda r: {"v": r.json("v"), " ": r.json("t")}),
        Rule("read", "d", send=lambda r: {"now": r.fetch("v"), "none": r.fetch("unknown")}),
        Rule("before", "d", when=lambda r: eq(r.fetch("own"), "x"), send=lambda r: {"own": r.fetch("own")},
             cache=lambda r: {"own": r.json("t")}),
        Rule("late", "d", send=lambda r: {"v": r.fetch("w")}),
        Rule("writer", "d", when=lambda r: gt(r.json("v"), 99), cache=lambda r: {"w": r.json("v")}),
    ])
    out = route(df, rules, keep=["i"], order=["i"])
    got = {}
    for r in out.collect():
        got.setdefault(r.rule, {})[r.i] = r.outbound
    assert got["first"] == {1: '{"u":"a"}', 2: '{"u":"b"}'}
    assert got["read"] == {i: '{"none":null,"now":%s}' % ("null" if v is None else v)
                           for i, v in enumerate([1, 2, None, 4, 5, 6])}
    assert got["before"] == {1: '{"own":"buy"}', 5: '{"own":"buy"}'}
    assert got["late"] == {i: '{"v":%s}' % ("null" if v is None else v) for i, v in enumerate([None, 1, 2, None, 4, 5])}
    with pytest.raises(ValueError):
        route(df, rules)


def test_two_writers_of_one_alias(spark):
    df = spark.createDataFrame([(i, json.dumps({"v": i, "t": t})) for i, t in enumerate("abba")], "i int, record string")
    rules = RuleSet([
        Rule("a", "d", when=lambda r: eq(r.json("t"), "a"), cache=lambda r: {"k": r.json("v")}, cache_matching_only=True),
        Rule("b", "d", when=lambda r: eq(r.json("t"), "b"), cache=lambda r: {"k": concat("b", r.json("v"))},
             cache_matching_only=True, send=lambda r: {"k": r.fetch("k")}),
        Rule("c", "d", send=lambda r: {"k": r.fetch("k")}),
    ])
    out = route(df, rules, keep=["i"], order=["i"]).collect()
    assert {r.i: r.outbound for r in out if r.rule == "c"} == {0: '{"k":0}', 1: '{"k":"b1"}', 2: '{"k":"b2"}', 3: '{"k":3}'}
    assert {r.i: r.outbound for r in out if r.rule == "b"} == {1: '{"k":"b1"}', 2: '{"k":"b2"}'}


def test_ruleset_file(spark, tmp_path):
    path = tmp_path / "ruleset"
    path.write_text(json.dumps({"RuleName": "example", "RecordGenerator": "in", "RecordRules": [
        {"Rule": "b", "checkpoint": True}, {"Rule": "a"}]}, indent=2))
    rules = load_ruleset(spark, str(path), {"a": Rule("a", "x"), "b": Rule("b", "y", checkpoint=False)})
    assert (rules.name, rules.generator) == ("example", "in")
    assert [(r.name, r.destination, r.checkpoint) for r in rules] == [("b", "y", True), ("a", "x", False)]
    with pytest.raises(KeyError):
        load_ruleset(spark, str(path), {"a": Rule("a", "x")})


def test_random_and_time_ranges(spark):
    drawn = spark.range(2000).select(
        rand_("FLOAT32").alias("f"), rand_("UINT32").alias("u"), rand_().alias("w"), rand_("FLOAT64", 3).alias("d"),
        time_("H").alias("h"), time_().alias("ms"))
    row = drawn.agg(
        F.min("f").alias("lo"), F.max("f").alias("hi"), F.max("u").alias("u32"), F.max("w").alias("u64"),
        F.countDistinct("d").alias("n"), F.max("h").alias("h"), F.max("ms").alias("ms")).first()
    assert 0 <= row.lo < row.hi < 1 and 2**31 < row.u32 < 2**32 and 2**63 < row.u64 < 2**64
    assert row.n == 2000 and 0 <= row.h < 24 and row.ms > 1_700_000_000_000


def test_records_that_repeat_or_tie_come_out_once(spark):
    rows = [(0, 1, "pump"), (0, 1, "pump"), (0, 1, "valve"), (0, 2, "pump"), (0, None, "gate"), (0, None, "gate")]
    df = spark.createDataFrame([(s, o, json.dumps({"part": p})) for s, o, p in rows], "site int, o int, record string")
    rules = RuleSet([
        Rule("all", "x", send=lambda r: {"was": r.fetch("part"), "first": r.unique(r.json("part"))},
             cache=lambda r: {"last": r.json("part")}),
        Rule("prior", "x", when=lambda r: eq(r.json("part"), "pump"), send=lambda r: {"was": r.fetch("last")}),
        Rule("new", "x", when=lambda r: eq(r.unique(r.json("part")), True), send=lambda r: {"part": r.json("part")}),
    ])
    out = route(df, rules, scope=["site"], order=["o"]).collect()
    assert sorted(r.rule for r in out) == ["all"] * 6 + ["new"] * 3 + ["prior"] * 3
    assert sorted(r.outbound for r in out if r.rule == "new") == [f'{{"part":"{p}"}}' for p in ("gate", "pump", "valve")]
    assert sum('"first":"true"' in r.outbound for r in out) == 3


def test_rules_that_fail_leave_the_record_and_the_reason(spark):
    rows = ['{"crew":["Ida"],"t":"%v/%v"}', '{"crew":"Ida","t":"%v"}', '{"t":"%v%v%v"}', '{"crew":[]', None, "", "3"]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, record string")
    rules = RuleSet([
        Rule("crew", "x", when=lambda r: ne(r.json("t"), None), send=lambda r: {"who": join_("COMMA", r.json("crew"))}),
        Rule("shown", "x", when=lambda r: eq(sprintf(r.json("t"), 1, 2), "1/2")),
        Rule("all", "y", send=SEND_ALL),
        Rule("none", "y", where=F.col("i") < 0, when=lambda r: eq(join_("DOT", r.json("crew")), "")),
    ])
    matches, failed = split_errors(route(df, rules, errors=True))
    short = "t: more placeholders than values, or no template"
    assert {(r.i, r.rule, r.error) for r in failed.collect()} == {
        (1, "crew", "crew: no array"), (2, "crew", "crew: no array"), (2, "shown", short),
        *[(i, "shown", short) for i in (3, 4, 5, 6)], *[(i, None, "record: no JSON") for i in (3, 4, 5)]}
    assert {r.i: r.record for r in failed.collect()} == {i: rows[i] for i in range(1, 7)}
    plain = route(df, rules)
    assert matches.columns == plain.columns and sorted(map(str, matches.collect())) == sorted(map(str, plain.collect()))
    assert matches.count() == 9 and failed.where("rule = 'crew'").select("destination", "checkpoint").first() == ("x", True)
    assert route(df.withColumn("error", F.lit(1)), rules).columns[:2] == ["i", "error"]
    with pytest.raises(ValueError):
        route(df.withColumn("error", F.lit(1)), rules, errors=True)
    assert split_errors(route(df.where("false"), rules, errors=True))[1].collect() == []
