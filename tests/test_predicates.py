import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weir import Rule, RuleSet, all_of, any_of, basename, eq, ge, getdir, gt, le, lt, ne, route

EDGE = [
    '{"a": 42}', '{"a": 42.0}', '{"a": "42"}', '{"a": "42d"}', '{"a": true}', '{"a": "true"}', '{"a": null}', "{}",
    '{"a": "null"}', '{"a": ""}', '{"a": " 42 "}', '{"a": "nan"}', '{"a": "-inf"}', '{"a": "1e3"}', '{"a": [1]}',
    '{"a": {"b": 1}}', '{"a": 9007199254740993}', "not json", "",
]


def matched(spark, rows, when):
    df = spark.createDataFrame(list(enumerate(rows)), "i int, record string")
    out = route(df, RuleSet([Rule("r", "debug", when=lambda r: when(r.json("a")))]), keep=["i"])
    return {rows[r.i] for r in out.collect()}


def test_equality_is_typed(spark):
    assert matched(spark, EDGE, lambda a: eq(a, 42)) == {'{"a": 42}', '{"a": 42.0}', '{"a": "42"}'}
    assert matched(spark, EDGE, lambda a: eq(a, "42.00")) == {'{"a": 42}', '{"a": 42.0}', '{"a": "42"}'}
    assert matched(spark, EDGE, lambda a: eq(a, True)) == {'{"a": true}', '{"a": "true"}'}
    assert matched(spark, EDGE, lambda a: eq(a, "42d")) == {'{"a": "42d"}'}


def test_absence(spark):
    absent = {'{"a": null}', "{}", "not json", ""}
    assert matched(spark, EDGE, lambda a: eq(a, None)) == absent
    assert matched(spark, EDGE, lambda a: eq(a, "null")) == absent
    assert matched(spark, EDGE, lambda a: ne(a, None)) == set(EDGE) - absent
    # What is absent differs from every literal.
    assert absent <= matched(spark, EDGE, lambda a: ne(a, "x"))


def test_integers_beyond_double_precision_stay_apart(spark):
    rows = ['{"a": 9007199254740993}', '{"a": 9007199254740992}']
    assert matched(spark, rows, lambda a: eq(a, 9007199254740993)) == {rows[0]}


def test_ordering_takes_what_is_no_number_as_zero(spark):
    positive = {'{"a": 42}', '{"a": 42.0}', '{"a": "42"}', '{"a": " 42 "}', '{"a": "1e3"}', '{"a": 9007199254740993}'}
    assert matched(spark, EDGE, lambda a: gt(a, 0)) == positive
    assert matched(spark, EDGE, lambda a: lt(a, 0)) == {'{"a": "-inf"}'}
    zero = set(EDGE) - positive - {'{"a": "-inf"}', '{"a": "nan"}'}
    assert matched(spark, EDGE, lambda a: le(a, "x")) == zero | {'{"a": "-inf"}'}
    assert matched(spark, EDGE, lambda a: ge(a, 0)) == zero | positive


@pytest.mark.parametrize("compare", [lt, le, gt, ge])
def test_nan_is_never_ordered(spark, compare):
    rows = ['{"a": "NaN"}', '{"a": 1}']
    assert '{"a": "NaN"}' not in matched(spark, rows, lambda a: compare(a, 1))
    assert matched(spark, rows, lambda a: compare(a, "nan")) == set()
    assert '{"a": "NaN"}' not in matched(spark, rows, lambda a: compare(a, a))


@pytest.mark.parametrize("left", [-7, 0, 3.5, "12", "-0.25"])
@pytest.mark.parametrize("right", [-8, 3.5, "11.5", "100"])
def test_ge_on_plain_columns(spark, left, right):
    assert spark.range(1).select(ge(F.lit(left), right).alias("x")).first().x is (float(left) >= float(right))


def test_unusual_number_spellings(spark):
    texts = {"1d": 0.0, "1F": 0.0, "inf": float("inf"), "+Infinity": float("inf"), "0x1p3": 8.0, ".5": 0.5,
             "5.": 5.0, "1_0": 0.0, "\u00a07\u2003": 7.0, "\t7\n": 7.0, "1e999": float("inf"), "0xfp1": 30.0, "f": 0.0}
    df = spark.createDataFrame([(t, float(v)) for t, v in texts.items()], "a string, v double")
    wrong = df.where(~(ge(F.col("a"), F.col("v")) & le(F.col("a"), F.col("v"))))
    assert wrong.collect() == []


@given(st.lists(st.tuples(st.booleans(), st.booleans(), st.booleans()), min_size=1, max_size=8))
@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_lines_are_anded_and_alternatives_ored(spark, rows):
    df = spark.createDataFrame(
        [(i, json.dumps(dict(zip("abc", row)))) for i, row in enumerate(rows)], "i int, record string")

    def when(r):
        return all_of(any_of(eq(r.json("a"), True), eq(r.json("b"), True)), eq(r.json("c"), True))

    out = route(df, RuleSet([Rule("r", "debug", when=when)]), keep=["i"])
    assert {r.i for r in out.collect()} == {i for i, (a, b, c) in enumerate(rows) if (a or b) and c}


@given(st.lists(st.text(alphabet="ab/\\\\.é\"", max_size=8), min_size=1, max_size=10))
@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_path_functions(spark, paths):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "i int, p string")
    out = df.select("i", *[f(F.col("p"), s).alias(f.__name__ + s) for f in (basename, getdir) for s in ("", "WINDOWS")])
    for row in out.collect():
        for style, sep in (("", "/"), ("WINDOWS", "\\")):
            head, found, tail = paths[row.i].rpartition(sep)
            assert row["basename" + style] == tail
            assert row["getdir" + style] == (head if found else "")
