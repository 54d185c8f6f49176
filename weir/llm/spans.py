"""Matches of patterns with their places, by Spark functions only.

Java's regular expressions recurse on repeated groups, and restart at every position of a long run. The patterns used
with these functions therefore repeat character classes only, and start at the beginning of a run or where the last
match ended (``\\G``), so very long texts cost linear time and no stack.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPANS = "array<struct<start:int,end:int,kind:int,match:string>>"


def run_start(characters: str) -> str:
    """Matches only at the beginning of a run of the characters, or where the last match ended."""
    return rf"(?:\G|(?<![{characters}]))"


def find(text: Column, pattern: str, kind: int) -> Column:
    """Leftmost non-overlapping matches as an array of ``start, end, kind, match``; places are code points, end exclusive."""
    parts = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                       lambda gap, match: F.struct(F.length(gap).alias("gap"), match.alias("match")))
    return F.aggregate(
        F.filter(parts, lambda p: p["match"].isNotNull()),
        F.struct(F.lit(0).alias("at"), none().alias("found")),
        lambda acc, p: F.struct(
            (acc["at"] + p["gap"] + F.length(p["match"])).alias("at"),
            F.array_append(acc["found"], F.struct(
                (acc["at"] + p["gap"]).alias("start"), (acc["at"] + p["gap"] + F.length(p["match"])).alias("end"),
                F.lit(kind).alias("kind"), p["match"].alias("match"))).alias("found")),
        lambda acc: acc["found"])


def none() -> Column:
    return F.array().cast(SPANS)


def when_any(condition: Column, spans: Column) -> Column:
    """The spans where the condition, a cheap test of the text, holds; none elsewhere."""
    return F.when(condition, spans).otherwise(none())


def apart(spans: Column, others: Column) -> Column:
    """The spans that overlap none of the others."""
    return F.filter(spans, lambda s: ~F.exists(others, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"])))


def count_of(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def listed(spans: Column, kinds: list[str]) -> Column:
    """``kind:start:end`` by start, then kind as listed, joined by commas."""
    names = F.array(*map(F.lit, kinds))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
