"""Rules and rulesets: plain Python objects that hold expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """One rule: which records match, what they send, and where to.

    ``when``, ``send`` and ``cache`` are expressions, or functions of the
    record (see :class:`weir.operators.route.Record`) that return them.

    * ``where``: a condition on plain columns that must hold as well. If every
      rule has one, records that no rule wants are not even parsed, and what
      the table format can test is tested by the scan.
    * ``when``: a condition; ``None`` matches everything.
    * ``send``: name → expression, a list, ``SEND_ALL``, or ``None`` for ``{}``.
    * ``cache``: alias → expression, written for every record, or only for
      matching ones with ``cache_matching_only``.
    * ``checkpoint``: a failing sink of this rule fails the micro-batch.
    """

    name: str
    destination: str
    when: Column | Callable | None = None
    send: object = None
    cache: Mapping | Callable | None = None
    cache_matching_only: bool = False
    checkpoint: bool = True
    where: Column | None = None
    params: Mapping[str, object] = field(default_factory=dict)


class RuleSet:
    """Rules in the order they were added; adding a known name replaces it."""

    def __init__(self, rules: Iterable[Rule] = (), name: str = "", generator: str = ""):
        self.name = name
        self.generator = generator
        self._rules: dict[str, Rule] = {}
        for rule in rules:
            self.add(rule)

    def add(self, rule: Rule) -> "RuleSet":
        self._rules[rule.name] = rule
        return self

    def remove(self, name: str) -> "RuleSet":
        self._rules.pop(name, None)
        return self

    def __iter__(self):
        return iter(self._rules.values())

    def __len__(self) -> int:
        return len(self._rules)

    def __getitem__(self, name: str) -> Rule:
        return self._rules[name]


RULESET_SCHEMA = (
    "RuleName string, RecordGenerator string, "
    "RecordRules array<struct<Rule: string, checkpoint: boolean>>"
)


def _exploded(rulesets: DataFrame) -> DataFrame:
    return rulesets.select(
        F.col("RuleName").alias("ruleset"),
        F.col("RecordGenerator").alias("generator"),
        F.posexplode("RecordRules").alias("position", "entry"),
    ).select("ruleset", "generator", "position", F.col("entry.Rule").alias("rule"),
             F.coalesce("entry.checkpoint", F.lit(False)).alias("checkpoint"))


def ruleset_table(rulesets: DataFrame, text: str = "ruleset") -> DataFrame:
    """Ruleset documents (one JSON text per row) as one row per rule."""
    return _exploded(rulesets.select(F.from_json(text, RULESET_SCHEMA).alias("r")).select("r.*"))


def read_rulesets(spark: SparkSession, path: str) -> DataFrame:
    """Ruleset files as one row per rule."""
    return _exploded(spark.read.schema(RULESET_SCHEMA).json(path, multiLine=True))


def load_ruleset(spark: SparkSession, path: str, rules: Mapping[str, Rule]) -> RuleSet:
    """The ruleset of a file, made of the given rules by name.

    Rules the file names but nobody defined are an error; the file's
    checkpoint flag replaces that of the rule.
    """
    rows = sorted(read_rulesets(spark, path).collect(), key=lambda r: r.position)
    if not rows:
        raise ValueError(f"{path}: a ruleset needs at least one rule")
    missing = [r.rule for r in rows if r.rule not in rules]
    if missing:
        raise KeyError(f"{path}: undefined rules {missing}")
    out = RuleSet(name=rows[0].ruleset, generator=rows[0].generator)
    for row in rows:
        rule = rules[row.rule]
        out.add(Rule(**{**rule.__dict__, "name": row.rule, "checkpoint": row.checkpoint}))
    return out
