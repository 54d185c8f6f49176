"""Thousands of rules over records: their tests are an index the records are joined with.

``route`` evaluates every rule on every record, so its plan and its work grow with the rules. Rules whose tests compare a
path with a fixed value can be listed as data instead. Each rule is entered in the index by one of its lines, the one that
is likely to hold least often; a record looks its own values up there and only the rules found are evaluated in full.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import predicates
from ..functions.predicates import all_of, any_of, exact_literal
from ..functions.values import Json, Views, literal_number, parse
from ..plans.rules import Rule
from .project import SEND_ALL

_COMPARE = {"==": predicates.eq, "!=": predicates.ne, "<": predicates.lt, "<=": predicates.le,
            ">": predicates.gt, ">=": predicates.ge}
# Text equality alone: what a lookup by number has to leave to the lookup by text.
_SPELLED = "is"

_TEST = "struct<slot: int, op: string, text: string, number: double>"
_VALUES = "array<struct<text: string, exact: double, number: double>>"
_ENTRY = f"slot int, kind string, text string, node double, bound long, at int, before array<{_TEST}>"
_KEY = ["slot", "kind", "text", "node", "bound"]
_LISTED = (f"at int, rule string, destination string, checkpoint boolean, lines array<array<{_TEST}>>, whole boolean, "
           "fields array<struct<name: string, slot: int>>")
# Up to these bytes, counted on the driver that holds the rules anyway, the index goes to every executor.
BROADCAST_BYTES = 32 << 20
# A value that more rules than this ask for is looked up together with their thresholds.
SHARED_RULES = 4


@dataclass(frozen=True)
class ListedRule:
    """A rule as data.

    * ``lines``: each a sequence of alternatives ``(path, operator, value)``, operators ``== != < <= > >=``. Every line
      must hold, and a line holds if one of its alternatives does; no lines match everything. A ``!=`` or a test for an
      absent value is rarely of use to the index: a rule that has nothing else is evaluated for every record.
    * ``send``: name → path, ``SEND_ALL``, or ``None`` for ``{}``.
    """

    name: str
    destination: str
    lines: Sequence[Sequence[tuple[str, str, object]]] = ()
    send: object = None
    checkpoint: bool = True

    def as_rule(self) -> Rule:
        """The same rule for ``route`` and ``publish``."""
        def when(r):
            return all_of(*[any_of(*[_COMPARE[op](r.json(p), v) for p, op, v in line]) for line in self.lines])

        def send(r):
            return {n: r.json(p) for n, p in self.send.items()} if isinstance(self.send, Mapping) else self.send

        return Rule(self.name, self.destination, when=when, send=send, checkpoint=self.checkpoint)


class _Index:
    """The rules' tests by what a record looks up."""

    def __init__(self, rules: list[ListedRule]):
        self.slots: dict[str, int] = {}
        self.sent: dict[str, int] = {}
        self.cuts: dict[int, list[float]] = {}
        self.kinds: dict[int, set[str]] = defaultdict(set)
        self.listed: list[tuple] = []
        self.entries: list[tuple] = []
        self.whole = any(rule.send is SEND_ALL for rule in rules)
        lines = [[self._line(line) for line in rule.lines] for rule in rules]
        used = Counter((t[0], t[1] == "==") for t in {t for rule in lines for line in rule for t in line})
        chosen = [min([*((line, False) for line in rule), *((band, True) for band in _bands(rule))],
                      key=lambda way: _rank(*way, used), default=(None, False)) for rule in lines]
        bounds = [_bound(rule, *way) for rule, way in zip(lines, chosen)]
        asked = Counter((t[0], t[2], bound[0][0]) for (line, _), bound in zip(chosen, bounds) if bound for t in line)
        shared = {(slot, by) for (slot, _, by), n in asked.items() if n > SHARED_RULES}
        bounds = [bound if bound and any((t[0], bound[0][0]) in shared for t in line) else []
                  for (line, _), bound in zip(chosen, bounds)]
        for slot, op, _, number in (t for (line, _), bound in zip(chosen, bounds) for t in [*(line or ()), *bound]):
            if number is not None and op in ("<", "<=", ">", ">="):
                self.cuts.setdefault(slot, []).append(number)
        self.cuts = {slot: sorted(set(cuts)) for slot, cuts in self.cuts.items()}
        for at, (rule, tests, way, bound) in enumerate(zip(rules, lines, chosen, bounds)):
            fields = rule.send if isinstance(rule.send, Mapping) else {}
            if not isinstance(rule.send, Mapping) and rule.send is not None and rule.send is not SEND_ALL:
                raise ValueError(f"rule {rule.name}: send is name → path, SEND_ALL or None")
            self.listed.append((at, rule.name, rule.destination, rule.checkpoint, tests, rule.send is SEND_ALL,
                                [(n, self.sent.setdefault(fields[n], len(self.sent))) for n in sorted(fields)]))
            self._enter(at, *way, bound, shared)

    def _line(self, line) -> list[tuple]:
        if not line:
            raise ValueError("a line needs at least one alternative")
        tests = []
        for path, op, value in line:
            if op not in _COMPARE:
                raise ValueError(f"no operator {op!r}, choose one of {sorted(_COMPARE)}")
            slot = self.slots.setdefault(path, len(self.slots))
            if op in ("==", "!="):
                absent = value is None or value == "null"
                text = None if absent else str(value).lower() if isinstance(value, bool) else str(value)
                number = None if absent else exact_literal(value)
                tests.append((slot, op, text, None if number is None or math.isnan(number) else number))
            else:
                # A threshold that is not a number orders nothing.
                number = literal_number(value)
                tests.append((slot, op, None, None if math.isnan(number) else number))
        # An alternative that never holds adds nothing, unless the line has no other.
        return [t for t in dict.fromkeys(tests) if t[1] in ("==", "!=") or t[3] is not None] or tests[:1]

    def _enter(self, at: int, line, together: bool, bound: list[tuple], shared: set[tuple[int, int]]) -> None:
        if line is None or any(op == "!=" for _, op, _, _ in line):
            self.kinds[-1].add("any")
            self.entries.append((-1, "any", "", 0.0, 0, at, []))
            return
        if together:
            slot = line[0][0]
            self.kinds[slot].add("range")
            for node in self._within(line):
                self.entries.append((slot, "range", "", float(node), 0, at, []))
            return
        for i, (slot, op, text, number) in enumerate(line):
            bounded = bool(bound) and (slot, bound[0][0]) in shared

            def enter(kind, text="", node=0.0, also=()):
                kind = f"{kind} {bound[0][0]}" if bounded else kind
                self.kinds[slot].add(kind)
                for within in self._within(bound) if bounded else [0]:
                    self.entries.append((slot, kind, text, node, within, at, [*line[:i], *also]))

            if op == "==":
                enter("absent") if text is None else enter("text", text)
                if number is not None:
                    enter("number", "", number + 0.0, [(slot, _SPELLED, text, None)])
            elif number is not None:
                for node in self._nodes(slot, *self._span(slot, op, number)):
                    enter("range", "", float(node))

    def leaves(self, slot: int) -> int:
        """Places of a tree over the cuts of a path: below, at and between them."""
        return 1 << (2 * len(self.cuts[slot])).bit_length()

    def _span(self, slot: int, op: str, number: float) -> tuple[int, int]:
        """The places where a test holds, the end excluded."""
        at, size = 2 * bisect_left(self.cuts[slot], number) + 1, self.leaves(slot)
        return {">": (at + 1, size), ">=": (at, size), "<": (0, at), "<=": (0, at + 1)}[op]

    def _within(self, tests: list[tuple]) -> list[int]:
        """The nodes for thresholds of one path that must all hold."""
        spans = [self._span(slot, op, number) for slot, op, _, number in tests]
        return self._nodes(tests[0][0], max(s[0] for s in spans), min(s[1] for s in spans))

    def _nodes(self, slot: int, low: int, high: int) -> list[int]:
        """The few nodes that together cover these places, none twice."""
        size = self.leaves(slot)
        low, high, found = low + size, high + size, []
        while low < high:
            if low & 1:
                found.append(low)
                low += 1
            if high & 1:
                high -= 1
                found.append(high)
            low, high = low >> 1, high >> 1
        return found

    def size(self) -> int:
        """Bytes of both tables, from above."""
        def tests(some) -> int:
            return sum(40 + 4 * len(t[2] or "") for t in some)

        listed = sum(120 + 4 * (len(r[1]) + len(r[2])) + sum(16 + tests(line) for line in r[4])
                     + sum(40 + 4 * len(f[0]) for f in r[6]) for r in self.listed)
        return listed + sum(88 + 4 * len(e[2]) + tests(e[6]) for e in self.entries)


def _bands(lines: list[list[tuple]]) -> list[list[tuple]]:
    """Thresholds of one path from below and from above that must all hold."""
    alone = defaultdict(list)
    for line in lines:
        if len(line) == 1 and line[0][1] not in ("==", "!=") and line[0][3] is not None:
            alone[line[0][0]].append(line[0])
    return [tests for tests in alone.values() if len({op[0] for _, op, _, _ in tests}) == 2]


def _bound(lines: list[list[tuple]], line, together: bool) -> list[tuple]:
    """For a rule looked up by equalities: thresholds of one path that must all hold as well, a band if there is one."""
    if together or not line or any(op != "==" for _, op, _, _ in line):
        return []
    alone = [t for t in lines if len(t) == 1 and t[0][1] not in ("==", "!=") and t[0][3] is not None]
    return next(iter([*_bands(lines), *alone]), [])


def _rank(line: list[tuple], together: bool, used: Counter) -> tuple:
    """Less is better to look a rule up by: equality, then bands, thresholds, absence; paths with many values first."""
    kinds = {"==": 0, "!=": 3}
    cost = 0.5 if together else max(2 if op == "==" and text is None else kinds.get(op, 1) for _, op, text, _ in line)
    return cost, -min(used[slot, op == "=="] for slot, op, _, _ in line), len(line)


def _below(cuts: list[float], value: Column) -> tuple[Column, Column]:
    """How many cuts lie below ``value``, and whether it is one: a binary search over one literal."""
    table = F.split(F.lit(",".join(map(repr, cuts))), ",").cast("array<double>")
    steps = [1 << i for i in reversed(range(len(cuts).bit_length()))]

    def step(pos: Column, width: Column) -> Column:
        there = pos + width
        return F.when((there <= len(cuts)) & (F.get(table, there - 1) < value), there).otherwise(pos)

    below = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step)
    return below, F.coalesce(F.get(table, below) == value, F.lit(False))


def _keys(index: _Index, value) -> tuple[list[tuple[str, Column]], list[Column]]:
    """Per path with thresholds a leaf, by name; and all keys a record looks up. One with a null in it finds nothing."""
    def key(slot: int, kind: str, text=None, node=None, bound=None) -> Column:
        return F.struct(F.lit(slot).alias("slot"), F.lit(kind).alias("kind"),
                        (F.lit("") if text is None else text).alias("text"),
                        (F.lit(0.0) if node is None else node).cast("double").alias("node"),
                        (F.lit(0) if bound is None else bound).cast("long").alias("bound"))

    def upward(slot: int) -> list[Column]:
        return [F.shiftright(f"__leaf{slot}", k) for k in range(index.leaves(slot).bit_length())]

    leaves, keys = [], []
    climbed = {int(kind.partition(" ")[2] or slot) for slot, kinds in index.kinds.items() for kind in kinds if kind == "range" or " " in kind}
    for slot in sorted(climbed):
        number = value(slot)["number"]
        below, met = _below(index.cuts[slot], number)
        leaf = F.lit(index.leaves(slot)) + 2 * below + met.cast("int")
        # A value that is in no order has no leaf.
        leaves.append((f"__leaf{slot}", F.when(number.isNotNull(), leaf)))
    for slot, kinds in sorted(index.kinds.items()):
        for kind in sorted(kinds):
            what, _, by = kind.partition(" ")
            parts = {}
            if what == "range":
                keys += [key(slot, kind, node=node) for node in upward(slot)]
                continue
            if what == "text":
                parts = {"text": value(slot)["text"]}
            elif what == "absent":
                parts = {"text": F.when(value(slot)["text"].isNull(), "")}
            elif what == "number":
                # Minus zero is found as zero.
                parts = {"node": value(slot)["exact"] + F.lit(0.0)}
            keys += [key(slot, kind, **parts, bound=bound) for bound in (upward(int(by)) if by else [None])]
    return leaves, keys or [key(-1, "any")]


def _holds(test: Column, values: Column) -> Column:
    value = F.get(values, test["slot"])
    spelled = value["text"].eqNullSafe(test["text"])
    same = spelled | F.coalesce(value["exact"] == test["number"], F.lit(False))
    found, limit, op = value["number"], test["number"], test["op"]
    ordered = (F.when(op == "<", found < limit).when(op == "<=", found <= limit)
               .when(op == ">", found > limit).when(op == ">=", found >= limit))
    return (F.when(op == "==", same).when(op == "!=", ~same).when(op == _SPELLED, spelled)
            .otherwise(F.coalesce(ordered, F.lit(False))))


def _where(df: DataFrame, holds: Column) -> DataFrame:
    # A filter whose lambda reads a column of the other side of a join is wrongly pushed below that join by Spark; an
    # explode of one element is not.
    return df.select(*df.columns, F.explode(F.when(holds, F.array(F.lit(True)))).alias("__held")).drop("__held")


def fan_out(df: DataFrame, rules: Iterable[ListedRule], *, record: str = "record",
            keep: Sequence[str] | None = None) -> DataFrame:
    """Every record through thousands of listed rules; the rows ``route`` gives for the same rules.

    The plan grows with the paths the rules name, not with the rules. A record costs a lookup per path and
    log2(thresholds of the path) more, then the evaluation of the rules found. An equality is found by its text or number, a
    threshold by the nodes of a tree over all thresholds of the path that cover its side, each value lying below one of
    them at most, so no rule is found twice and nothing has to be made distinct. Where many rules ask for one value and have
    thresholds of another path beside it, they are found by value and node together. The index is broadcast while it is below
    ``BROADCAST_BYTES``, counted beforehand; a larger one is joined by a shuffle. Records that are no JSON have no values:
    rules that test for absence match them. Rows that repeat come out as often. Works on streams.
    """
    rules = list({rule.name: rule for rule in rules}.values())
    if not rules:
        raise ValueError("give at least one rule")
    keep = [c for c in df.columns if c != record] if keep is None else list(keep)
    taken = sorted({"rule", "destination", "checkpoint", "outbound"} & set(keep))
    if taken:
        raise ValueError(f"choose other columns to keep: {taken} are made by the routing")
    index = _Index(rules)
    spark = df.sparkSession
    entries, listed = spark.createDataFrame(index.entries, _ENTRY), spark.createDataFrame(index.listed, _LISTED)
    if index.size() <= BROADCAST_BYTES:
        entries, listed = F.broadcast(entries), F.broadcast(listed)

    views = Views()

    def value(path: str) -> Column:
        found = Json(F.col("__doc"), path, views=views)
        return F.struct(found.text.alias("text"), found.exact_number.alias("exact"), found.number.alias("number"))

    for path in index.slots:
        value(path)
    views.share()
    # Kept columns go by names of their own, so that none clashes with the index.
    kept = [f"__keep{i}" for i in range(len(keep))]
    rows = df.select(*[F.col(c).alias(n) for c, n in zip(keep, kept)], parse(record).alias("__doc"),
                     *([F.col(record).alias("__text")] if index.whole else []))
    rows = views.project(rows)
    values = [value(path) for path in index.slots]
    leaves, keys = _keys(index, lambda slot: F.get("__values", F.lit(slot)))
    rows = rows.withColumn("__values", F.array(*values) if values else F.array().cast(_VALUES)).withColumns(dict(leaves))
    carried = [*kept, "__doc", "__values", *(["__text"] if index.whole else [])]
    rows = rows.select(*carried, F.explode(F.array(*keys)).alias("__key")).select(*carried, "__key.*")

    def held(test: Column) -> Column:
        return _holds(test, F.col("__values"))

    found = _where(rows.join(entries, _KEY), ~F.exists("before", held)).select(*carried, "at")
    found = _where(found.join(listed, "at"), F.forall("lines", lambda line: F.exists(line, held)))
    body = F.lit("{}")
    if index.sent:
        sent = F.array(*[Json(F.col("__doc"), path).value for path in index.sent])
        entry = F.transform("fields", lambda f: F.struct(f["name"].alias("key"), F.get(F.col("__sent"), f["slot"]).alias("value")))
        found = found.withColumn("__sent", sent)
        body = F.when(F.size("fields") > 0, F.to_json(F.map_from_entries(entry), {"ignoreNullFields": "false"})).otherwise("{}")
    if index.whole:
        body = F.when(F.col("whole"), F.col("__text")).otherwise(body)
    return found.select(*[F.col(n).alias(c) for c, n in zip(keep, kept)], "rule", "destination", "checkpoint",
                        body.alias("outbound"))
