"""Running a ruleset over records: one scan, one parse, every rule."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import Json, Views, as_text, as_variant, parse
from ..plans.carry import carry_last, last_written
from ..plans.rules import Rule, RuleSet
from .project import outbound
from .unique import copy_number, first_rows, with_row_key


class _State:
    """What the rules ask for beyond the single record."""

    def __init__(self, rules: list[Rule]):
        self.rules = rules
        self.uniques: list[tuple[str, list[Column], Column | None]] = []
        self.prior: dict[str, str] = {}
        self.writes: dict[str, list[tuple[int, Column, bool]]] = {}

    def ask_unique(self, keys, given) -> Column:
        name = f"__first{len(self.uniques)}"
        self.uniques.append((name, keys, given))
        return F.coalesce(F.col(name), F.lit("false"))

    def ask_prior(self, alias: str) -> Column:
        name = self.prior.setdefault(alias, f"__prior{len(self.prior)}")
        return F.col(name)


class Record:
    """What a rule's expressions see: the record, the cache, the seen keys."""

    def __init__(self, record: str, views: Views, state: _State, position: int, phase: str):
        self._record = record
        self._views = views
        self._state = state
        self._position = position
        self._phase = phase
        self.guards: list[tuple[Column, str]] = []

    def _guard(self, condition: Column, reason: str) -> None:
        self.guards.append((F.coalesce(condition, F.lit(False)), reason))

    @property
    def text(self) -> Column:
        """The whole record."""
        return F.col(self._record)

    def json(self, path: str) -> Json:
        """The value at a dotted path."""
        return Json(F.col("__doc"), path, views=self._views, require=self._guard)

    def unique(self, *keys, given: Column | None = None) -> Column:
        """``"true"`` the first time the keys occur, else ``"false"``.

        ``given`` is what must hold for a record to reach the test at all, as
        predicate lines before it do.
        """
        if self._phase == "cache":
            raise ValueError("a cached value cannot depend on a first-seen test")
        given = _both(self._state.rules[self._position].where, given)
        return self._state.ask_unique([as_text(k) for k in keys], given)

    def fetch(self, alias: str) -> Json:
        """The value last cached under ``alias``; absent if there is none.

        A predicate sees the cache before its own rule's write, a projection
        after it. Writes of earlier rules to the same record are visible.
        """
        if self._phase == "cache":
            raise ValueError("a cached value cannot depend on the cache")
        writes = self._state.writes.get(alias)
        if not writes:
            return Json(F.lit(None).cast("variant"), key=f"cache.{alias}", require=self._guard)
        last = self._position if self._phase == "send" else self._position - 1
        found, settled = [], False
        for position, write, always in reversed(writes):
            if position <= last and not settled:
                found.append(write)
                settled = always
        if not settled:
            found.append(self._state.ask_prior(alias))
        return Json(F.coalesce(*found)["v"], key=f"cache.{alias}", require=self._guard)


def _both(one: Column | None, other: Column | None) -> Column | None:
    if one is None or other is None:
        return other if one is None else one
    return one & other


def _call(part, record: Record):
    return part(record) if callable(part) and not isinstance(part, Column) else part


class _Bound:
    """A ruleset as columns, for one round of binding."""

    def __init__(self, rules: list[Rule], record: str, views: Views):
        self.state = _State(rules)
        self.matches: list[Column] = []
        self.sends: list[Column] = []
        self.errors: list[Column | None] = []

        def seen(i: int, phase: str) -> Record:
            return Record(record, views, self.state, i, phase)

        for i, rule in enumerate(rules):
            for alias, value in (_call(rule.cache, seen(i, "cache")) or {}).items():
                if not alias.strip():
                    continue
                write = F.struct(as_variant(value).alias("v"))
                condition = None
                if rule.cache_matching_only:
                    condition = _both(rule.where, _call(rule.when, seen(i, "cache")))
                    write = write if condition is None else F.when(condition, write)
                always = condition is None
                self.state.writes.setdefault(alias, []).append((i, write, always))
        for i, rule in enumerate(rules):
            tested, sent = seen(i, "when"), seen(i, "send")
            condition = _both(rule.where, _call(rule.when, tested))
            body = outbound(_call(rule.send, sent), record)
            holds = F.lit(True) if condition is None else condition
            match = reduce(operator.and_, [guard for guard, _ in [*tested.guards, *sent.guards]], holds)
            self.matches.append(match)
            self.sends.append(body)
            # A test that fails has no outcome, so the rule fails; what is sent is made for matches only.
            in_scope = F.lit(True) if rule.where is None else rule.where
            failures = [(in_scope & ~g, reason) for g, reason in tested.guards] + [(holds & ~g, reason) for g, reason in sent.guards]
            error = None
            for failed, reason in failures:
                error = F.when(failed, F.lit(reason)) if error is None else error.when(failed, F.lit(reason))
            self.errors.append(error)


def _wanted(rules: list[Rule]) -> Column:
    """What plain columns must hold for any rule to match."""
    conditions = [rule.where for rule in rules]
    return F.lit(True) if any(c is None for c in conditions) else reduce(operator.or_, conditions)


def _with_state(df: DataFrame, bound: _Bound, views: Views, record: str, scope, order, memory) -> DataFrame:
    """Add first-seen flags and cached values to the records. Every record comes out once, whatever ties in its order."""
    state = bound.state
    wanted = _wanted(state.rules)
    if not state.uniques and not state.prior:
        return df.where(wanted)
    if df.isStreaming:
        raise ValueError("first-seen tests and caches of a stream need weir.run_router")
    if not order:
        raise ValueError("rules that keep state need the order of the records")

    # State comes from all records, but only those some rule wants take their text along.
    df = with_row_key(df, order).withColumn("__wanted", F.coalesce(wanted, F.lit(False)))

    def parsed(rows: DataFrame) -> DataFrame:
        return views.project(rows.withColumn("__doc", parse(record)))

    if state.prior:
        written = {}
        for alias, name in state.prior.items():
            latest = [w for _, w, _ in reversed(state.writes[alias])]
            written[f"__w{name}"] = F.coalesce(*latest)
    scopes = [f"__in{i}" for i in range(len(scope))]
    firsts_of = []
    for name, keys, given in state.uniques:
        firsts, key_names = first_rows(parsed(df), keys, given)
        if memory is not None:
            firsts = memory.first_seen(name, firsts, key_names)
        firsts_of.append(firsts.select("__at", F.lit(True).alias(name)))

    if state.prior:
        columns = df.columns
        df = parsed(df).select(
            *columns, *[F.col(s).alias(n) for s, n in zip(scope, scopes)], *[v.alias(n) for n, v in written.items()],
            F.lit(True).alias("__record"))
        if memory is not None:
            narrow = df.select("__at", *scopes, *written)
            # What was cached before this micro-batch enters as rows without an order. Only its scopes are read and rewritten.
            cached, store = memory.cached(narrow, scopes, list(written))
            store.put(narrow.unionByName(cached, allowMissingColumns=True).groupBy(*scopes).agg(
                *[last_written(n, ["__at"]).alias(n) for n in written]))
            df = df.unionByName(cached, allowMissingColumns=True)
        df = df.withColumn(record, F.when(F.col("__wanted"), F.col(record)))
        # Running values are windows over the records themselves: rows that tie are neither lost nor multiplied.
        at = [F.col("__at")[f] for f in df.schema["__at"].dataType.names]
        df = carry_last(df, {n: F.col(f"__w{n}") for n in state.prior.values()}, at, scope=scopes,
                        include_current=False).where("__record").drop(*scopes, *written, "__record")
    df = df.where("__wanted")
    for firsts in firsts_of:
        df = df.join(firsts, "__at", "left")
    if firsts_of:
        df = df.withColumn("__copy", copy_number())
        first = F.col("__copy") == 1
        df = df.withColumns({n: F.when(first & F.col(n), "true") for n, _, _ in state.uniques})
    return df


def route(df: DataFrame, ruleset: RuleSet, *, record: str = "record", keep: Sequence[str] | None = None,
          scope: Sequence[str] = (), order: Sequence[Column | str] = (), memory=None, errors: bool = False) -> DataFrame:
    """Every record through every rule; one output row per match.

    Returns ``keep`` (default: all columns but the record) and ``rule``,
    ``destination``, ``checkpoint``, ``outbound``. ``order`` and ``scope`` are
    needed only by rules that keep state: records that tie in ``order`` follow a
    hash of the row; ``scope`` is what the cache is kept per. ``memory`` is the state
    earlier micro-batches left (see :mod:`weir.streaming.memory`).

    With ``errors`` the same pass also yields a row, with the reason in ``error`` and the record in ``outbound``, for every
    rule that fails for a record, as ``join_`` does over a value that is no array, and for every record that is no JSON or
    NULL, with a NULL rule; see :func:`split_errors`. Matches are the same either way, and have a NULL ``error``.
    """
    rules = list(ruleset)
    if not rules:
        raise ValueError("a ruleset needs at least one rule")
    keep = [c for c in df.columns if c != record] if keep is None else list(keep)
    taken = sorted({"rule", "destination", "checkpoint", "outbound"} & set(keep) | {"error"} & set(keep if errors else ()))
    if taken:
        raise ValueError(f"choose other columns to keep: {taken} are made by the routing")
    views = Views()
    _Bound(rules, record, views)
    views.share()
    bound = _Bound(rules, record, views)

    df = _with_state(df, bound, views, record, scope, order, memory)
    df = views.project(df.withColumn("__doc", parse(record)))
    # One column per rule below the explode: each is computed only where its
    # predicate holds, and the record is parsed once for all of them.
    def hit(rule: Rule | None, body: Column, error: Column | None = None) -> Column:
        name, destination, checkpoint = (None, None, None) if rule is None else (rule.name, rule.destination, rule.checkpoint)
        fields = [F.lit(name).cast("string").alias("rule"), F.lit(destination).cast("string").alias("destination"),
                  F.lit(checkpoint).cast("boolean").alias("checkpoint"), body.alias("outbound")]
        if errors:
            fields.append((F.lit(None) if error is None else error).cast("string").alias("error"))
        return F.struct(*fields)

    hits = {}
    for i, (rule, match, body, error) in enumerate(zip(rules, bound.matches, bound.sends, bound.errors)):
        hits[f"__hit{i}"] = F.when(match, hit(rule, body))
        if errors and error is not None:
            hits[f"__hit{i}"] = hits[f"__hit{i}"].when(error.isNotNull(), hit(rule, F.col(record), error))
    if errors:
        hits["__hit"] = F.when(F.col("__doc").isNull(), hit(None, F.col(record), F.lit("record: no JSON")))
    df = df.select(*keep, *[c.alias(n) for n, c in hits.items()])
    found = F.array_compact(F.array(*hits))
    return df.select(*keep, F.explode(found).alias("__found")).select(*keep, "__found.*")


def split_errors(routed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What ``route`` gave with ``errors``, as its matches and as the errors with the ``record`` of each."""
    failed = F.col("error").isNotNull()
    return routed.where(~failed).drop("error"), routed.where(failed).withColumnRenamed("outbound", "record")


def keeps_state(ruleset: RuleSet, record: str = "record") -> bool:
    """Whether a rule looks beyond the single record."""
    state = _Bound(list(ruleset), record, Views()).state
    return bool(state.uniques or state.prior)


def apply_rule(df: DataFrame, rule: Rule, **options) -> DataFrame:
    return route(df, RuleSet([rule]), **options)


def split_by_destination(routed: DataFrame, ruleset: RuleSet, folder: str | None = None) -> dict[str, DataFrame]:
    """One frame per destination.

    With a ``folder`` on shared storage the routing runs once and is kept there
    by destination, and each frame reads its own part only. Without one, each
    frame runs the routing again unless ``routed`` is persisted.
    """
    if folder is not None:
        routed.write.partitionBy("destination").parquet(folder)
        columns = routed.columns
        routed = routed.sparkSession.read.schema(routed.schema).parquet(folder).select(*columns)
    names = dict.fromkeys(rule.destination for rule in ruleset)
    return {name: routed.where(F.col("destination") == name) for name in names}


def match_counts(routed: DataFrame) -> DataFrame:
    return routed.groupBy("rule").agg(F.count("*").alias("matches"))
