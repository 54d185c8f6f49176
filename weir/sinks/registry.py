"""Destinations, sources and functions by name, and publishing to them."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.rules import Rule, RuleSet
from .batch_files import write_batches
from .emit import emit_envelope
from .fan import write_each

log = logging.getLogger("weir")

Writer = Callable[[DataFrame, int, Mapping[str, object]], None]

_sinks: dict[str, Writer] = {}
_sources: dict[str, Callable[..., DataFrame]] = {}
_functions: dict[str, Callable[..., Column]] = {}


def register_sink(name: str, writer: Writer) -> None:
    """``writer(matches, batch_id, params)`` publishes the matches of rules that share it."""
    _sinks[name] = writer


def register_source(name: str, reader: Callable[..., DataFrame]) -> None:
    """``reader(spark, **params)`` yields envelopes or records, table or stream."""
    _sources[name] = reader


def register_function(name: str, builder: Callable[..., Column]) -> None:
    """``builder(*arguments)`` yields a Column, from built-ins or a pandas UDF."""
    _functions[name] = builder


def source(name: str, spark: SparkSession, **params) -> DataFrame:
    return _sources[name](spark, **params)


def call(name: str, *arguments) -> Column:
    return _functions[name](*arguments)


def _batch(matches: DataFrame, batch_id: int, params: Mapping[str, object]) -> None:
    # A folder per micro-batch: a repeated one overwrites what it wrote before.
    options = {k: v for k, v in params.items() if k != "path"}
    write_batches(matches, f"{params['path']}/b{batch_id}", mode="overwrite", **options)


def _emit(matches: DataFrame, batch_id: int, params: Mapping[str, object]) -> None:
    options = {k: str(v) for k, v in params.items() if k not in ("format", "path")}
    out = emit_envelope(matches).select("partition_key", "data").write.format(str(params["format"]))
    out = out.options(**options)
    if "path" in params:
        out.mode("overwrite").save(f"{params['path']}/b{batch_id}")
    else:
        out.mode("append").save()


def _debug(matches: DataFrame, batch_id: int, params: Mapping[str, object]) -> None:
    """Log every match, on the executor that has it."""
    def write(rows) -> None:
        out = logging.getLogger("weir")
        for row in rows:
            out.info("batch %s rule %s: %s", batch_id, row.rule, row.outbound)

    matches.select("rule", "outbound").foreachPartition(write)


def _files(matches: DataFrame, batch_id: int, params: Mapping[str, object]) -> None:
    """For one group of rules; :func:`publish` writes all groups in one pass instead."""
    for error in write_each(matches.withColumn("target", F.lit(0)), {0: str(params["path"])}, batch_id).values():
        raise OSError(error)


register_sink("batch", _batch)
register_sink("emit", _emit)
register_sink("debug", _debug)
register_sink("files", _files)


def one_pass(ruleset: RuleSet) -> bool:
    """Whether publishing reads the matches once, so that they need not be kept."""
    return all(r.destination == "files" for r in ruleset)


def _publish_files(routed: DataFrame, rules: list[Rule], batch_id: int) -> list[Rule]:
    """The matches of all rules, each into the folder its ``path`` names, in one job; the rules whose folder failed."""
    numbers = {path: i for i, path in enumerate(dict.fromkeys(str(r.params["path"]) for r in rules))}
    of_rule = F.create_map(*[F.lit(x) for r in rules for x in (r.name, numbers[str(r.params["path"])])])
    errors = write_each(routed.withColumn("target", of_rule[F.col("rule")]), {i: p for p, i in numbers.items()}, batch_id)
    for path, i in numbers.items():
        if i in errors:
            log.error("folder %s failed in batch %s: %s", path, batch_id, errors[i])
    return [r for r in rules if numbers[str(r.params["path"])] in errors]


def publish(routed: DataFrame, ruleset: RuleSet, batch_id: int = 0) -> list[str]:
    """Send the matches of every rule to its destination.

    Rules with the same destination and parameters are written together, and
    all rules for ``files`` in one pass over the matches, whatever folders they
    name. A failing sink raises if such rules have the checkpoint flag set, so
    progress stops there; folders of ``files`` that did not fail have got their
    matches by then, and are left alone when the micro-batch is repeated.
    Otherwise it is logged; the names of the rules are returned.
    """
    unknown = sorted({r.destination for r in ruleset} - _sinks.keys())
    if unknown:
        raise KeyError(f"no sink registered for {unknown}")
    to_files = [r for r in ruleset if r.destination == "files"]
    groups: dict[tuple, list[Rule]] = {}
    for rule in ruleset:
        key = (rule.destination, rule.checkpoint, repr(sorted(rule.params.items())))
        if rule.destination != "files":
            groups.setdefault(key, []).append(rule)
    failed: list[str] = []
    several = len(groups) + bool(to_files) > 1
    if several:
        routed = routed.persist()
    try:
        if to_files:
            matches = routed.where(F.col("rule").isin([r.name for r in to_files])) if groups else routed
            lost = _publish_files(matches, to_files, batch_id)
            if flagged := [r.name for r in lost if r.checkpoint]:
                raise OSError(f"files of rules {flagged} failed in batch {batch_id}")
            failed += [r.name for r in lost]
        for rules in groups.values():
            names = [r.name for r in rules]
            try:
                _sinks[rules[0].destination](routed.where(F.col("rule").isin(names)), batch_id, rules[0].params)
            except Exception:
                if rules[0].checkpoint:
                    raise
                log.exception("sink of rules %s failed in batch %s", names, batch_id)
                failed += names
    finally:
        if several:
            routed.unpersist()
    return failed
