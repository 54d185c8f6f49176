"""Rule-based routing of JSON records with Spark DataFrames."""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

from .functions import *  # noqa: F401,F403
from .functions import __all__ as _functions
from .operators.batches import batch_by_size, batch_by_size_or_age, batch_by_time, batch_key
from .operators.cache import cache_asof, cache_check, cache_clear, cache_fetch, cache_put, cache_remove
from .operators.fanout import ListedRule, fan_out
from .operators.project import SEND_ALL, outbound
from .operators.route import Record, apply_rule, match_counts, route, split_by_destination, split_errors
from .operators.unique import (
    key_hash, seen_add, seen_clear, seen_count, seen_lookup, seen_remove, unique_filter, unique_flag,
)
from .plans.rules import Rule, RuleSet, load_ruleset, read_rulesets, ruleset_table
from .session import local_session, tune, work_folder
from .sinks.batch_files import read_batches, write_batches
from .sinks.emit import emit_envelope
from .sinks.fan import write_each
from .sinks.once import OnceSink, read_once, write_once
from .sinks.registry import call, publish, register_function, register_sink, register_source, source
from .sources.envelope import (
    ENVELOPE, as_envelope, deaggregate, decode_snappy, drop_empty, from_position, invalid_records, sequence_key,
    tail_positions,
)
from .sources.scan import read_records
from .sources.shards import append_records, read_shards, shard_stream
from .streaming.counts import count_points, read_counts, read_failures
from .streaming.memory import commit_progress, read_progress
from .streaming.runner import run_router
from .streaming.state import StreamCache, stream_cache, stream_unique
from .streaming.store import KeyStore

__all__ = [
    *_functions, "ENVELOPE", "KeyStore", "ListedRule", "OnceSink", "Record", "Rule", "RuleSet", "SEND_ALL", "StreamCache",
    "append_records", "apply_rule", "as_envelope", "batch_by_size",
    "batch_by_size_or_age",
    "batch_by_time", "batch_key", "cache_asof", "cache_check", "cache_clear", "cache_fetch", "cache_put",
    "cache_remove", "call", "commit_progress", "count_points", "deaggregate", "decode_snappy", "drop_empty", "emit_envelope", "fan_out",
    "from_position", "invalid_records", "key_hash", "load_ruleset", "local_session", "match_counts", "outbound", "publish",
    "read_batches", "read_counts", "read_failures", "read_once", "read_progress", "read_records", "read_shards", "read_rulesets", "register_function", "register_sink", "register_source", "route",
    "ruleset_table", "run_router", "seen_add", "seen_clear", "seen_count", "seen_lookup", "seen_remove",
    "sequence_key", "shard_stream", "source", "split_by_destination", "split_errors", "stream_cache", "stream_unique", "tail_positions",
    "tune", "unique_filter", "unique_flag", "work_folder", "write_batches",
    "write_each", "write_once",
]

# Functions run inside tasks travel with them, so executors need no copy of this package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
