"""Times the headline queries and prints one JSON line.

Each query is run to the end into a sink that drops the rows, so no collect is
timed. Records are dealt out to as many tasks as there are cores, as the events
are one row group; ``own_splits`` has the routing queries without that.
``events_per_sec`` is the routing rate over the events table.
"""

from __future__ import annotations

import json
import os
import time

from catalog import QUERIES, base
from weir import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))

HEADLINE = [
    "rule_single", "route_all", "route_counts", "route_by_dest", "route_many_rules", "route_wide",
    "send_typed", "pred_cnf", "fn_sprintf", "fn_join", "fn_basename",
    "unique_flag", "unique_filter", "rule_unique", "rule_cache",
    "cache_put", "cache_fetch", "cache_fetch_global", "cache_asof",
    "deaggregate", "decode_snappy", "emit_envelope", "pos_after",
    "batch_by_time", "batch_by_size", "progress_last_seq", "progress_commit",
    "metric_gauge", "metric_counter", "stream_unique", "stream_cache",
]


def run(spark, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = local_session(CPUS, "weir-bench")
    # One untimed query starts the JVM's executor and Parquet reader.
    run(spark, "route_counts")
    own = {name: round(run(spark, name), 3) for name in HEADLINE if name.startswith(("route_", "rule_"))}
    base.PARTITIONS = CPUS
    run(spark, "route_counts")
    seconds = {name: round(run(spark, name), 3) for name in HEADLINE}
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "events_per_sec": round(events / seconds["route_all"]),
        "own_splits": own,
    }))


if __name__ == "__main__":
    main()
