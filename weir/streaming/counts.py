"""What micro-batches count, kept beside the stream so that a restart goes on from there.

Records and matches are counted by the job that routes them (``DataFrame.observe``). Each micro-batch leaves one small file
once it is published; a repeated one overwrites its own. A micro-batch that fails leaves a file of its own for each attempt.
"""

from __future__ import annotations

import logging
import threading
import time
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources.shards import names_in, write_json

log = logging.getLogger("weir")

COUNTS_SCHEMA = ("batch long, records long, bytes long, newest long, matches long, sent_bytes long, errors long, "
                 "failed_rules array<string>, millis long, at long")
FAILURES_SCHEMA = "batch long, error string, at long"
WAIT_SECONDS = 30.0


def _now() -> int:
    return int(time.time() * 1000)


class Counts:
    """The counts of one micro-batch. ``newest`` and ``at`` are milliseconds since 1970, ``bytes`` the records' UTF-8 bytes."""

    def __init__(self, folder: str, batch: int, record: str, ts: str | None):
        self._folder, self._batch, self._started = folder, batch, time.monotonic()
        newest = F.lit(None).cast("long") if ts is None else F.unix_millis(F.col(ts).cast("timestamp"))
        self._of_records = [F.count(F.lit(1)).alias("records"), F.sum(F.octet_length(record)).alias("bytes"),
                            F.max(newest).alias("newest")]
        self._parts: list = []

    def _observed(self, df: DataFrame, columns: list[Column]) -> DataFrame:
        seen = Observation()
        self._parts.append((seen, df, columns))
        return df.observe(seen, *columns)

    def records(self, batch: DataFrame, kept: bool = False) -> DataFrame:
        """Count the records on their way; at once if they are kept, as they are read more than once then."""
        if kept:
            self._parts.append((None, batch, self._of_records))
            return batch
        return self._observed(batch, self._of_records)

    def matches(self, routed: DataFrame) -> DataFrame:
        failed = F.col("error").isNotNull() if "error" in routed.columns else F.lit(False)
        return self._observed(routed, [
            F.count_if(~failed).alias("matches"), F.sum(F.when(~failed, F.octet_length("outbound"))).alias("sent_bytes"),
            F.count_if(failed).alias("errors")])

    @staticmethod
    def _values(seen: Observation | None, df: DataFrame, columns: list[Column]) -> dict:
        found: list[dict] = []
        if seen is not None:
            # The optimizer may drop an observation together with an empty part of the plan; then it has no value, or never ends.
            def wait() -> None:
                try:
                    found.append(seen.get)
                except Exception:
                    log.debug("an observation has no value", exc_info=True)

            waiting = threading.Thread(target=wait, daemon=True)
            waiting.start()
            waiting.join(WAIT_SECONDS)
        return found[0] if found else df.agg(*columns).first().asDict()

    def save(self, failed_rules: list[str]) -> None:
        values = {"batch": self._batch}
        for part in self._parts:
            values |= self._values(*part)
        values |= {"bytes": values["bytes"] or 0, "sent_bytes": values["sent_bytes"] or 0, "failed_rules": failed_rules,
                   "millis": int((time.monotonic() - self._started) * 1000), "at": _now()}
        write_json(f"{self._folder}/batches", f"{self._batch:012d}.json", values)

    def failed(self, error: Exception) -> None:
        try:
            write_json(f"{self._folder}/failures", f"{self._batch:012d}-{uuid.uuid4().hex}.json",
                       {"batch": self._batch, "error": f"{type(error).__name__}: {error}"[:10_000], "at": _now()})
        except OSError:
            log.exception("the failure of batch %s could not be kept", self._batch)


def _read(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    if not names_in(folder):
        return spark.createDataFrame([], schema)
    # Only whole files: one that is being written ends in .part.
    return spark.read.schema(schema).option("pathGlobFilter", "*.json").json(folder)


def read_counts(spark: SparkSession, folder: str) -> DataFrame:
    """One row per published micro-batch. ``millis_behind`` is how old its newest record was when it was published."""
    lag = F.when(F.col("newest").isNotNull(), F.greatest(F.col("at") - F.col("newest"), F.lit(0)))
    return _read(spark, f"{folder}/batches", COUNTS_SCHEMA).withColumn("millis_behind", lag)


def read_failures(spark: SparkSession, folder: str) -> DataFrame:
    """One row per attempt of a micro-batch that failed."""
    return _read(spark, f"{folder}/failures", FAILURES_SCHEMA)


def count_points(counts: DataFrame, failures: DataFrame | None = None) -> DataFrame:
    """The counts as metric points, for ``counters``, ``gauges`` and ``with_dims``."""
    adding = {"record_count": F.col("records"), "record_bytes": F.col("bytes"), "match_count": F.col("matches"),
              "sent_bytes": F.col("sent_bytes"), "critical_error_count": F.col("errors"), "checkpoint_count": F.lit(1),
              "failed_rule_count": F.size("failed_rules"), "publish_millis_sum": F.col("millis")}
    latest = {"millis_behind": F.col("millis_behind"), "publish_millis": F.col("millis"), "batch_bytes": F.col("sent_bytes")}

    def points(df: DataFrame, **kinds: dict[str, Column]) -> DataFrame:
        made = [F.struct(F.lit(name).alias("name"), F.lit(kind).alias("kind"), value.cast("double").alias("value"))
                for kind, values in kinds.items() for name, value in values.items()]
        return (df.select(F.timestamp_millis("at").alias("ts"), F.explode(F.array(*made)).alias("p"))
                .where("p.value IS NOT NULL")
                .select("p.*", F.create_map().cast("map<string,string>").alias("dims"), "ts"))

    found = points(counts, counter=adding, gauge=latest)
    if failures is not None:
        found = found.unionByName(points(failures, counter={"failed_batch_count": F.lit(1)}))
    return found.select("name", "kind", "value", "dims", "ts")
