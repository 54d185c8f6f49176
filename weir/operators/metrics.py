"""Counts, lags and metric points as tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

METRIC_SCHEMA = "name string, kind string, value double, dims map<string,string>, ts timestamp"


def record_count(df: DataFrame, shard: str = "shard_id") -> DataFrame:
    return df.groupBy(shard).agg(F.count("*").alias("record_count"))


def millis_behind(df: DataFrame, shard: str = "shard_id", ts: str = "arrival_ts") -> DataFrame:
    """How far the newest record of each shard lies behind the newest of all."""
    newest = df.groupBy(shard).agg(F.max(F.unix_micros(F.col(ts).cast("timestamp"))).alias("__newest"))
    # One row per shard, so the window over everything stays small.
    lag = F.max("__newest").over(Window.partitionBy()) - F.col("__newest")
    return newest.select(shard, lag.alias("__lag")).select(shard, F.expr("__lag div 1000").alias("millis_behind"))


def with_dims(points: DataFrame, base: Mapping[str, str], dims: str = "dims", prefix: str = "") -> DataFrame:
    """Add base dimensions, a point's own dimensions win, and a prefix to the names."""
    if prefix:
        points = points.withColumn("name", F.concat(F.lit(prefix), "name"))
    if not base:
        return points
    own = F.coalesce(F.col(dims), F.create_map().cast("map<string,string>"))
    fixed = F.create_map(*[F.lit(x) for pair in base.items() for x in pair])
    added = F.map_filter(fixed, lambda k, _: ~F.map_contains_key(own, k))
    return points.withColumn(dims, F.map_concat(added, own))


def _reduced(points: DataFrame, value: Column) -> DataFrame:
    # Maps have no order of their own: sort the entries so equal maps meet.
    key = F.array_sort(F.map_entries(F.coalesce("dims", F.create_map().cast("map<string,string>"))))
    grouped = points.withColumn("__dims", key).groupBy("name", "__dims").agg(value.alias("value"))
    return grouped.select("name", F.map_from_entries("__dims").alias("dims"), "value")


def gauges(points: DataFrame) -> DataFrame:
    """The last value per name and dimensions."""
    return _reduced(points.where(F.col("kind") == "gauge"), F.max_by("value", "ts"))


def counters(points: DataFrame) -> DataFrame:
    """The cumulative sum per name and dimensions."""
    return _reduced(points.where(F.col("kind") == "counter"), F.sum("value"))


class RouterListener(StreamingQueryListener):
    """Counts records, committed micro-batches and failures of streaming queries."""

    def __init__(self) -> None:
        self.record_count = 0
        self.checkpoint_count = 0
        self.critical_error_count = 0
        self.publish_count = self.publish_millis_sum = self.publish_millis_max = 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self.record_count += progress.numInputRows
        self.checkpoint_count += 1
        millis = progress.durationMs.get("addBatch", 0)
        self.publish_count += 1
        self.publish_millis_sum += millis
        self.publish_millis_max = max(self.publish_millis_max, millis)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception is not None:
            self.critical_error_count += 1
