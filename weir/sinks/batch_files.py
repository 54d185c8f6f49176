"""Compressed line files, one per batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.batches import batch_by_size, time_slot


def write_batches(df: DataFrame, path: str, order: Sequence[Column | str], *, seconds: int = 60,
                  max_bytes: int = 80_000_000, record: str = "outbound", shard: str = "shard_id",
                  ts: str = "arrival_ts", mode: str = "append") -> None:
    """Write gzip text files under ``day/minute/shard/batch``.

    A batch ends when its flush interval ends or its bytes are full. No task
    gets more than whole batches, so a busy shard spreads over all of them.
    """
    slotted = df.withColumn("__slot", time_slot(ts, seconds))
    sized = batch_by_size(slotted, max_bytes, order, scope=["__slot", shard], record=record, into="__part")
    slot, part = F.col("__slot"), F.lpad(F.col("__part").cast("string"), 6, "0")
    placed = sized.withColumns({
        "dt": F.date_format(slot, "yyyy-MM-dd"),
        "hm": F.date_format(slot, "HHmm"),
        "shard": F.col(shard).cast("string"),
        # Records without a time or shard have batches of their own, bounded like all others.
        "batch": F.concat(F.coalesce(F.col(shard).cast("string"), F.lit("none")), F.lit("-"),
                          F.coalesce(F.unix_timestamp(slot).cast("string"), F.lit("none")), F.lit("-"), part),
    })
    places = ["dt", "hm", "shard", "batch"]
    (placed.repartition(*places)
     .sortWithinPartitions(*places, *order)
     .select(F.col(record).alias("value"), *places)
     .write.mode(mode).partitionBy(*places).option("compression", "gzip").text(path))


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """The lines of written batches with their place."""
    places = "value string, dt string, hm string, shard string, batch string"
    return spark.read.schema(places).text(path)
