"""Grouping records into the batches a batch sink writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.carry import as_column, carry_last, carry_max, carry_sum
from ..session import work_folder
from .unique import with_row_key


def line_bytes(record: Column | str = "record") -> Column:
    """Bytes a record takes in a batch: itself and a line feed."""
    return F.octet_length(as_column(record)) + 1


def time_slot(ts: Column | str, seconds: int) -> Column:
    """Start of the flush interval a record falls in; NULL without a time."""
    at = F.unix_timestamp(as_column(ts).cast("timestamp"))
    return F.timestamp_seconds(at - F.pmod(at, F.lit(int(seconds))))


def batch_by_time(df: DataFrame, seconds: int, *, ts: str = "arrival_ts", shard: str = "shard_id",
                  record: str = "record") -> DataFrame:
    """Records and bytes of every batch when batches are cut by age alone."""
    return df.groupBy(time_slot(ts, seconds).alias("batch_start"), shard).agg(
        F.count("*").alias("records"), F.sum(line_bytes(record)).alias("bytes"))


def batch_by_size(df: DataFrame, max_bytes: int, order: Sequence[Column | str], *,
                  scope: Sequence[str] = ("shard_id",), record: str = "record",
                  into: str = "batch", buckets: int | None = None) -> DataFrame:
    """Number the batches of each shard: a record opens batch ``k`` once the
    bytes before it fill ``k`` batches."""
    if max_bytes < 1:
        raise ValueError("max_bytes must be positive")
    out = carry_sum(df, {"__before": line_bytes(record).cast("bigint")}, order, scope=scope, buckets=buckets)
    return out.withColumn(into, F.expr(f"__before div {int(max_bytes)}")).drop("__before")


def _kept(df: DataFrame) -> DataFrame:
    path = work_folder(df.sparkSession, "batches")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _first_at(rows: DataFrame, value: str, beyond: int, into: str) -> DataFrame:
    """Add the first place of the shard whose ``value``, which never falls, is at least ``beyond`` more than the row's."""
    there = rows.select("__shard", F.col(value).alias("__v"), F.struct("__place").alias("__at"), F.lit(None).cast("long").alias("__of"))
    asked = rows.select("__shard", (F.col(value) + beyond).alias("__v"), F.lit(None).cast(there.schema["__at"].dataType).alias("__at"),
                        F.col("__place").alias("__of"))
    # Downwards, the place last met is the lowest that reaches as far.
    both = there.unionByName(asked)
    order = [-F.col("__v"), F.col("__of").isNotNull(), -F.col("__at.__place")]
    found = carry_last(both, {"__found": F.col("__at")}, order, scope=["__shard"])
    found = found.where("__of IS NOT NULL").select("__shard", F.col("__of").alias("__place"), F.col("__found.__place").alias(into))
    return rows.join(found, ["__shard", "__place"])


def batch_by_size_or_age(df: DataFrame, max_bytes: int, seconds: int, order: Sequence[Column | str], *, ts: str = "arrival_ts",
                         scope: Sequence[str] = ("shard_id",), record: str = "record", into: str = "batch") -> DataFrame:
    """Number the batches of each shard, cut by size or age, whichever comes first; size and age start anew with each batch.

    A record opens the next batch if the batch's bytes before it are at least ``max_bytes``, or if it is at least ``seconds``
    later than the batch's first record. A record's time is the latest up to it; one before the first time has that of 1970.
    Ties in ``order`` follow a hash of the row.

    Every record points to the one that would open the next batch if it opened its own; both limits are looked up along the
    order. The pointers that start from a shard's first record are then followed by doubling: each round joins every pointer
    with the one behind it, so a shard of n batches takes log2(n) rounds, and busy shards are cut along the order all the way.
    """
    if max_bytes < 1 or seconds < 1:
        raise ValueError("max_bytes and seconds must be positive")
    columns = [F.col(f"`{c}`") for c in df.columns if c != into]
    rows = with_row_key(df, order).withColumn("__shard", F.struct(*scope) if scope else F.lit(0))
    at = [F.col("__at")[f] for f in rows.schema["__at"].dataType.names]
    time = F.unix_micros(as_column(ts).cast("timestamp"))
    rows = carry_sum(rows, {"__bytes": line_bytes(record).cast("long"), "__place": F.lit(1).cast("long")}, at, scope=["__shard"])
    rows = _kept(carry_max(rows, {"__time": F.coalesce(time, F.lit(0))}, at, scope=["__shard"]))
    narrow = rows.select("__shard", "__place", "__bytes", "__time")
    pointed = _first_at(_kept(_first_at(narrow, "__bytes", max_bytes, "__full")), "__time", 1_000_000 * seconds, "__old")
    jump = _kept(pointed.select("__shard", "__place", F.least("__full", "__old").alias("__to")).where("__to IS NOT NULL"))
    opened = _kept(narrow.where("__place = 0").select("__shard", "__place"))
    while True:
        reached = opened.join(jump, ["__shard", "__place"]).select("__shard", F.col("__to").alias("__place"))
        reached = _kept(reached.join(opened, ["__shard", "__place"], "left_anti"))
        if not reached.limit(1).count():
            break
        opened = opened.unionByName(reached)
        behind = jump.select("__shard", F.col("__place").alias("__to"), F.col("__to").alias("__next"))
        jump = _kept(jump.join(behind, ["__shard", "__to"]).select("__shard", "__place", F.col("__next").alias("__to")))
    marked = rows.join(opened.withColumn("__opens", F.lit(1).cast("long")), ["__shard", "__place"], "left")
    marked = marked.withColumn("__opens", F.coalesce("__opens", F.lit(0).cast("long")))
    counted = carry_sum(marked, {"__before": F.col("__opens")}, ["__place"], scope=["__shard"])
    return counted.select(*columns, (F.col("__before") + F.col("__opens") - 1).alias(into))


def batch_key(ts: Column | str, shard: Column | str) -> Column:
    """Object name of a batch: day, hour and minute, shard, epoch seconds."""
    at = as_column(ts).cast("timestamp")
    return F.concat(F.date_format(at, "yyyy-MM-dd/HHmm"), F.lit("/"), as_column(shard).cast("string"),
                    F.lit("-"), F.unix_timestamp(at).cast("string"), F.lit(".gz"))
