"""Small helpers the corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.session import work_folder

ROWS_PER_TASK = 1_000_000
SIEVE_WORDS = 1 << 20  # of 63 bits each that a sieve has at most, 16 MB


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the cluster's shared folder and read back, so later jobs see the same rows."""
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str | Column = "text") -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def buckets_for(rows: int, least: int = 64, rows_per_task: int = ROWS_PER_TASK) -> int:
    """So many hash buckets that each holds a task's worth of rows; grows with the input."""
    return max(least, -(-rows // rows_per_task))


def running_offsets(counts: DataFrame, group: str, bucket: str, amount: str, name: str) -> DataFrame:
    """The sum of ``amount`` over the earlier buckets of each group, from one row per group and bucket."""
    from pyspark.sql import Window

    before = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(group, bucket, F.coalesce(F.sum(amount).over(before), F.lit(0)).cast("long").alias(name))


def small_table(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A driver-made table of proven small size."""
    return spark.createDataFrame(rows, schema)


def sieve(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` may be in ``wanted``; about one in nine others passes, more once the sieve is at its bound.

    Bits of hashed keys, eight for a wanted one, go to every task, so a join that follows does not shuffle the other rows.
    """
    count = wanted.count()
    words = max(1, min(SIEVE_WORDS, 8 * count // 63 + 1))
    place = F.pmod(F.xxhash64(key), F.lit(words * 63))
    word, bit = F.floor(place / 63).cast("long"), (place % 63).cast("int")
    bits = stored(wanted.select(word.alias("__word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bit"))
                  .groupBy("__word").agg(F.bit_or("bit").alias("__bits")), "sieve")
    some = rows.withColumns({"__word": word, "__bit": bit}).join(F.broadcast(bits), "__word")
    return some.where(F.getbit("__bits", F.col("__bit")) == 1).drop("__word", "__bit", "__bits")
