"""Reading progress as a table: one row per shard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.envelope import from_position, sequence_key, tail_positions

PROGRESS_SCHEMA = "shard_id string, sequence_number string, last_update timestamp, finished timestamp"


def last_sequences(df: DataFrame, shard: str = "shard_id", sequence: str = "sequence_number") -> DataFrame:
    """The last sequence number of every shard in ``df``."""
    return tail_positions(df, shard, sequence)


def commit(progress: DataFrame, batch: DataFrame, at: Column | None = None) -> DataFrame:
    """The progress table after a batch; only shards that moved get a new time.

    ``batch`` holds ``shard_id, sequence_number``. A shard never moves back.
    """
    at = F.current_timestamp() if at is None else at
    new = batch.select("shard_id", F.col("sequence_number").alias("__new"))
    both = progress.join(new, "shard_id", "full_outer")
    moved = F.col("__new").isNotNull() & (
        F.col("sequence_number").isNull() | (sequence_key("__new") > sequence_key("sequence_number"))
    )
    return both.select(
        "shard_id",
        F.when(moved, F.col("__new")).otherwise(F.col("sequence_number")).alias("sequence_number"),
        F.when(moved, at).otherwise(F.col("last_update")).alias("last_update"),
        "finished",
    )


def changed(progress: DataFrame, batch: DataFrame) -> DataFrame:
    """The rows of ``batch`` that a commit would have to write."""
    done = progress.select(F.col("shard_id").alias("__shard"), F.col("sequence_number").alias("__done"))
    kept = (F.col("shard_id") == F.col("__shard")) & (sequence_key("sequence_number") <= sequence_key("__done"))
    return batch.join(done, kept, "left_anti")


def finish(progress: DataFrame, ends: DataFrame, at: Column | None = None) -> DataFrame:
    """Mark shards whose final sequence number has been committed.

    ``ends`` holds ``shard_id, final_sequence`` of closed shards; NULL there
    means nothing was ever read from the shard.
    """
    at = F.current_timestamp() if at is None else at
    joined = progress.join(ends.withColumn("__closed", F.lit(True)), "shard_id", "left")
    done = F.col("__closed") & (
        F.col("final_sequence").isNull() | (F.col("sequence_number") == F.col("final_sequence"))
    )
    mark = F.coalesce(F.col("finished"), F.when(done, at))
    return joined.select("shard_id", "sequence_number", "last_update", mark.alias("finished"))


def finished_shards(progress: DataFrame) -> DataFrame:
    return progress.where(F.col("finished").isNotNull())


def resume(df: DataFrame, progress: DataFrame) -> DataFrame:
    """What is left to read after the committed positions."""
    return from_position(df, "AFTER", progress.select("shard_id", "sequence_number"))


def drop_repeats(df: DataFrame, keys: Sequence[str] = ("shard_id", "sequence_number")) -> DataFrame:
    """Each record once, after a reader has gone over some of them again.

    Repeats are merged before the shuffle, so any number of copies is fine.
    Add ``sub_seq`` to the keys for records split from aggregated ones.
    """
    return df.dropDuplicates(list(keys))
