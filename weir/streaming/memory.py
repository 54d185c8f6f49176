"""What rules remember from one micro-batch to the next, as tables.

Micro-batch ``n`` reads what earlier ones wrote and writes its own part under
``batch=n``, so repeating it reads and writes the same. The tables live beside
the stream's checkpoint in a folder all executors share.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.progress import PROGRESS_SCHEMA, commit, last_sequences
from .store import KeyStore


def _versions(spark: SparkSession, path: str, schema: T.StructType, batch_id: int) -> DataFrame:
    """All parts of a table, with their micro-batch in the column ``batch``."""
    if batch_id == 0:
        # Nothing is older than the first micro-batch; start the table.
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{path}/batch=-1")
    whole = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    return spark.read.schema(whole).parquet(path)


def commit_progress(folder: str, shard: str = "shard_id",
                    sequence: str = "sequence_number") -> Callable[[DataFrame, int], None]:
    """For ``run_router(after=...)``: keep a progress table, one version per micro-batch."""
    def after(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        schema = T.StructType.fromDDL(PROGRESS_SCHEMA)
        old = _versions(spark, folder, schema, batch_id).where(F.col("batch") == batch_id - 1).drop("batch")
        read = batch.select(F.col(shard).alias("shard_id"), F.col(sequence).alias("sequence_number"))
        commit(old, last_sequences(read)).write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    return after


def read_progress(spark: SparkSession, folder: str) -> DataFrame:
    """The newest version of a progress table."""
    whole = spark.read.schema(f"{PROGRESS_SCHEMA}, batch long").parquet(folder)
    newest = whole.agg(F.max("batch")).first()[0]
    return whole.where(F.col("batch") == newest).drop("batch")


class Memory:
    """Seen keys and cached values as of one micro-batch.

    ``remember`` is for how many micro-batches a seen key counts as seen;
    ``None`` keeps keys for ever.
    """

    def __init__(self, spark: SparkSession, folder: str, batch_id: int, remember: int | None):
        self._spark = spark
        self._folder = folder
        self._batch = batch_id
        self._remember = remember
        self._stores: list[KeyStore] = []

    def _store(self, name: str, keys: list[T.StructField], values: list[T.StructField], remember: int | None) -> KeyStore:
        store = KeyStore(self._spark, f"{self._folder}/{name}", keys, values, self._batch, remember=remember)
        self._stores.append(store)
        return store

    def first_seen(self, name: str, firsts: DataFrame, keys: list[str]) -> DataFrame:
        """Those rows of ``firsts``, one per key, whose key no earlier micro-batch has seen; their keys are remembered."""
        store = self._store(name, [T.StructField(k, T.StringType()) for k in keys], [], self._remember)
        new = store.unknown(firsts, keys)
        store.put(new)
        return new

    def cached(self, rows: DataFrame, scopes: list[str], written: list[str]) -> tuple[DataFrame, KeyStore]:
        """The last cached values of the scopes in ``rows``, and the store to put new ones into."""
        store = self._store("cache", [rows.schema[s] for s in scopes], [rows.schema[w] for w in written], None)
        return store.lookup(rows.select(*scopes).distinct()) if scopes else store.rows(), store

    def save(self) -> None:
        """Write this micro-batch's part."""
        for store in self._stores:
            store.save()
