"""Keys and what belongs to them, kept from one micro-batch to the next.

Micro-batch ``n`` appends a run of the keys it changed. Every eight runs of a level are merged into one of the next, in which
the newest row of each key wins, so after ``n`` micro-batches about ``7 log8(n)`` runs are read, and a key is rewritten
``log8(n)`` times in all. Which runs there are follows from the number of the micro-batch alone: level ``l`` has as many as
digit ``l`` of ``n`` to the base of eight. A repeated micro-batch therefore reads the same and writes the same over again; runs
that have been merged go two micro-batches later, when nothing can read them any more.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FANOUT = 8


def live_runs(batch: int, fanout: int = FANOUT) -> Iterator[tuple[int, int]]:
    """Level and first micro-batch of the runs that hold what came before micro-batch ``batch``, oldest first."""
    level, runs, end = 0, [], batch
    while end:
        width = fanout**level
        digit = end // width % fanout
        runs += [(level, end - width * k) for k in range(1, digit + 1)]
        end -= digit * width
        level += 1
    return iter(sorted(runs, key=lambda r: r[1]))


def merges_after(batch: int, fanout: int = FANOUT) -> Iterator[tuple[int, int]]:
    """Level and first micro-batch of the runs that are made by merging once ``batch`` is written, lowest level first."""
    level = 1
    while (batch + 1) % fanout**level == 0:
        yield level, batch + 1 - fanout**level
        level += 1


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder from whatever store Spark keeps it in."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


class KeyStore:
    """Rows by key as of one micro-batch. Every micro-batch, empty or not, must call :meth:`save`.

    ``keys`` and ``values`` are lists of fields; no key at all means one row for everything. ``remember`` is for how many
    micro-batches after it was last written a key is kept; ``None`` keeps keys for ever.
    """

    def __init__(self, spark: SparkSession, folder: str, keys: Sequence[T.StructField], values: Sequence[T.StructField],
                 batch: int, *, remember: int | None = None, fanout: int = FANOUT):
        self.spark, self.folder, self.batch, self.remember, self.fanout = spark, folder, batch, remember, fanout
        self.keys, self.values = [f.name for f in keys], [f.name for f in values]
        fields = [T.StructField(f.name, f.dataType) for f in (*keys, *values)]
        self.schema = T.StructType([*fields, T.StructField("__gone", T.BooleanType()), T.StructField("__batch", T.LongType())])
        self.waiting: list[DataFrame] = []

    def _path(self, level: int, first: int) -> str:
        return f"{self.folder}/level={level}/first={first}"

    def _read(self, runs: Sequence[tuple[int, int]]) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[self._path(*r) for r in runs])

    def _newest(self, rows: DataFrame, batch: int) -> DataFrame:
        """The newest row of each key that is still remembered before ``batch``."""
        if self.remember is not None:
            rows = rows.where(F.col("__batch") >= batch - self.remember)
        row = F.struct("__gone", *self.values)
        return (rows.groupBy(*self.keys).agg(F.max_by(row, "__batch").alias("__row"), F.max("__batch").alias("__batch"))
                .where(F.col("__batch").isNotNull()).select(*self.keys, "__row.*", "__batch"))

    def rows(self) -> DataFrame:
        """Keys and values as earlier micro-batches left them."""
        rows = self._newest(self._read([*live_runs(self.batch, self.fanout)]), self.batch)
        return rows.where("not __gone").select(*self.keys, *self.values)

    def lookup(self, wanted: DataFrame) -> DataFrame:
        """The same for the keys in ``wanted``, which holds each key once and is small beside the store."""
        if not self.keys:
            return self.rows()
        wanted = wanted.select(*[F.col(k).alias(f"__wanted_{k}") for k in self.keys])
        same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__wanted_{k}")) for k in self.keys])
        found = self._read([*live_runs(self.batch, self.fanout)]).join(wanted, same, "left_semi")
        return self._newest(found, self.batch).where("not __gone").select(*self.keys, *self.values)

    def unknown(self, rows: DataFrame, names: Sequence[str]) -> DataFrame:
        """The rows whose key, in the columns ``names``, is not in the store."""
        found = self.lookup(rows.select(*[F.col(n).alias(k) for n, k in zip(names, self.keys)]).distinct())
        known = found.select(*[F.col(k).alias(f"__known_{k}") for k in self.keys])
        same = reduce(Column.__and__, [F.col(n).eqNullSafe(F.col(f"__known_{k}")) for n, k in zip(names, self.keys)])
        return rows.join(known, same, "left_anti")

    def put(self, rows: DataFrame) -> None:
        """Add or replace keys; each at most once in a micro-batch. Written by :meth:`save`."""
        self.waiting.append(rows.select(*self.keys, *self.values, F.lit(False).alias("__gone")))

    def remove(self, keys: DataFrame) -> None:
        """Forget keys; those not in the store are passed over."""
        nothing = [F.lit(None).cast(self.schema[v].dataType).alias(v) for v in self.values]
        self.waiting.append(keys.select(*self.keys, *nothing, F.lit(True).alias("__gone")))

    def clear(self) -> None:
        self.remove(self.rows())

    def count(self) -> int:
        return self.rows().count()

    def save(self) -> None:
        """Write this micro-batch's run, merge what is due, remove what was merged two micro-batches ago."""
        own = self.schema.names[:-1]
        new = [df.select(*own, F.lit(self.batch).cast("long").alias("__batch")) for df in self.waiting]
        rows = reduce(DataFrame.unionByName, new) if new else self.spark.createDataFrame([], self.schema)
        rows.write.mode("overwrite").parquet(self._path(0, self.batch))
        for level, first in merges_after(self.batch, self.fanout):
            width = self.fanout ** (level - 1)
            merged = self._newest(self._read([(level - 1, first + k * width) for k in range(self.fanout)]), self.batch + 1)
            if first == 0:  # nothing older is left that a removed key could come back from
                merged = merged.where("not __gone")
            merged.write.mode("overwrite").parquet(self._path(level, first))
        for level, first in merges_after(self.batch - 2, self.fanout) if self.batch >= 2 else ():
            for k in range(self.fanout):
                delete(self.spark, self._path(level - 1, first + k * self.fanout ** (level - 1)))
