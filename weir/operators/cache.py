"""Values remembered under an alias and read back by later records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.carry import as_column, carry_last, with_order


def cache_put(df: DataFrame, values: Mapping[str, Column | str], order: Sequence[Column | str], *,
              scope: Sequence[str] = (), when: Column | None = None) -> DataFrame:
    """The cache after all rows: one row per scope with the last value of each alias.

    NULL is stored like any other value, aliases that are blank are ignored.
    """
    rows, names = with_order(df if when is None else df.where(when), order)
    at = F.struct(*names) if len(names) > 1 else F.col(names[0])
    last = [F.max_by(as_column(v), at).alias(k) for k, v in values.items() if k.strip()]
    return rows.groupBy(*scope).agg(*last)


def cache_fetch(df: DataFrame, value: Column | str, order: Sequence[Column | str], *, into: str,
                scope: Sequence[Column | str] = (), when: Column | None = None,
                include_current: bool = True, buckets: int | None = None) -> DataFrame:
    """Add the value cached as of each record.

    Every record writes its value, or only those that satisfy ``when``.
    ``include_current=False`` reads before the record's own write, as a
    predicate does.
    """
    value = as_column(value)
    if include_current and when is None:
        # Each record reads what it has just written.
        return df.withColumn(into, value)
    written = F.struct(value.alias("v"))
    if when is not None:
        written = F.when(when, written)
    out = carry_last(df, {"__cached": written}, order, scope=scope,
                     include_current=include_current, buckets=buckets)
    return out.select(*df.columns, F.col("__cached.v").alias(into))


def cache_asof(readers: DataFrame, writers: DataFrame, value: Column | str, order: Sequence[str], *,
               into: str, scope: Sequence[str] = (), reader_position: int = 1,
               writer_position: int = 0, buckets: int | None = None) -> DataFrame:
    """Add to each reader the last value a writer cached before it.

    Both sides carry the ``order`` and ``scope`` columns. On equal order the
    lower position comes first; a reader at the writer's position or after it
    sees that write.
    """
    shared = [*scope, *order]
    keep = [c for c in readers.columns if c not in shared]
    left = readers.select(*shared, F.struct(*(keep or [F.lit(1).alias("__none")])).alias("__reader"),
                          F.lit(2 * reader_position + 1).alias("__position"))
    right = writers.select(*shared, F.lit(2 * writer_position).alias("__position"),
                           F.struct(as_column(value).alias("v")).alias("__written"))
    both = left.unionByName(right, allowMissingColumns=True)
    out = carry_last(both, {"__cached": F.col("__written")}, [*order, "__position"], scope=scope,
                     buckets=buckets)
    out = out.where(F.col("__reader").isNotNull())
    picked = [F.col(c) if c in shared else F.col(f"__reader.{c}") for c in readers.columns]
    return out.select(*picked, F.col("__cached.v").alias(into))


def cache_check(keys: DataFrame, snapshot: DataFrame, on: Sequence[str]) -> DataFrame:
    """The keys that hold a cached entry."""
    return keys.join(snapshot, list(on), "left_semi")


def cache_remove(snapshot: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """The snapshot without the entries of ``keys``."""
    return snapshot.join(keys.select(*on).distinct(), list(on), "left_anti")


def cache_clear(snapshot: DataFrame) -> DataFrame:
    return snapshot.where(F.lit(False))
