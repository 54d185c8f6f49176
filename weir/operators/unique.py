"""First-seen tests and the table of keys seen so far. All of them are exact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.carry import as_column, with_order


def with_row_key(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Add ``__at``: the order of a row and a hash of all its columns. Only equal rows share it; nulls compare equal."""
    plain = [F.col(f"`{f.name}`") if _hashable(f.dataType) else F.to_json(F.struct(F.col(f"`{f.name}`"))) for f in df.schema]
    ordered, names = with_order(df.withColumn("__hash", F.xxhash64(*plain)), order)
    return ordered.withColumn("__at", F.struct(*names, "__hash")).drop(*names, "__hash")


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind)
    return not isinstance(kind, (T.MapType, T.VariantType))


def first_rows(df: DataFrame, keys: Sequence[Column | str], given: Column | None = None) -> tuple[DataFrame, list[str]]:
    """Key columns and ``__at`` of the first row of every key, and the names of the key columns.

    Partial aggregation keeps a hot key from reaching one task row by row. The
    keys stay separate columns: ("a-b", "c") and ("a", "b-c") are two keys.
    """
    if not keys:
        raise ValueError("a first-seen test needs at least one key")
    if given is not None:
        df = df.where(given)
    key_names = [f"__key{i}" for i in range(len(keys))]
    grouped = df.select(*[as_column(k).alias(n) for k, n in zip(keys, key_names)], "__at").groupBy(*key_names)
    # A key seen only without an order has a first row too: null comes before all else.
    return grouped.agg(F.min("__at").alias("__at")), key_names


def copy_number() -> Column:
    """1, 2, ... among equal rows, which alone share ``__at``. After a join by ``__at`` it needs no further shuffle."""
    return F.row_number().over(Window.partitionBy("__at").orderBy("__at"))


def _with_firsts(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column | str], given: Column | None,
                 how: str) -> DataFrame:
    """The rows joined with the first rows by ``__at``, of which there is one per key."""
    rows = with_row_key(df, order)
    firsts, _ = first_rows(rows, keys, given)
    return rows.join(firsts.select("__at", F.lit(True).alias("__hit")), "__at", how).withColumn("__copy", copy_number())


def unique_flag(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column | str], *,
                into: str = "first_seen", given: Column | None = None) -> DataFrame:
    """Add ``"true"`` on the first row of a key, ``"false"`` on later ones; every row comes out once.

    One row of a key is first: among rows that share its first order the choice follows a hash of the whole row, among
    equal rows any of them is taken. Rows without an order come before all others. Rows are matched to the first rows by
    order and hash, so a hot key spreads over all partitions; only equal rows meet. With ``given``, only rows that satisfy
    it count as seen.
    """
    flag = F.when(F.col("__hit") & (F.col("__copy") == 1), "true").otherwise("false")
    return _with_firsts(df, keys, order, given, "left").select(*_names(df), flag.alias(into))


def unique_filter(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column | str]) -> DataFrame:
    """Only the first row of every key, one per key; chosen as by :func:`unique_flag`."""
    return _with_firsts(df, keys, order, None, "left_semi").where("__copy = 1").select(*_names(df))


def _names(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]


def seen_add(seen: DataFrame, new: DataFrame) -> DataFrame:
    """The seen keys with the keys of ``new`` added, each once."""
    return seen.select(*seen.columns).union(new.select(*seen.columns)).distinct()


def same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    conditions = [left[k].eqNullSafe(right[k]) for k in keys]
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def seen_lookup(df: DataFrame, seen: DataFrame) -> DataFrame:
    """The rows of ``df`` whose key is in the seen table."""
    seen = seen.distinct()
    return df.join(seen, same_key(df, seen, seen.columns), "left_semi")


def seen_remove(seen: DataFrame, gone: DataFrame) -> DataFrame:
    """The seen table without the keys of ``gone``."""
    # Copies of a hot key are merged before they are shuffled.
    gone = gone.select(*seen.columns).distinct()
    return seen.join(gone, same_key(seen, gone, seen.columns), "left_anti")


def seen_count(seen: DataFrame) -> DataFrame:
    return seen.agg(F.count("*").alias("keys"))


def seen_clear(seen: DataFrame) -> DataFrame:
    """An empty seen table with the same keys."""
    return seen.where(F.lit(False))


def key_hash(*keys: Column | str) -> Column:
    """A hash to spread keys over buckets; never a stand-in for the key."""
    return F.xxhash64(*keys)
