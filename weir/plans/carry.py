"""Ordered running state that splits hot scopes.

``last``/``sum`` over everything before a row is a window per scope, and as
such sorts a whole scope in a single task. Scopes too large for that, found by
a bounded sample, are cut along the order into buckets:

1. per (scope, bucket) the final state is aggregated (map-side combined);
2. a window over that small table, one row per hot scope and bucket, carries
   the state forward into each bucket;
3. each carried state enters its bucket as a first row, and one ordinary window
   runs inside (scope, bucket) for hot and other scopes alike.

Hot scopes and borders are literals in the plan, so a recomputed task puts
every row where it was before. They only balance the work: the result is the
same for any choice of them.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The driver holds at most this many sampled rows per bucket, and this many buckets.
_SAMPLES_PER_BUCKET = 20
_MAX_BUCKETS = 10_000
_LINEAR_LIMIT = 32


def as_column(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def with_order(df: DataFrame, order: Sequence[Column | str], prefix: str = "__order") -> tuple[DataFrame, list[str]]:
    """Add the order as plain columns; timestamps become whole microseconds."""
    names = [f"{prefix}{i}" for i in range(len(order))]
    df = df.withColumns({n: as_column(o) for n, o in zip(names, order)})
    for n in names:
        kind = df.schema[n].dataType
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            df = df.withColumn(n, F.unix_micros(F.col(n).cast("timestamp")))
        elif isinstance(kind, T.DateType):
            df = df.withColumn(n, F.unix_date(n))
    return df, names


def find_split(df: DataFrame, scope: Sequence[str], order: Sequence[str],
               buckets: int) -> tuple[list[int], list[tuple]]:
    """Hashes of the hot scopes, and borders that cut their rows evenly.

    A scope is hot if it fills two of ``buckets`` even parts of all rows.
    Counts the rows and samples scope and order, reading no other columns.
    """
    buckets = min(buckets, _MAX_BUCKETS)
    rows = df.count() if buckets > 1 else 0
    if rows == 0:
        return [], []
    share = min(1.0, _SAMPLES_PER_BUCKET * buckets / rows)
    keys = df.select(scope_hash(scope).alias("__hash"), *order).sample(share, seed=7)
    picked = keys.dropna(subset=list(order)).collect()
    if not picked:
        return [], []
    part = len(picked) / buckets
    sizes = Counter(r[0] for r in picked)
    hot = [h for h, size in sizes.items() if size >= 2 * part]
    sample = sorted(tuple(r[1:]) for r in picked if sizes[r[0]] >= 2 * part)
    cuts = math.ceil(len(sample) / part) if sample else 0
    return hot, sorted({sample[len(sample) * i // cuts] for i in range(1, cuts)})


def scope_hash(scope: Sequence[str]) -> Column:
    # Two scopes of one hash are both split, which changes no result.
    return F.xxhash64(*scope) if scope else F.lit(0).cast("bigint")


def bucket_of(df: DataFrame, order: Sequence[str], points: list[tuple]) -> Column:
    """How many borders lie at or below the row."""
    if not points:
        return F.lit(0)
    kinds = [df.schema[o].dataType for o in order]

    def tuple_of(values: list[Column]) -> Column:
        return values[0] if len(values) == 1 else F.struct(*values)

    key = tuple_of([F.col(o) for o in order])
    borders = [tuple_of([F.lit(v).cast(k).alias(o) for v, k, o in zip(p, kinds, order)]) for p in points]
    if len(borders) <= _LINEAR_LIMIT:
        return sum(((b <= key).cast("int") for b in borders[1:]), (borders[0] <= key).cast("int"))
    # Binary search over the literal array, in descending powers of two.
    table = F.array(*borders)
    steps = [1 << i for i in reversed(range(len(borders).bit_length()))]

    def step(pos: Column, width: Column) -> Column:
        there = pos + width
        fits = (there <= len(borders)) & (F.get(table, there - 1) <= key)
        return F.when(fits, there).otherwise(pos)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step)


def default_buckets(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _run(df, values, order, scope, buckets, tail, carry, inside):
    """Shared body: ``tail`` per bucket, ``carry`` across, ``inside`` per row."""
    columns = df.columns
    df, names = with_order(df.withColumns({f"__of_{n}": v for n, v in values.items()}), order)
    scopes = [f"__scope{i}" for i in range(len(scope))]
    df = df.withColumns({n: as_column(s) for n, s in zip(scopes, scope)})
    hot, points = find_split(df, scopes, names, default_buckets(df) if buckets is None else buckets)
    group, state = [*scopes, "__bucket"], [f"__of_{n}" for n in values]

    bucket = bucket_of(df, names, points)
    split = scope_hash(scopes).isin(hot) if scopes else F.lit(True)
    rows = df.withColumn("__bucket", F.when(split, F.coalesce(bucket, F.lit(0))).otherwise(0) if points else F.lit(0))
    rows = rows.withColumn("__real", F.lit(True))
    if points:
        ends = rows.where(split).groupBy(*group).agg(*[tail(s, names).alias(s) for s in state])
        before = Window.partitionBy(*scopes).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
        heads = ends.select(*group, *[carry(s).over(before).alias(s) for s in state])
        # The carried state enters as a row that sorts before every other one.
        rows = rows.unionByName(heads.where(_any_not_null(state)), allowMissingColumns=True)
    upto = Window.partitionBy(*group).orderBy(F.col("__real").asc_nulls_first(), *names)
    out = rows.select(*columns, "__real", *[inside(f"__of_{n}", upto).alias(n) for n in values])
    return out.where("__real").drop("__real")


def _any_not_null(names: Sequence[str]) -> Column:
    out = F.col(names[0]).isNotNull()
    for n in names[1:]:
        out = out | F.col(n).isNotNull()
    return out


def carry_last(df: DataFrame, values: Mapping[str, Column], order: Sequence[Column | str], *,
               scope: Sequence[Column | str] = (), include_current: bool = True,
               buckets: int | None = None) -> DataFrame:
    """Add, per name, the last non-NULL value up to each row, in ``order`` within ``scope``.

    Wrap a value that may itself be NULL in a struct: a NULL struct means
    "nothing written here", a struct holding NULL means "NULL written". A row
    whose order is NULL lies before all others.
    """
    def tail(state, names):
        return last_written(state, names)

    end = Window.currentRow if include_current else -1
    return _run(
        df, values, order, scope, buckets, tail,
        lambda state: F.last(state, ignorenulls=True),
        lambda state, w: F.last(state, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, end)),
    )


def last_written(state: str, order: Sequence[str]) -> Column:
    """Aggregate: the last non-NULL value. Rows without an order come first."""
    return F.max_by(state, F.when(F.col(state).isNotNull(), F.struct(*order)))


def carry_sum(df: DataFrame, values: Mapping[str, Column], order: Sequence[Column | str], *,
              scope: Sequence[Column | str] = (), buckets: int | None = None) -> DataFrame:
    """Add, per name, the sum over the rows before each row (0 for the first)."""
    return _run(
        df, values, order, scope, buckets,
        lambda state, names: F.sum(state),
        lambda state: F.sum(state),
        lambda state, w: F.coalesce(F.sum(state).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    )


def carry_max(df: DataFrame, values: Mapping[str, Column], order: Sequence[Column | str], *,
              scope: Sequence[Column | str] = (), buckets: int | None = None) -> DataFrame:
    """Add, per name, the greatest value up to and with each row; NULL before the first."""
    return _run(
        df, values, order, scope, buckets,
        lambda state, names: F.max(state),
        lambda state: F.max(state),
        lambda state, w: F.max(state).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
    )
