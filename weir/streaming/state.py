"""First-seen tests and caches across the micro-batches of a stream.

Each micro-batch goes through the operators for tables, together with what a :class:`~weir.streaming.store.KeyStore` holds for
its keys. So every row comes out once, order does not depend on how rows are cut into tasks or Arrow batches, and keys or
scopes with very many rows are split as they are there.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.unique import copy_number, first_rows, with_row_key
from ..plans.carry import as_column, carry_last, last_written
from .store import KeyStore, delete

Sink = Callable[[DataFrame, int], None] | str


def deliver(rows: DataFrame, batch: int, sink: Sink) -> None:
    """Hand over a micro-batch's rows; a path gets them as a Parquet folder ``batch=n``, overwritten if repeated."""
    if callable(sink):
        sink(rows, batch)
    else:
        rows.write.mode("overwrite").parquet(f"{sink}/batch={batch}")


def _start(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, every: str | None) -> StreamingQuery:
    out = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (out.trigger(availableNow=True) if every is None else out.trigger(processingTime=every)).start()


def stream_unique(stream: DataFrame, keys: Sequence[str], order: Sequence[Column | str], checkpoint: str, sink: Sink, *,
                  remember: int | None, into: str = "first_seen", every: str | None = None) -> StreamingQuery:
    """Add ``"true"`` to the first row of a key, ``"false"`` to later ones; every row comes out, late ones too.

    An earlier micro-batch comes first, within one ``order`` decides; ties and rows without an order go as in
    :func:`weir.unique_flag`. A null is a key like any other. ``remember`` says for how many micro-batches a key counts as
    seen after its first row; ``None`` is for ever. It bounds the state and has no default on purpose.
    """
    keys = list(keys)

    def step(batch: DataFrame, number: int) -> None:
        columns = batch.columns
        rows = with_row_key(batch, order)
        firsts, names = first_rows(rows, keys)
        store = KeyStore(batch.sparkSession, f"{checkpoint}/seen", [T.StructField(n, batch.schema[k].dataType)
                                                                   for n, k in zip(names, keys)], [], number, remember=remember)
        new = store.unknown(firsts, names).persist()
        try:
            marked = (rows.join(new.select("__at", F.lit(True).alias("__hit")), "__at", "left")
                      .withColumn("__copy", copy_number()))
            flag = F.when(F.col("__hit") & (F.col("__copy") == 1), "true").otherwise("false")
            deliver(marked.select(*[F.col(f"`{c}`") for c in columns if c != into], flag.alias(into)), number, sink)
            store.put(new)
            store.save()
        finally:
            new.unpersist()

    return _start(stream, step, checkpoint, every)


class StreamCache:
    """Gives each row the value its predecessor in the scope has cached, across micro-batches.

    Without ``delay`` what comes in a later micro-batch is later, and ``order`` decides within one. With it, rows wait until
    the newest time in ``ts`` is ``delay`` (such as ``"6 hours"``) past theirs, and come out in the order of ``ts``, then
    ``order``, however they were mixed up on the way. A row that comes later still gets the value cached when it comes and
    caches none. Every row comes out once; rows without a time do not wait. Null is a scope, and a value, like any other.
    """

    def __init__(self, value: str, scope: Sequence[str], order: Sequence[str], checkpoint: str, *, into: str,
                 ts: str | None = None, delay: str | None = None):
        if (ts is None) != (delay is None):
            raise ValueError("ts and delay belong together")
        self.value, self.scope, self.checkpoint, self.into, self.ts, self.delay = value, list(scope), checkpoint, into, ts, delay
        self.order = list(order) if ts is None else [ts, *order]

    def start(self, stream: DataFrame, sink: Sink, every: str | None = None) -> StreamingQuery:
        return _start(stream, lambda batch, number: self._step(batch, number, sink), self.checkpoint, every)

    def flush(self, spark: SparkSession, schema: T.StructType, sink: Sink) -> None:
        """Once the stream has ended: let the rows that still wait come out, as one more micro-batch."""
        after = spark.read.schema("border timestamp, batch long").parquet(f"{self.checkpoint}/border").agg(F.max("batch")).first()[0]
        self._release(self._held(spark, schema, after + 1), None, after + 1, sink)

    def _held(self, spark: SparkSession, schema: T.StructType, number: int) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{self.checkpoint}/held/batch={number - 1}") if number else (
            spark.createDataFrame([], schema))

    def _border(self, spark: SparkSession, number: int):
        """Up to which time rows had come out before this micro-batch."""
        if not number:
            return None
        return spark.read.schema("border timestamp").parquet(f"{self.checkpoint}/border/batch={number - 1}").first()["border"]

    def _step(self, batch: DataFrame, number: int, sink: Sink) -> None:
        if self.ts is None:
            return self._release(batch, None, number, sink)
        spark, time = batch.sparkSession, F.col(self.ts).cast("timestamp")
        past = self._border(spark, number)
        newest = batch.agg((F.max(time) - F.expr(f"interval {self.delay}")).alias("border")).first()["border"]
        border = max((b for b in (past, newest) if b is not None), default=None)
        spark.createDataFrame([(border,)], "border timestamp").write.mode("overwrite").parquet(f"{self.checkpoint}/border/batch={number}")
        rows = batch.unionByName(self._held(spark, batch.schema, number))
        ready = time.isNull() | (time <= F.lit(border)) if border is not None else time.isNull()
        rows.where(~ready).write.mode("overwrite").parquet(f"{self.checkpoint}/held/batch={number}")
        if number >= 2:
            delete(spark, f"{self.checkpoint}/held/batch={number - 2}")
        self._release(rows.where(ready), past, number, sink)

    def _release(self, ready: DataFrame, past, number: int, sink: Sink) -> None:
        columns = [F.col(f"`{c}`") for c in ready.columns if c != self.into]
        scopes = [f"__in{i}" for i in range(len(self.scope))]
        rows = with_row_key(ready, self.order).withColumns({n: F.col(s) for n, s in zip(scopes, self.scope)})
        rows = rows.withColumn("__written", F.struct(as_column(self.value).alias("v")))
        late = F.col(self.ts).cast("timestamp") <= F.lit(past) if past is not None else F.lit(False)
        late = F.coalesce(late, F.lit(False))
        store = KeyStore(ready.sparkSession, f"{self.checkpoint}/cached", [rows.schema[s] for s in scopes],
                         [rows.schema["__written"]], number)
        known = store.lookup(rows.select(*scopes).distinct()) if scopes else store.rows()
        cached = known.persist()
        try:
            timely = rows.where(~late).withColumn("__row", F.lit(True)).unionByName(cached, allowMissingColumns=True)
            at = [F.col("__at")[f] for f in rows.schema["__at"].dataType.names]
            placed = carry_last(timely, {"__before": F.col("__written")}, at, scope=scopes, include_current=False).where("__row")
            out = placed.select(*columns, F.col("__before.v").alias(self.into))
            if past is not None:
                same = F.lit(True)
                for s in scopes:
                    same = same & rows[s].eqNullSafe(cached[s])
                behind = rows.where(late).drop("__written").join(cached, same, "left")
                out = out.unionByName(behind.select(*columns, F.col("__written.v").alias(self.into)))
            deliver(out, number, sink)
            store.put(timely.groupBy(*scopes).agg(last_written("__written", ["__at"]).alias("__written"))
                      .where(F.col("__written").isNotNull()))
            store.save()
        finally:
            cached.unpersist()


def stream_cache(stream: DataFrame, value: str, scope: Sequence[str], order: Sequence[str], checkpoint: str, sink: Sink, *,
                 into: str, ts: str | None = None, delay: str | None = None, every: str | None = None) -> StreamingQuery:
    """Start a :class:`StreamCache` on a stream."""
    return StreamCache(value, scope, order, checkpoint, into=into, ts=ts, delay=delay).start(stream, sink, every)
