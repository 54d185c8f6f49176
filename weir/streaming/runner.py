"""Running a ruleset on a stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.route import keeps_state, route, split_errors
from ..plans.rules import RuleSet
from ..sinks.registry import one_pass, publish
from .counts import Counts
from .memory import Memory

_UNSET = object()


def run_router(stream: DataFrame, ruleset: RuleSet, checkpoint: str, *, record: str = "record",
               keep: Sequence[str] | None = None, scope: Sequence[str] = (),
               order: Sequence[Column | str] = (), remember: int | None | object = _UNSET,
               every: str | None = None, after: Callable[[DataFrame, int], None] | None = None,
               errors: str | None = None, counts: str | None = None, ts: str | None = None) -> StreamingQuery:
    """Route each micro-batch and publish it; then let the stream move on.

    Offsets are committed only after every sink whose rule has the checkpoint
    flag has succeeded, so a failure there repeats the micro-batch. ``after``
    gets the source rows of each published micro-batch, e.g. to commit a
    progress table. Without ``every`` the stream takes what is there and ends.

    Rules that keep state need ``order``, and ``remember``: for how many
    micro-batches after its first sight a key is remembered (``None`` for
    ever). It bounds the state and has no default on purpose.

    ``errors`` is a folder for records that rules failed for, as Parquet with the rule, the reason and the record, one
    folder per micro-batch; a repeated micro-batch overwrites its own. They are written before anything is published.

    ``counts`` is a folder for what each micro-batch counted, see :mod:`weir.streaming.counts`; ``ts`` is the column of
    arrival times for the lag. Filters of rules are not pushed below the counts, which take in every record.
    """
    stateful = keeps_state(ruleset, record)
    if stateful and (remember is _UNSET or not order):
        raise ValueError("rules that keep state need order and remember")

    def send(routed: DataFrame, batch_id: int, counted: Counts | None) -> None:
        if counted is not None:
            routed = counted.matches(routed)
        if errors is None and (counted is None or one_pass(ruleset)):
            lost = publish(routed, ruleset, batch_id)
        else:
            routed = routed.persist()
            try:
                matches = routed
                if errors is not None:
                    matches, failed = split_errors(routed)
                    failed.write.mode("overwrite").parquet(f"{errors}/b{batch_id}")
                else:
                    routed.write.format("noop").mode("overwrite").save()  # counts, and fills what is kept
                lost = publish(matches, ruleset, batch_id)
            finally:
                routed.unpersist()
        if counted is not None:
            counted.save(lost)

    def run(batch: DataFrame, batch_id: int, counted: Counts | None) -> None:
        if not stateful:
            taken = batch if counted is None else counted.records(batch)
            send(route(taken, ruleset, record=record, keep=keep, errors=errors is not None), batch_id, counted)
        else:
            batch = batch.persist()
            try:
                if counted is not None:
                    counted.records(batch, kept=True)
                memory = Memory(batch.sparkSession, f"{checkpoint}/memory", batch_id, remember)
                routed = route(batch, ruleset, record=record, keep=keep, scope=scope, order=order, memory=memory,
                               errors=errors is not None)
                send(routed, batch_id, counted)
                memory.save()
            finally:
                batch.unpersist()
        if after is not None:
            after(batch, batch_id)

    def handle(batch: DataFrame, batch_id: int) -> None:
        counted = None if counts is None else Counts(counts, batch_id, record, ts)
        try:
            run(batch, batch_id, counted)
        except Exception as error:
            if counted is not None:
                counted.failed(error)
            raise

    out = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    out = out.trigger(availableNow=True) if every is None else out.trigger(processingTime=every)
    return out.start()
