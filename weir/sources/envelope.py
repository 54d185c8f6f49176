"""From stream envelopes to JSON records: read position, splitting, decompression.

An envelope is ``shard_id, sequence_number, partition_key, arrival_ts, data``.
Any reader that yields these columns serves, for tables and for streams.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .aggregated import AGGREGATED_MAGIC, payloads, varint

ENVELOPE = T.StructType([
    T.StructField("shard_id", T.StringType()),
    T.StructField("sequence_number", T.StringType()),
    T.StructField("partition_key", T.StringType()),
    T.StructField("arrival_ts", T.TimestampType()),
    T.StructField("data", T.BinaryType()),
])


def as_envelope(df: DataFrame, *, shard: Column | str, sequence: Column | str, key: Column | str,
                ts: Column | str, data: Column | str) -> DataFrame:
    """What a stream connector or table yields, as envelopes."""
    given = (shard, sequence, key, ts, data)
    return df.select(*[
        (F.col(c) if isinstance(c, str) else c).cast(field.dataType).alias(field.name)
        for c, field in zip(given, ENVELOPE)
    ])


MODES = ("FAILFAST", "DROPMALFORMED", "PERMISSIVE")

def _check(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    return mode


def _unpack(data: bytes) -> bytes:
    """One snappy block. Its length stands in front, so it is checked before use."""
    size, _ = varint(data, 0, len(data))
    if size > 64 * len(data):
        raise ValueError("declared size is impossible for this input")
    return pa.Codec("snappy").decompress(data, decompressed_size=size, asbytes=True)


def _mapped(step, returns: T.DataType, arrow_type: pa.DataType, mode: str):
    """``step`` over Arrow batches of binary values; what fails is NULL or an error."""
    strict = mode == "FAILFAST"

    @F.arrow_udf(returns)
    def run(values: pa.Array) -> pa.Array:
        out = []
        for value in values:
            data = value.as_py()
            try:
                out.append(None if data is None else step(data))
            except (ValueError, IndexError, pa.ArrowException, OSError):
                if strict:
                    raise
                out.append(None)
        return pa.array(out, arrow_type)

    return run


def deaggregate(df: DataFrame, data: str = "data", mode: str = "FAILFAST") -> DataFrame:
    """Aggregated records as one row per payload; other rows pass unchanged.

    Adds ``sub_seq``, the position inside the record. The parent's envelope is
    kept, the digest is not verified. Only aggregated rows reach Python.
    """
    _check(mode)
    strict = mode == "FAILFAST"

    @F.arrow_udf(T.ArrayType(T.BinaryType()))
    def split(values: pa.Array) -> pa.Array:
        return payloads(values, strict)

    packed = F.substring(data, 1, len(AGGREGATED_MAGIC)) == F.lit(AGGREGATED_MAGIC)
    parts = F.when(packed, split(F.when(packed, F.col(data)))).otherwise(F.array(data))
    if mode == "PERMISSIVE":
        parts = F.coalesce(parts, F.array(F.lit(None).cast("binary")))
    rest = [c for c in df.columns if c != data]
    out = df.select(*rest, F.posexplode(parts).alias("sub_seq", data))
    return out.select(*df.columns, "sub_seq")


def decode_snappy(df: DataFrame, data: str = "data", into: str = "record", mode: str = "FAILFAST") -> DataFrame:
    """Replace compressed ``data`` by the record text it holds."""
    _check(mode)
    plain = _mapped(_unpack, T.BinaryType(), pa.binary(), mode)
    out = df.withColumn(into, plain(F.col(data)).cast("string"))
    if into != data:
        out = out.drop(data)
    return out.where(F.col(into).isNotNull()) if mode == "DROPMALFORMED" else out


def drop_empty(df: DataFrame, record: str = "record") -> DataFrame:
    return df.where(F.length(record) > 0)


def invalid_records(df: DataFrame, record: str = "record") -> DataFrame:
    """Records that are no JSON: every path of theirs is absent. For a quarantine."""
    return df.where(F.try_parse_json(record).isNull())


def sequence_key(sequence: Column | str) -> Column:
    """Orders opaque decimal sequence texts of any length."""
    text = F.col(sequence) if isinstance(sequence, str) else sequence
    return F.struct(F.length(text).alias("digits"), text.alias("text"))


def tail_positions(df: DataFrame, shard: str = "shard_id", sequence: str = "sequence_number") -> DataFrame:
    """The newest sequence number of every shard."""
    return df.groupBy(shard).agg(F.max(sequence_key(sequence))["text"].alias(sequence))


def from_position(df: DataFrame, mode: str, positions: DataFrame | None = None, *,
                  shard: str = "shard_id", sequence: str = "sequence_number") -> DataFrame:
    """The part of a bounded table a reader starting at ``mode`` would get.

    ``TRIM_HORIZON`` is everything, ``LATEST`` nothing, ``AT`` and ``AFTER``
    start at or after the position of each shard; a shard without one is read
    from its beginning. A stream keeps its position in its own checkpoint.
    """
    if mode == "TRIM_HORIZON":
        return df
    if mode == "LATEST":
        return df.where(F.lit(False))
    if mode not in ("AT", "AFTER") or positions is None:
        raise ValueError("mode must be TRIM_HORIZON, LATEST, or AT / AFTER with positions")
    start = positions.select(F.col(shard), F.col(sequence).alias("__start"))
    here, there = sequence_key(sequence), sequence_key("__start")
    reached = here >= there if mode == "AT" else here > there
    joined = df.join(start, shard, "left")
    return joined.where(F.col("__start").isNull() | reached).select(*df.columns)
