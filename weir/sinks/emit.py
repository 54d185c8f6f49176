"""Outbound stream records: a random partition key and gzip bytes."""

from __future__ import annotations

import gzip

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.arrow_udf(T.BinaryType())
def gzip_bytes(values: pa.Array) -> pa.Array:
    packed = [None if v is None else gzip.compress(v, mtime=0) for v in values.to_pylist()]
    return pa.array(packed, pa.binary())


def emit_envelope(df: DataFrame, outbound: str = "outbound") -> DataFrame:
    """Replace the outbound text by ``partition_key`` and compressed ``data``."""
    kept = [c for c in df.columns if c != outbound]
    return df.select(*kept, F.uuid().alias("partition_key"),
                     gzip_bytes(F.encode(outbound, "UTF-8")).alias("data"))
