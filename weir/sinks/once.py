"""Files that each micro-batch adds exactly once.

Tasks write files under names of their own and report them. The commit of a micro-batch lists them in a manifest, which alone
makes them visible; a micro-batch that already has its manifest is not added again, and files of failed or repeated attempts
are removed. Streams use the format directly (``writeStream.format("weir_once")``), sinks of rules through :func:`write_once`.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage,
)

from ..sources.shards import names_in, read_json, store_of, write_json

ROWS_PER_FILE = 1_000_000


@dataclass
class Written(WriterCommitMessage):
    """The files one task has written, and their rows."""

    files: list[tuple[str, int]]


class _Files:
    """What batch and stream writers share."""

    def __init__(self, options: Mapping[str, str]):
        self.path = options["path"].rstrip("/")
        self.query = options.get("query", "default")
        self.rows_per_file = int(options.get("rows_per_file", ROWS_PER_FILE))
        self.compression = options.get("compression", "zstd")

    def write(self, iterator) -> Written:
        import pyarrow.parquet as pq

        store, root = store_of(self.path)
        store.create_dir(f"{root}/data", recursive=True)
        files: list[tuple[str, int]] = []
        writer, rows = None, 0
        try:
            for batch in iterator:
                if writer is None and len(batch):
                    name, rows = f"data/{uuid.uuid4().hex}.parquet", 0
                    files.append((name, 0))
                    writer = pq.ParquetWriter(f"{root}/{name}", batch.schema, filesystem=store, compression=self.compression)
                if len(batch):
                    writer.write_batch(batch)
                    rows += len(batch)
                    files[-1] = (files[-1][0], rows)
                if rows >= self.rows_per_file:
                    writer.close()
                    writer, rows = None, 0
            if writer is not None:
                writer.close()
        except BaseException:
            self.remove(name for name, _ in files)
            raise
        return Written(files)

    def remove(self, names: Iterable[str]) -> None:
        store, root = store_of(self.path)
        for name in names:
            try:
                store.delete_file(f"{root}/{name}")
            except FileNotFoundError:
                pass

    def add(self, messages: list, batch: int) -> None:
        files = [f for m in messages if m is not None for f in m.files]
        folder, name = f"{self.path}/batches/{self.query}", f"{batch:012d}.json"
        if read_json(folder, name) is not None:
            self.remove(name for name, _ in files)  # this micro-batch has been added before
        else:
            write_json(folder, name, [{"file": f, "rows": n} for f, n in files])

    def drop(self, messages: list) -> None:
        self.remove(name for m in messages if m is not None for name, _ in m.files)


class OnceStreamWriter(_Files, DataSourceStreamArrowWriter):
    def commit(self, messages, batchId: int) -> None:
        self.add(messages, batchId)

    def abort(self, messages, batchId: int) -> None:
        self.drop(messages)


class OnceWriter(_Files, DataSourceArrowWriter):
    def __init__(self, options: Mapping[str, str]):
        super().__init__(options)
        self.batch = int(options["batch"])

    def commit(self, messages) -> None:
        self.add(messages, self.batch)

    def abort(self, messages) -> None:
        self.drop(messages)


class OnceSink(DataSource):
    """The format ``weir_once``. Options: ``path``; ``query``, a name for each query that writes there; ``batch``, for tables."""

    @classmethod
    def name(cls) -> str:
        return "weir_once"

    def writer(self, schema, overwrite: bool) -> OnceWriter:
        return OnceWriter(self.options)

    def streamWriter(self, schema, overwrite: bool) -> OnceStreamWriter:
        return OnceStreamWriter(self.options)


def write_once(df: DataFrame, path: str, batch: int, *, query: str = "default", **options) -> None:
    """Add the rows as one micro-batch; a micro-batch of that number that is there already stays as it is."""
    df.sparkSession.dataSource.register(OnceSink)
    (df.write.format("weir_once").options(path=path, query=query, batch=str(batch), **{k: str(v) for k, v in options.items()})
     .mode("append").save())


def read_once(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of all micro-batches that have been committed, with columns of the given schema."""
    files = []
    store, root = store_of(path.rstrip("/"))
    from pyarrow import fs

    for query in store.get_file_info(fs.FileSelector(f"{root}/batches", allow_not_found=True)):
        for name in names_in(f"{path}/batches/{query.base_name}"):
            files += [f"{path}/{f['file']}" for f in read_json(f"{path}/batches/{query.base_name}", name)]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
