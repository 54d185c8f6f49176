"""Many folders written in one pass over the rows.

One job reads the rows once, and each task hands every row to the file of its own folder. Tasks report the files they wrote;
each folder then gets its own manifest, as in :mod:`weir.sinks.once`, and is read by ``read_once``. A folder that cannot be
written to fails alone: its files are removed, all others are added.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shards import read_json, store_of, write_json
from .once import ROWS_PER_FILE

HELD_BYTES = 64 << 20  # that a task holds for all its folders before it writes
OPEN_FILES = 64  # of a task; the file written to longest ago is closed for another
REPORT = "target int, file string, rows long, error string"


class _Folder:
    """One task's files of one folder."""

    def __init__(self, path: str, compression: str):
        self.path, self.compression = path, compression
        self.held, self.bytes = [], 0
        self.files: list[list] = []
        self.writer = None
        self.error: str | None = None

    def add(self, rows) -> None:
        self.held.append(rows)
        self.bytes += rows.nbytes

    def flush(self) -> None:
        import pyarrow as pa
        import pyarrow.parquet as pq

        if not self.held:
            return
        table = pa.Table.from_batches(self.held)
        self.held, self.bytes = [], 0
        if self.writer is None:
            store, root = store_of(self.path)
            store.create_dir(f"{root}/data", recursive=True)
            self.files.append([f"data/{uuid.uuid4().hex}.parquet", 0])
            self.writer = pq.ParquetWriter(f"{root}/{self.files[-1][0]}", table.schema, filesystem=store,
                                           compression=self.compression)
        self.writer.write_table(table)
        self.files[-1][1] += len(table)

    def close(self) -> None:
        writer, self.writer = self.writer, None
        if writer is not None:
            writer.close()

    def drop(self) -> None:
        """Leave nothing behind of what this task wrote."""
        self.held, self.bytes = [], 0
        try:
            self.close()
        except Exception:
            pass  # the file goes anyway
        _remove(self.path, [name for name, _ in self.files])
        self.files = []


def _remove(path: str, names: Iterable[str]) -> None:
    store, root = store_of(path)
    for name in names:
        try:
            store.delete_file(f"{root}/{name}")
        except OSError:
            pass  # no manifest names it, so nobody reads it


def _task(paths: Mapping[int, str], target: str, rows_per_file: int, compression: str) -> Callable:
    def write(batches):
        import numpy as np
        import pyarrow as pa

        folders: dict[int, _Folder] = {}
        opened: dict[int, None] = {}  # in the order of their last writes

        def attempt(number: int, *steps) -> None:
            """Steps for a folder; if one fails the folder has failed, and the others go on."""
            folder = folders[number]
            try:
                for step in steps:
                    step()
            except (OSError, pa.ArrowException) as error:
                folder.error = f"{type(error).__name__}: {error}"
                opened.pop(number, None)
                folder.drop()

        def flush(number: int) -> None:
            folder = folders[number]
            opened.pop(number, None)
            while len(opened) >= OPEN_FILES:
                oldest = next(iter(opened))
                del opened[oldest]
                attempt(oldest, folders[oldest].close)
            opened[number] = None
            attempt(number, folder.flush)
            if folder.error is None and folder.files[-1][1] >= rows_per_file:
                del opened[number]
                attempt(number, folder.close)

        try:
            for batch in batches:
                numbers = batch.column(target).to_numpy(zero_copy_only=False)
                body = batch.drop_columns([target])
                order = np.argsort(numbers, kind="stable")
                for part in np.split(order, np.flatnonzero(np.diff(numbers[order])) + 1):
                    if not len(part):
                        continue
                    number = int(numbers[part[0]])
                    folder = folders.get(number)
                    if folder is None:
                        folder = folders[number] = _Folder(paths[number], compression)
                    if folder.error is None:
                        folder.add(body.take(pa.array(part)))  # a copy: a slice would keep the whole batch
                while sum(f.bytes for f in folders.values()) > HELD_BYTES:
                    flush(max(folders, key=lambda n: folders[n].bytes))
            for number, folder in folders.items():
                if folder.held:
                    flush(number)
                if folder.error is None:
                    attempt(number, folder.close)
        except BaseException:
            for folder in folders.values():
                folder.drop()
            raise
        report = [(n, f, c, None) for n, x in folders.items() for f, c in x.files]
        report += [(n, None, 0, x.error) for n, x in folders.items() if x.error is not None]
        columns = list(zip(*report, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.string(), pa.int64(), pa.string()), strict=True)],
            names=["target", "file", "rows", "error"])

    return write


def write_each(rows: DataFrame, paths: Mapping[int, str], batch: int, *, target: str = "target", query: str = "default",
               rows_per_file: int = ROWS_PER_FILE, compression: str = "zstd") -> dict[int, str]:
    """Add the rows as micro-batch ``batch`` of the folders their ``target`` numbers name; return the errors of folders that failed.

    A folder that has the micro-batch already stays as it is, so after a failure only what failed is written again. A
    folder without rows gets an empty micro-batch. Rows whose ``target`` is NULL or no key of ``paths`` raise an error. The
    column ``target`` is not written. Nothing is shuffled: each task writes a file, or a few, for each folder it has rows of.
    The names of the files pass the driver.
    """
    name = f"{batch:012d}.json"
    failed: dict[int, str] = {}
    files: dict[int, list[dict]] = {}

    def each(step: Callable[[int], None], numbers: Iterable[int]) -> None:
        def guarded(number: int) -> None:
            try:
                step(number)
            except OSError as error:
                failed[number] = f"{type(error).__name__}: {error}"

        with ThreadPoolExecutor(16) as pool:
            list(pool.map(guarded, list(numbers)))

    def look(number: int) -> None:
        if read_json(f"{paths[number]}/batches/{query}", name) is None:
            files[number] = []

    def add(number: int) -> None:
        write_json(f"{paths[number]}/batches/{query}", name, files[number])

    each(look, paths)
    if not files:
        return failed
    number = F.col(target).cast("int")
    known = F.coalesce(number.isin(list(paths)), F.lit(False))
    checked = F.when(known, number).otherwise(F.raise_error(F.lit("a row has no folder to go to")).cast("int"))
    rows = rows.withColumn(target, checked)
    if len(files) < len(paths):
        rows = rows.where(F.col(target).isin(list(files)))
    task = _task({n: paths[n] for n in files}, target, rows_per_file, compression)
    for r in rows.mapInArrow(task, REPORT).collect():
        if r["error"] is not None:
            failed.setdefault(r["target"], r["error"])
        else:
            files[r["target"]].append({"file": r["file"], "rows": r["rows"]})
    each(add, [n for n in files if n not in failed])
    for number in failed.keys() & files.keys():
        _remove(paths[number], [f["file"] for f in files[number]])
    return failed
