"""A stream of shards kept as files, with positions per shard.

Records are appended in segments: Parquet files in the order of shard and sequence number, and one log entry per append that
lists, for each file and shard, its first and last sequence number and its rows. A segment counts once its entry is there, so
an append that fails half way leaves nothing to read. A reader's offset is the last sequence number per shard. Each
micro-batch takes whole segments, as many as its limit of records allows, and reads them in tasks of bounded size: a shard
with much to read spreads over several.

Appending is for one writer at a time. Sequence numbers are decimal texts and grow within a shard.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from .envelope import ENVELOPE, sequence_key

SEGMENT_RECORDS = 100_000
TASK_RECORDS = 100_000
READ_ROWS = 10_000
STARTS = ("TRIM_HORIZON", "LATEST", "AT", "AFTER")


def store_of(folder: str):
    """The file system of a folder, and the folder's path there."""
    from pyarrow import fs

    if folder.startswith("file:"):
        folder = "/" + folder.removeprefix("file:").lstrip("/")
    return (fs.LocalFileSystem(), folder) if "://" not in folder else fs.FileSystem.from_uri(folder)


def read_json(folder: str, name: str):
    """The content of a small file, or None."""
    store, root = store_of(folder)
    try:
        with store.open_input_stream(f"{root}/{name}") as file:
            return json.loads(file.read())
    except FileNotFoundError:
        return None


def write_json(folder: str, name: str, content) -> None:
    """A small file that is there whole or not at all."""
    store, root = store_of(folder)
    store.create_dir(f"{root}/{name}".rpartition("/")[0], recursive=True)
    part = f"{root}/{name}.{uuid.uuid4().hex}.part"
    with store.open_output_stream(part) as file:
        file.write(json.dumps(content).encode())
    store.move(part, f"{root}/{name}")


def names_in(folder: str) -> list[str]:
    """The whole small files of a folder, in order."""
    from pyarrow import fs

    store, root = store_of(folder)
    found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return sorted(i.base_name for i in found if i.base_name.endswith(".json"))


def order_of(sequence: str) -> tuple[int, str]:
    return len(sequence), sequence


class SegmentLog:
    """The entries of a shard log; each is read once."""

    def __init__(self, folder: str):
        self.folder, self.entries = folder, {}

    def segments(self) -> list[dict]:
        """All segments, in the order they were appended, then by shard and sequence number."""
        for name in names_in(f"{self.folder}/log"):
            if name not in self.entries:
                self.entries[name] = read_json(f"{self.folder}/log", name)
        return [s for name in sorted(self.entries) for s in self.entries[name]]

    def tails(self) -> dict[str, str]:
        """The last sequence number of each shard."""
        out: dict[str, str] = {}
        for s in self.segments():
            out[s["shard"]] = max(out.get(s["shard"], "0"), s["last"], key=order_of)
        return out


def append_records(envelopes: DataFrame, folder: str, *, segment_records: int = SEGMENT_RECORDS) -> int:
    """Append envelopes to a shard log; returns how many segments there are more.

    A shard's new records must come after those it has. Records without a shard or sequence number are refused. What passes
    through the driver is one row per file and shard.
    """
    spark, log = envelopes.sparkSession, SegmentLog(folder)
    number = len(log.segments() and log.entries)
    data = f"data/{number:012d}-{uuid.uuid4().hex}"
    key = sequence_key("sequence_number")
    order = ["shard_id", key["digits"], key["text"]]
    (envelopes.select(*ENVELOPE.names).repartitionByRange(*order).sortWithinPartitions(*order)
     .write.option("maxRecordsPerFile", segment_records).parquet(f"{folder}/{data}"))
    written = spark.read.schema(ENVELOPE).parquet(f"{folder}/{data}")
    found = (written.groupBy(F.col("_metadata.file_name").alias("file"), "shard_id")
             .agg(F.min(key)["text"].alias("first"), F.max(key)["text"].alias("last"),
                  F.min("_metadata.row_index").alias("at"), F.count("*").alias("rows"),
                  F.count("sequence_number").alias("numbered")).collect())
    if any(r["shard_id"] is None or r["numbered"] < r["rows"] for r in found):
        raise ValueError("every record needs a shard and a sequence number")
    tails = log.tails()
    behind = sorted({r["shard_id"] for r in found if r["shard_id"] in tails and order_of(r["first"]) <= order_of(tails[r["shard_id"]])})
    if behind:
        raise ValueError(f"records of {behind} do not come after those that are there")
    entry = sorted(({"file": f"{data}/{r['file']}", "shard": r["shard_id"], "first": r["first"], "last": r["last"],
                     "at": r["at"], "rows": r["rows"]} for r in found), key=lambda s: (s["shard"], order_of(s["first"])))
    if entry:
        write_json(f"{folder}/log", f"{number:012d}.json", entry)
    return len(entry)


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All records appended so far, as a table."""
    files = sorted({f"{folder}/{s['file']}" for s in SegmentLog(folder).segments()})
    return spark.read.schema(ENVELOPE).parquet(*files) if files else spark.createDataFrame([], ENVELOPE)


class _Part(InputPartition):
    """Rows of one shard in one file, between two positions."""

    def __init__(self, file: str, at: int, rows: int, after: dict | None, upto: str | None):
        self.file, self.at, self.rows, self.after, self.upto = file, at, rows, after, upto


def _passed(position: dict | None, sequence: str) -> bool:
    """Whether a reader at this position has the record behind it."""
    if position is None:
        return False
    here, there = order_of(sequence), order_of(position["sequence"])
    return here < there if position["inclusive"] else here <= there


class ShardReader(DataSourceStreamReader):
    """Offsets are ``{shard: {"sequence": text, "inclusive": whether the next record may be that one}}``."""

    def __init__(self, options: Mapping[str, str]):
        self.folder, self.start = options["path"], options.get("start", "TRIM_HORIZON")
        self.positions = json.loads(options.get("positions", "{}"))
        self.limit = int(options["records"]) if "records" in options else None
        self.progress = options.get("progress")
        self.log, self.given = SegmentLog(self.folder), None

    def initialOffset(self) -> dict:
        if self.start == "LATEST":
            found, inclusive = self.log.tails(), False
        else:
            found, inclusive = (self.positions if self.start in ("AT", "AFTER") else {}), self.start == "AT"
        self.given = {shard: {"sequence": s, "inclusive": inclusive} for shard, s in found.items()}
        return self.given

    def latestOffset(self) -> dict:
        # Spark does not say where it stands: that is what was handed out last, or, after a restart, planned last.
        if self.given is None:
            self.given = (read_json(self.progress, "planned.json") if self.progress else None) or {}
        out, records = dict(self.given), 0
        for s in self.log.segments():
            if _passed(out.get(s["shard"]), s["last"]):
                continue
            if self.limit is not None and records and records + s["rows"] > self.limit:
                break
            records += s["rows"]
            out[s["shard"]] = {"sequence": s["last"], "inclusive": False}
        self.given = out
        return out

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.given = end
        if self.progress:
            write_json(self.progress, "planned.json", end)
        found = []
        for s in self.log.segments():
            after, upto = start.get(s["shard"]), end.get(s["shard"])
            if upto is None or _passed(after, s["last"]) or order_of(s["first"]) > order_of(upto["sequence"]):
                continue
            # Only a segment that a position lies in is looked through for it.
            after = after if _passed(after, s["first"]) else None
            upto = None if _passed(upto, s["last"]) else upto["sequence"]
            for at in range(0, s["rows"], TASK_RECORDS):
                rows = min(TASK_RECORDS, s["rows"] - at)
                found.append(_Part(f"{self.folder}/{s['file']}", s["at"] + at, rows, after, upto))
        return found

    def read(self, partition: _Part):
        import pyarrow as pa
        import pyarrow.parquet as pq

        store, path = store_of(partition.file)
        names, at, groups = [*ENVELOPE.names], 0, []
        first, last = partition.at, partition.at + partition.rows
        with store.open_input_file(path) as file:
            # Whatever the segment's size, a task holds a few pages of each column and a batch.
            segment, begins = pq.ParquetFile(file, buffer_size=1 << 18), 0
            for group in range(segment.num_row_groups):
                ends = begins + segment.metadata.row_group(group).num_rows
                if begins < last and ends > first:
                    at = at if groups else begins
                    groups.append(group)
                begins = ends
            for batch in segment.iter_batches(READ_ROWS, row_groups=groups, columns=names, use_threads=False):
                low, high = max(first - at, 0), min(last - at, len(batch))
                at += len(batch)
                if low < high:
                    part = batch.slice(low, high - low).select(names)
                    if partition.after is not None or partition.upto is not None:
                        keep = [not _passed(partition.after, s) and (partition.upto is None or order_of(s) <= order_of(partition.upto))
                                for s in part.column("sequence_number").to_pylist()]
                        part = part.filter(pa.array(keep, pa.bool_()))
                    # Whatever unit the file has, Spark takes microseconds.
                    time = part.column("arrival_ts").cast(pa.timestamp("us", "UTC"), safe=False)
                    yield pa.RecordBatch.from_arrays([time if n == "arrival_ts" else part.column(n) for n in names], names)
                if at >= last:
                    break

    def commit(self, end: dict) -> None:
        if self.progress:
            write_json(self.progress, "committed.json", end)


class ShardSource(DataSource):
    """The format ``weir_shards``."""

    @classmethod
    def name(cls) -> str:
        return "weir_shards"

    def schema(self) -> str:
        return ENVELOPE.simpleString()

    def streamReader(self, schema) -> ShardReader:
        return ShardReader(self.options)


def shard_stream(spark: SparkSession, folder: str, *, start: str = "TRIM_HORIZON", positions: Mapping[str, str] | None = None,
                 records: int | None = None, progress: str | None = None) -> DataFrame:
    """A shard log as a stream of envelopes.

    A new query starts at the beginning (``TRIM_HORIZON``), behind what is there (``LATEST``), or at or after the sequence
    numbers in ``positions`` (``AT``, ``AFTER``); shards not named there, and shards that appear later, are read from their
    beginning. A restarted query goes on where its checkpoint stands. ``records`` limits a micro-batch, to a segment at
    least; it needs ``progress``, a folder of the query's own where the source keeps its place. ``committed.json`` there holds
    the positions that have been processed for good.
    """
    if start not in STARTS or (start in ("AT", "AFTER")) != (positions is not None):
        raise ValueError(f"start must be one of {STARTS}, AT and AFTER with positions")
    if records is not None and progress is None:
        raise ValueError("a limit of records needs a progress folder")
    spark.dataSource.register(ShardSource)
    options = {"path": folder, "start": start, "positions": json.dumps(dict(positions or {}))}
    if records is not None:
        options["records"] = str(records)
    if progress is not None:
        options["progress"] = progress
    return spark.readStream.format("weir_shards").options(**options).load()
