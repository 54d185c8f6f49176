"""Reading tables of records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_records(spark: SparkSession, path: str, *, partitions: int | None = None) -> DataFrame:
    """A Parquet table in its own splits; ``spark.sql.files.maxPartitionBytes`` sets their size.

    A file of one row group is one split, however many cores there are. ``partitions`` deals its rows out to so many tasks,
    by a shuffle of the raw columns, before anything is parsed.
    """
    df = spark.read.parquet(path)
    return df if partitions is None else df.repartition(partitions)
