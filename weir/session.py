"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Runtime settings the operators count on. ``hugeMethodLimit`` makes Spark fall
# back from one whole-stage method to split expressions once the method is too
# large for the JIT, which matters from about ten routing rules on.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Long texts reach Python in batches bounded by bytes, not only by rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a running session and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int = 8, name: str = "weir") -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Call sites in error messages cost several calls per expression built.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder name under the cluster's ``spark.checkpoint.dir``.

    Without that setting it is under the warehouse, which all executors share too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    root = root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/weir-work"
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
