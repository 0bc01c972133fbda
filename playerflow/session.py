"""Session builder and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT = "spark.checkpoint.dir"
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def local_session(cores: str = "8", app: str = "playerflow", **conf: str) -> SparkSession:
    """Session for tests and benches; on a cluster the caller passes its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a local one only where none is set."""
    configured = spark.conf.get(_CHECKPOINT, None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{_CHECKPOINT} must name a shared folder on a cluster")
    local = tempfile.mkdtemp(prefix="playerflow-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def run_dir(spark: SparkSession, name: str) -> str:
    """A new, not yet existing path below the shared folder."""
    return f"{shared_dir(spark)}/playerflow/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: computed once, and safe when executors are lost."""
    spark = df.sparkSession
    path = run_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_rows(spark: SparkSession, most: int) -> Iterator[None]:
    """What runs meanwhile sends at most so many rows to Python at a time; a lower setting of the session stays.

    A batch is held in memory by the executor and by its Python worker, whatever the size of its rows.
    """
    before = spark.conf.get(_ARROW_ROWS, None)
    if before is None or not 0 < int(before) <= most:
        spark.conf.set(_ARROW_ROWS, str(most))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_ARROW_ROWS)
        else:
            spark.conf.set(_ARROW_ROWS, before)


def scale_settings(input_bytes: int, executor_cores: int, executor_memory_gb: int) -> dict[str, str]:
    """Settings for a large run, from the input size and the executor shape.

    Shuffle partitions start near 256 MB of input each and are merged at run
    time; scan splits leave each core a small share of its memory; a partition
    counts as skewed from twice the target size on.
    """
    target = 256 * 1024**2
    per_core = executor_memory_gb * 1024**3 // max(executor_cores, 1)
    split = min(512 * 1024**2, max(128 * 1024**2, per_core // 16))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target // 2),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.shuffle.partitions": str(max(200, input_bytes // target)),
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.session.timeZone": "UTC",
    }
