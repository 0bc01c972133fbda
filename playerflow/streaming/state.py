"""Keyed state between micro-batches, as a table of batch folders.

Each batch writes the new state of the keys it touched into its own folder and
reads only the folders of earlier batches. A batch that is run again therefore
sees the same state and overwrites its own output, which makes
``foreachBatch`` repeatable. Every ``compact_every`` batches the folders are
folded into one full copy, so that the read stays bounded by the state itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as S


class BatchState:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], schema: S.StructType, compact_every: int = 50):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.schema, self.compact_every = schema, compact_every
        self.values = [f.name for f in schema.fields if f.name not in self.keys]

    def _ids(self, kind: str) -> list[int]:
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        # Only complete folders count: Spark marks them when a write commits.
        found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}/*/_SUCCESS"))
        return sorted(int(s.getPath().getParent().getName()) for s in found or [])

    def _rows(self, batch_id: int) -> DataFrame | None:
        """Rows of the last full copy and of the batches after it, each with its batch."""
        full = [i for i in self._ids("full") if i < batch_id]
        base = full[-1] if full else -1
        frames = [("full", base)] if full else []
        frames += [("step", i) for i in self._ids("step") if base < i < batch_id]
        every = None
        for kind, i in frames:
            part = self.spark.read.schema(self.schema).parquet(f"{self.path}/{kind}/{i}").withColumn("__batch", F.lit(i))
            every = part if every is None else every.unionByName(part)
        return every

    def _fold(self, rows: DataFrame | None) -> DataFrame:
        if rows is None:
            return self.spark.createDataFrame([], self.schema)
        latest = rows.groupBy(*self.keys).agg(F.max(F.struct("__batch", *self.values)).alias("v"))
        return latest.select(*self.keys, *[F.col(f"v.{c}").alias(c) for c in self.values]).select(*self.schema.names)

    def before(self, batch_id: int) -> DataFrame:
        """State left by all batches before ``batch_id``: the latest row per key."""
        return self._fold(self._rows(batch_id))

    def since(self, first: int, batch_id: int) -> DataFrame:
        """Rows written by the batches ``first`` to ``batch_id - 1``, without folding them."""
        steps = [f"{self.path}/step/{i}" for i in self._ids("step") if first <= i < batch_id]
        if not steps:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*steps)

    def touched(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Earlier state of the keys that occur in the batch."""
        rows = self._rows(batch_id)
        if rows is not None:
            rows = rows.join(batch.select(*self.keys).distinct(), self.keys, "left_semi")
        return self._fold(rows)

    def write(self, df: DataFrame, batch_id: int) -> None:
        df.select(*self.schema.names).write.mode("overwrite").parquet(f"{self.path}/step/{batch_id}")
        if batch_id and batch_id % self.compact_every == 0:
            self.before(batch_id + 1).write.mode("overwrite").parquet(f"{self.path}/full/{batch_id}")

    def current(self) -> DataFrame:
        ids = self._ids("step") + self._ids("full")
        return self.before(max(ids, default=-1) + 1)


class BatchOutput:
    """Rows emitted per batch, each batch in its own folder that a rerun overwrites."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def write(self, df: DataFrame, batch_id: int, *partition_by: str) -> None:
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{self.path}/batch={batch_id}")

    def read(self, schema: S.StructType | str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.path)
