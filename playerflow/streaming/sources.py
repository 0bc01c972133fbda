"""Streaming reads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as S

RECORDS_PER_TRIGGER = 500_000
BYTES_PER_TRIGGER = 16 * 1024**3


def stream_topic(spark: SparkSession, servers: str, topics: str, cap: int = RECORDS_PER_TRIGGER) -> DataFrame:
    """Topics from their earliest offsets, capped per trigger (needs the Kafka package)."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topics)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", cap)
        .load()
        .select("topic", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), F.col("timestamp").alias("arrived_at"))
    )


def stream_json_files(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """JSON lines as ``value`` text, the file form of a topic."""
    reader = spark.readStream.format("text")
    reader = reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader.option("maxBytesPerTrigger", BYTES_PER_TRIGGER)
    return reader.load(path)


def json_columns(stream: DataFrame, schema: S.StructType, value: str = "value") -> DataFrame:
    """Typed columns of a JSON value."""
    return stream.withColumn("__v", F.from_json(value, schema)).select("__v.*")


def union_watermarked(streams: dict[str, tuple[DataFrame, str]], time: str = "ts") -> DataFrame:
    """One stream of several topics, tagged with ``topic``; each has its own watermark delay.

    The watermark of the union is the lowest of all (the engine's default policy), so
    no topic's rows are late because another topic is ahead.
    """
    tagged = [s.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay).withColumn("topic", F.lit(topic)) for topic, (s, delay) in streams.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def stream_table(spark: SparkSession, sf_dir: str, name: str, files_per_trigger: int | None = None) -> DataFrame:
    """A parquet table as a stream, bounded per trigger by files or bytes."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    reader = spark.readStream.schema(schema)
    reader = reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader.option("maxBytesPerTrigger", BYTES_PER_TRIGGER)
    # A pattern, as the source takes a folder or a pattern but not one file.
    return reader.parquet(f"{sf_dir}/{name}.parque[t]")
