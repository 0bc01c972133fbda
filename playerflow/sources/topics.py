"""JSON topics: schemas, typed reads, malformed rows, unions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as S

CORRUPT = "_corrupt_record"


def text_schema(*names: str) -> S.StructType:
    """All columns as text: feeds send numbers, flags and times as strings."""
    return S.StructType([S.StructField(n, S.StringType()) for n in names])


def read_json(spark: SparkSession, path: str, schema: S.StructType) -> DataFrame:
    """JSON lines with an explicit schema; unknown fields are ignored, missing ones are null."""
    return spark.read.schema(schema).json(path)


def split_malformed(df: DataFrame, raw: str, schema: S.StructType) -> tuple[DataFrame, DataFrame]:
    """Parse a JSON text column; rows that do not parse go to the second frame as they came."""
    with_corrupt = S.StructType([*schema.fields, S.StructField(CORRUPT, S.StringType())])
    parsed = df.withColumn("__p", F.from_json(raw, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    bad = F.col("__p").isNull() | F.col(f"__p.{CORRUPT}").isNotNull()
    clean = parsed.filter(~bad).select(*[c for c in df.columns if c != raw], *[F.col(f"__p.{f.name}").alias(f.name) for f in schema.fields])
    return clean, parsed.filter(bad).select(*df.columns)


def union_topics(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One frame over several topics, with the topic as a column."""
    every = None
    for topic, df in frames.items():
        tagged = df.withColumn("topic", F.lit(topic))
        every = tagged if every is None else every.unionByName(tagged, allowMissingColumns=True)
    return every


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Drop rows that lack a key or value."""
    for name in columns:
        df = df.filter(F.col(name).isNotNull())
    return df
