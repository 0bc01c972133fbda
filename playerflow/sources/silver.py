"""Typed tables from text feeds, laid out for pruning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playerflow.functions.flags import TRUE_WORDS
from playerflow.functions.times import parse_prefix19


def typed(value: Column, kind: str) -> Column:
    """Text to money, whole number, real number, time or flag; unreadable text is null."""
    if kind == "money":
        return value.try_cast("decimal(18,2)")
    if kind == "whole":
        return value.try_cast("bigint")
    if kind == "real":
        return value.try_cast("double")
    if kind == "time":
        return parse_prefix19(value)
    if kind == "flag":
        return F.when(value.isNotNull(), F.lower(value).isin(list(TRUE_WORDS)))
    if kind == "text":
        return value
    raise ValueError(f"unknown kind {kind}")


def conform(df: DataFrame, kinds: Mapping[str, str], keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Typed rows, and the rows set aside because a key is missing or a value cannot be read.

    The set-aside rows keep their text and name the first column at fault.
    """
    values = {n: typed(F.col(n), kind) for n, kind in kinds.items()}
    fault = F.coalesce(
        *[F.when(F.col(k).isNull(), F.lit(k)) for k in keys],
        *[F.when(F.col(n).isNotNull() & v.isNull(), F.lit(n)) for n, v in values.items()],
    )
    judged = df.withColumn("fault", fault)
    good = judged.filter(F.col("fault").isNull()).select(*[values[c].alias(c) if c in values else F.col(c) for c in df.columns])
    return good, judged.filter(F.col("fault").isNotNull())


def write_events(df: DataFrame, path: str, time: str = "ts") -> None:
    """One folder per brand and day, sorted by player inside each file.

    Rebalancing merges small cells and splits large ones at run time, so a
    brand that holds a third of all rows is written by many tasks.
    """
    (
        df.withColumn("day", F.date_format(time, "yyyy-MM-dd"))
        .hint("rebalance", "brand_id", "day")
        .sortWithinPartitions("brand_id", "day", "player_id", time)
        .write.mode("overwrite").option("maxRecordsPerFile", 1_000_000).partitionBy("brand_id", "day").parquet(path)
    )


def read_events(spark, path: str, schema, brands: Sequence | None = None, first_day: str | None = None, last_day: str | None = None) -> DataFrame:
    """Read with pruning by brand and day."""
    df = spark.read.schema(schema).parquet(path)
    if brands is not None:
        df = df.filter(F.col("brand_id").isin(list(brands)))
    if first_day:
        df = df.filter(F.col("day") >= first_day)
    if last_day:
        df = df.filter(F.col("day") <= last_day)
    return df
