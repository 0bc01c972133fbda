"""Messages, keyed JSON rows, exports and their manifest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playerflow.functions.ids import dedup_id

GENERIC_USER = "GENERIC_USER"


def outbox(df: DataFrame, properties: Sequence[str] = (), msg_type: str = GENERIC_USER, contact: str = "player_id") -> DataFrame:
    """One message row per input row. Absent properties are left out of the JSON."""
    optional = lambda name: (F.col(name) if name in df.columns else F.lit(None)).cast("string").alias(name)
    props = F.to_json(F.struct(*[F.col(c) for c in properties])) if properties else F.lit("{}")
    return df.select(
        (F.col("msg_type") if "msg_type" in df.columns else F.lit(msg_type)).alias("msg_type"),
        "brand_id",
        F.col(contact).cast("string").alias("contact_id"),
        "selector",
        optional("channel"),
        optional("blocked"),
        optional("blocked_until"),
        props.alias("properties"),
        F.col("ts").alias("event_ts"),
        dedup_id(F.col("brand_id"), F.col(contact), F.col("selector"), F.col("seq")).alias("dedup_id"),
        "seq",
    )


def body() -> Column:
    """Message body of an outbox row; ``properties`` is already JSON and is placed as it is."""
    head = F.to_json(
        F.struct(
            F.col("msg_type").alias("type"),
            F.col("contact_id").alias("contactId"),
            F.col("selector").alias("mappingSelector"),
            F.col("channel"),
            F.col("blocked"),
            F.col("blocked_until").alias("blockedUntil"),
        )
    )
    return F.concat(F.regexp_replace(head, r"\}$", ""), F.lit(',"properties":'), F.col("properties"), F.lit("}"))


def keyed_json(df: DataFrame, key: Sequence[str], columns: Sequence[str] = ()) -> DataFrame:
    """``(key, value)`` rows for a topic; rows without a full key are dropped."""
    present = df
    for name in key:
        present = present.filter(F.col(name).isNotNull())
    names = list(columns) or df.columns
    return present.select(
        F.concat_ws("-", *[F.col(k).cast("string") for k in key]).alias("key"), F.to_json(F.struct(*names)).alias("value")
    )


def publish(rows: DataFrame, sink: str = "kafka", **options: str) -> None:
    """Write keyed rows to a topic, or to any other sink that takes two text columns."""
    rows.write.format(sink).options(**options).mode("append").save()


def export_json(df: DataFrame, path: str, partition_by: Sequence[str] = ("brand_id",), max_records: int = 1_000_000) -> None:
    """JSON lines for all brands in one job, one folder per brand.

    Rows are rebalanced by brand first: small brands end in one file, a brand
    that holds a third of all rows is split into many tasks at run time.
    """
    df.hint("rebalance", *partition_by).write.mode("overwrite").option("maxRecordsPerFile", max_records).partitionBy(*partition_by).json(path)


def export_text(df: DataFrame, column: str, path: str, partition_by: Sequence[str] = ()) -> None:
    """Pre-rendered text lines."""
    df.select(column, *partition_by).write.mode("overwrite").partitionBy(*partition_by).text(path)


def append_rows(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def manifest(written: DataFrame, dataset: str, path: str, dry_run: bool = False) -> DataFrame:
    """One notification row per brand of a written export."""
    return written.groupBy("brand_id").agg(F.count(F.lit(1)).alias("row_count")).select(
        F.col("brand_id").cast("bigint").alias("brand_id"),
        F.lit(dataset).alias("dataset"),
        F.concat(F.lit(f"{path}/brand_id="), F.col("brand_id").cast("string")).alias("download_uri"),
        F.lit("BATCH_NOTIFICATION").alias("msg_type"),
        F.lit(not dry_run).alias("send"),
        "row_count",
    )


def read_export(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def property_rows(df: DataFrame, id_column: str, properties: dict[str, Column], *keep: str) -> DataFrame:
    """``(id, properties)`` rows for a batch export, properties as a text map."""
    entries = [x for n, c in properties.items() for x in (F.lit(n), c.cast("string"))]
    return df.select(F.col(id_column).alias("id"), F.create_map(*entries).alias("properties"), *keep)


def history_rows(df: DataFrame, id_column: str, properties: dict[str, Column]) -> DataFrame:
    """``(id, properties)`` rows, properties as JSON text without the absent ones."""
    return df.select(
        F.col(id_column).alias("id"), F.to_json(F.struct(*[c.alias(n) for n, c in properties.items()])).alias("properties")
    )
