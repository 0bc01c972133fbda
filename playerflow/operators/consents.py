"""Consent state per channel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playerflow.functions.flags import to_bool
from playerflow.operators.timeline import Last, running

KEY = ("brand_id", "player_id", "channel")
ORDER = ("ts", "seq")


def consent_changes(
    df: DataFrame,
    channels=("EMAIL", "SMS"),
    null_as: str | None = None,
    overwrite_null: bool = False,
) -> DataFrame:
    """Rows where the consent of a channel is first seen or changes.

    ``null_as`` reads an absent consent as that value (history loads);
    ``overwrite_null`` lets an absent consent clear the stored one.
    """
    consent = F.coalesce("consented", F.lit(null_as)) if null_as else F.col("consented")
    rows = df.withColumn("channel", F.upper("channel")).withColumn("consented", consent)
    if channels:
        rows = rows.filter(F.col("channel").isin(list(channels)))
    if overwrite_null:
        stored = Last(F.struct(F.col("consented").alias("v")))
        rows = running(rows, KEY, ORDER, before={"stored": stored})
        old = F.col("stored.v")
        return rows.filter(old.isNull() | ~old.eqNullSafe(F.col("consented")))
    rows = running(rows.filter(F.col("consented").isNotNull()), KEY, ORDER, before={"stored": Last(F.col("consented"))})
    return rows.filter(~F.col("stored").eqNullSafe(F.col("consented")))


def fan_out(changes: DataFrame, brands, source: str = "EMAIL", targets=("EMAIL", "SMS")) -> DataFrame:
    """For the listed brands one channel speaks for several and all others are dropped."""
    listed = F.col("brand_id").isin(list(brands))
    outgoing = (
        F.when(listed & (F.col("channel") == source), F.array(*[F.lit(t) for t in targets]))
        .when(listed, F.array().cast("array<string>"))
        .otherwise(F.array("channel"))
    )
    return changes.withColumn("channel", F.explode(outgoing))


def rollup(df: DataFrame, areas=("casino", "betting", "bingo"), lead: str = "betting") -> DataFrame:
    """One row per channel: consent in any area, only where the lead area's flag is present."""
    rows = []
    for channel in ("sms", "email"):
        any_area = F.lit(False)
        for area in areas:
            any_area = any_area | to_bool(F.col(f"{channel}_{area}"), ("true",))
        rows.append(
            F.when(
                F.col(f"{channel}_{lead}").isNotNull(),
                F.struct(F.lit(channel.upper()).alias("channel"), any_area.alias("consented")),
            )
        )
    return df.select("*", F.explode(F.array_compact(F.array(*rows))).alias("c")).select("*", "c.channel", "c.consented").drop("c")


def history_events(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Consent columns as one keyed JSON event per channel; absent flags stay as explicit nulls."""
    text = lambda c: F.col(c).cast("string")
    events = [
        F.to_json(
            F.struct(
                F.lit("USER_CONSENT_EVENT").alias("type"), text("brand_id").alias("brand_id"), text("player_id").alias("player_id"),
                F.lit(channel).alias("channel"), text(column).alias("consented"),
            ),
            {"ignoreNullFields": "false"},
        )
        for channel, column in columns.items()
    ]
    return df.select("player_id", F.explode(F.array(*events)).alias("value"))


def channel_consent(value: Column) -> Column:
    return F.when(value == "0", "false").otherwise("true")
