"""Time-of-day web push with a cool-down per slot.

Each decision depends on earlier decisions, so this is the one operator that
walks a player's rows in sequence. The walk is bounded beforehand: event times
have whole seconds and at most two slots can be open at once, so rows are first
aggregated to one per player and second. Rows then stream through
``mapInPandas`` in key order, which keeps only the current player's four times
in memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playerflow.functions.times import newer_than

KEY = ("brand_id", "player_id")
BALANCE_LIMIT = 5
MAX_AGE_SECONDS = 30 * 60

# Fixed values, in priority order: slot, state name, local hours (half open), cool-down in whole hours.
SLOTS = (
    ("WebPush_NightOwl", "owl", ((23, 24), (0, 4)), 240),
    ("WebPush_EarlyBird", "bird", ((4, 9),), 240),
    ("WebPush_HappyHour", "happy", ((16, 18),), 24),
    ("WebPush_Dailies", "dailies", ((18, 24), (0, 16)), 24),
)
STATE = tuple(name for _, name, _, _ in SLOTS)


def choose(second: int, local_second: int, last: dict[str, int | None]) -> str | None:
    """First open slot by priority that is not cooling down; updates ``last``."""
    hour = local_second / 3600
    for slot, name, hours, cool in SLOTS:
        if any(start <= hour < end for start, end in hours):
            previous = last.get(name)
            # The gap counts whole hours, cut towards zero.
            if previous is None or int((second - previous) / 3600) > cool:
                last[name] = second
                return slot
    return None


def candidates(df: DataFrame, zones: DataFrame, event_time: str, now: str, balance: str, country: str) -> DataFrame:
    """Low-balance, fresh events with the player's local time of day; unknown countries drop out."""
    side = zones.select(F.col("code").alias("__code"), F.col("zone").alias("__zone"))
    at = F.try_to_timestamp(F.col(event_time), F.lit("yyyy-MM-dd HH:mm:ss"))
    rows = df.withColumn("__at", at).filter(
        (F.col(balance) < BALANCE_LIMIT) & newer_than(F.col("__at"), F.col(now), MAX_AGE_SECONDS)
    )
    local = F.from_utc_timestamp("__at", F.col("__zone"))
    return rows.join(side, rows[country] == F.col("__code")).withColumn("second", F.unix_seconds("__at")).withColumn(
        "local_second", (F.hour(local) * 3600 + F.minute(local) * 60 + F.second(local)).cast("int")
    )


def web_push(df: DataFrame, zones: DataFrame, event_time="bet_datetime", now="ts", balance="balance", country="country", seed: bool = False) -> DataFrame:
    """Slot messages per player. With ``seed``, columns ``last_<slot>`` (epoch seconds) start the state."""
    rows = candidates(df, zones, event_time, now, balance, country)
    seeds = [F.max(f"last_{n}").cast("bigint").alias(f"last_{n}") for n in STATE] if seed else [
        F.lit(None).cast("bigint").alias(f"last_{n}") for n in STATE
    ]
    # Sending closes a slot for hours, so one second sends at most once per slot.
    per_second = rows.groupBy(*KEY, "second", "local_second").agg(F.least(F.count(F.lit(1)), F.lit(len(SLOTS))).alias("times"), *seeds)
    ordered = per_second.repartition(*KEY).sortWithinPartitions(*KEY, "second", "local_second")
    return ordered.mapInPandas(_walk, "brand_id bigint, player_id bigint, second bigint, selector string")


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    key, last = None, {}
    for batch in batches:
        out = []
        seeds = [batch[f"last_{n}"].tolist() for n in STATE]
        columns = zip(batch["brand_id"].tolist(), batch["player_id"].tolist(), batch["second"].tolist(),
                      batch["local_second"].tolist(), batch["times"].tolist())
        for i, (brand, player, second, local, times) in enumerate(columns):
            if (brand, player) != key:
                key = (brand, player)
                last = {n: int(s[i]) for n, s in zip(STATE, seeds) if not pd.isna(s[i])}
            for _ in range(times):
                slot = choose(second, local, last)
                if slot is not None:
                    out.append((brand, player, second, slot))
        yield pd.DataFrame(out, columns=["brand_id", "player_id", "second", "selector"])
