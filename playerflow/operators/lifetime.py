"""Lifetime aggregates and last-activity dates.

Facts are reduced to one row per player before they meet the player
dimension, so a player with very many facts never skews the join.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLAYER_KEY = ("player_wid", "brand_id")


def money(value: Column) -> Column:
    return value.cast("decimal(18,2)")


def day(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd")


def brand_filter(df: DataFrame, brands: Iterable, column: str = "brand_id") -> DataFrame:
    """``brand = x`` or ``brand IN (...)``; reaches the scan as a pushed filter."""
    return df.filter(F.col(column).isin(list(brands)))


def first_day(as_of: str, days: int) -> Column:
    """The earliest day that counts as recent: a constant, so that comparisons with it reach the scan."""
    return F.date_sub(F.lit(as_of).cast("date"), days)


def recent(df: DataFrame, changed: Column, as_of: str, days: int) -> DataFrame:
    """Rows changed at most ``days`` calendar days before ``as_of``."""
    return df.filter(changed >= first_day(as_of, days))


def _stamped_since(stamp: Column, as_of: str, days: int) -> Column:
    """Whether a ``yyyyMMddHHmmss`` stamp is recent; the text sorts like its time, an unreadable stamp is not recent."""
    text = stamp.cast("string")
    readable = F.try_to_timestamp(text, F.lit("yyyyMMddHHmmss")).isNotNull()
    return (text >= F.date_format(first_day(as_of, days), "yyyyMMddHHmmss")) & readable


def recent_load(df: DataFrame, stamp: Column, as_of: str, days: int) -> DataFrame:
    """The same for a ``yyyyMMddHHmmss`` load stamp; an unreadable stamp drops the row."""
    return df.filter(_stamped_since(stamp, as_of, days))


def recent_any(df: DataFrame, stamps: Sequence[Column], as_of: str, days: int) -> DataFrame:
    """Rows inserted or updated recently: any of the load stamps counts."""
    fresh = F.lit(False)
    for stamp in stamps:
        fresh = fresh | F.coalesce(_stamped_since(stamp, as_of, days), F.lit(False))
    return df.filter(fresh)


def by_type_and_status(wallet: DataFrame, subtypes: DataFrame, type_id: int, statuses: Sequence[int] | None) -> DataFrame:
    """Transactions of one type, reached through the subtype dimension."""
    rows = wallet if statuses is None else wallet.filter(F.col("status_id").isin(list(statuses)))
    return rows.join(subtypes.filter(F.col("type_id") == type_id).select("subtype_id"), "subtype_id")


def per_player(facts: DataFrame, *aggs: Column, keys=PLAYER_KEY) -> DataFrame:
    return facts.groupBy(*keys).agg(*aggs)


def last_date(facts: DataFrame, players: DataFrame, ts: str, out: str) -> DataFrame:
    """Latest ``ts`` per public player id, as a date text."""
    latest = per_player(facts, F.max(ts).alias("__ts")).join(players.select(*PLAYER_KEY, "player_id"), list(PLAYER_KEY))
    return latest.groupBy("player_id").agg(day(F.max("__ts")).alias(out))


def bets_per_player(bets: DataFrame, owners: DataFrame, *aggs: Column) -> DataFrame:
    """Aggregate bet rows per bet first, then attach the owner of the bet."""
    return bets.groupBy("bet_id").agg(*aggs).join(owners, "bet_id")


def last_amount(deposits: DataFrame, ts: str = "transaction_datetime") -> DataFrame:
    """Amounts at each player's latest deposit; ties return several rows.

    Max per player, then a join back on player *and* time: the fact side is
    spread over its times, so no player's rows meet in one task.
    """
    latest = deposits.groupBy(*PLAYER_KEY).agg(F.max(ts).alias(ts))
    return deposits.select(*PLAYER_KEY, ts, "transaction_id", "amount").join(latest, [*PLAYER_KEY, ts])


def last_amount_of_recent(
    wallet: DataFrame, subtypes: DataFrame, type_id: int, statuses: Sequence[int], as_of: str, days: int, ts: str = "transaction_datetime"
) -> DataFrame:
    """Amounts at the latest deposit of the players with any recent transaction, over their full history.

    Recency and latest deposit come from one aggregation per player.
    """
    typed = wallet.join(subtypes, "subtype_id").withColumn(
        "__deposit", (F.col("type_id") == type_id) & F.col("status_id").isin(list(statuses))
    )
    latest = per_player(
        typed, F.max(ts).alias("__seen"), F.max(F.when(F.col("__deposit"), F.col(ts))).alias(ts)
    )
    active = recent(latest, F.col("__seen"), as_of, days).select(*PLAYER_KEY, ts)
    return typed.filter("__deposit").select(*PLAYER_KEY, ts, "transaction_id", "amount").join(active, [*PLAYER_KEY, ts])


def lifetime_totals(deposits: DataFrame) -> DataFrame:
    """Deposit count and amount per player."""
    return per_player(
        deposits,
        F.count(F.lit(1)).alias("lifetime_deposit_count"),
        F.sum(money(F.col("amount"))).cast("double").alias("lifetime_deposit_amount"),
    )


def totals_of_recent_players(wallet: DataFrame, as_of: str, days: int, ts: str = "transaction_datetime") -> DataFrame:
    """Full-history totals of the players with at least one recent transaction.

    A semi join against the recent players, folded into the aggregate: the
    latest transaction per player says whether the player is recent.
    """
    totals = per_player(
        wallet,
        F.count(F.lit(1)).alias("transactions"),
        F.sum(money(F.col("amount"))).cast("double").alias("total_amount"),
        F.max(ts).alias("__last"),
    )
    return recent(totals, F.col("__last"), as_of, days).drop("__last")


def lifetime_bundle(wallet: DataFrame, subtypes: DataFrame, bets: DataFrame, owners: DataFrame, type_id=1, status=2) -> DataFrame:
    """Deposit count and amount, last deposit, last bet and last activity in one row per player."""
    deposit = (F.col("type_id") == type_id) & (F.col("status_id") == status)
    money_side = per_player(
        wallet.join(subtypes, "subtype_id"),
        F.count(F.when(deposit, 1)).alias("deposit_count"),
        F.sum(F.when(deposit, money(F.col("amount")))).alias("deposit_amount"),
        F.max(F.when(deposit, F.col("transaction_datetime"))).alias("last_deposit"),
        F.max("transaction_datetime").alias("last_seen"),
    )
    bet_side = per_player(
        bets_per_player(bets, owners, F.max("bet_datetime").alias("bet_at")), F.max("bet_at").alias("last_bet")
    )
    both = money_side.join(bet_side, list(PLAYER_KEY), "full")
    return both.select(
        *PLAYER_KEY,
        F.coalesce("deposit_count", F.lit(0)).alias("lifetime_deposit_count"),
        F.coalesce(F.col("deposit_amount").cast("double"), F.lit(0.0)).alias("lifetime_deposit_amount"),
        day(F.col("last_deposit")).alias("last_deposit_date"),
        day(F.col("last_bet")).alias("last_bet_date"),
        day(F.greatest("last_seen", "last_bet")).alias("last_activity_date"),
    )


def last_activity(activity: DataFrame, keys=("brand_id", "player_id"), ts: str = "ts") -> DataFrame:
    """Latest event of any kind per player."""
    return activity.groupBy(*keys).agg(F.max(ts).alias("last_activity"))


def churned(activity: DataFrame, already_sent: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Players idle for more than ``days`` days, each reported once."""
    idle = last_activity(activity).withColumn("idle_days", F.datediff(F.lit(as_of).cast("date"), "last_activity"))
    return idle.filter(F.col("idle_days") > days).join(already_sent, ["brand_id", "player_id"], "left_anti")


def average_deposit(total: Column, count: Column) -> Column:
    """Total over count, only where the count is positive."""
    return F.when(count > 0, total / count)
