"""Wagers and sports bets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playerflow.operators.timeline import Count, Last, first_rows, last_rows, running


def bet_join(wagers: DataFrame, sports: DataFrame, wager_order: Sequence[str], sports_order: Sequence[str], keys=("player_id", "bet_id")) -> DataFrame:
    """Latest wager with the latest sports bet of the same player and bet.

    Both sides are reduced to one row per bet first, so the join is one to one.
    """
    nested = lambda df, name: df.select(*keys, F.struct(*[c for c in df.columns if c not in keys]).alias(name))
    left = nested(last_rows(wagers, keys, wager_order), "wagering")
    right = nested(last_rows(sports, keys, sports_order), "sportsbets")
    return left.join(right, list(keys))


def bet_news(sports: DataFrame, wagers: DataFrame, watched: Sequence[str], key: str = "bet_id") -> DataFrame:
    """Sports bets of the watched championships and wagers of one vertical as one timeline per bet.

    ``sports`` needs ``placed_at`` and ``championship_id``, ``wagers``
    ``wager_at``, ``settled`` and ``lost``. At equal times the sports bet comes first.
    """
    settlement = f"struct<wager_at:{dict(wagers.dtypes)['wager_at']},lost:boolean>"
    left = sports.filter(F.col("championship_id").isin(list(watched))).select(
        key, F.col("placed_at").alias("ts"), F.lit(0).cast("bigint").alias("seq"),
        F.struct("championship_id").alias("sport"), F.lit(None).cast(settlement).alias("settlement"), F.lit(False).alias("is_wager"),
    )
    right = wagers.select(
        key, F.col("wager_at").alias("ts"),
        F.when(~F.col("settled"), 3).when(F.col("lost"), 2).otherwise(1).cast("bigint").alias("seq"),
        F.lit(None).cast("struct<championship_id:string>").alias("sport"),
        F.when(F.col("settled"), F.struct("wager_at", "lost")).alias("settlement"), F.lit(True).alias("is_wager"),
    )
    return left.unionByName(right)


def watched_bets(rows: DataFrame, keys: Sequence[str] = ("bet_id",)) -> DataFrame:
    """``placed`` on a bet's first sports bet before any wager, ``result`` once both sides are known."""
    sport, settlement, wagers = Last(F.col("sport")), Last(F.col("settlement")), Count(F.col("is_wager"))
    steps = running(
        rows, keys, ("ts", "seq"),
        after={"sport_now": sport, "settled_now": settlement},
        before={"sport_then": sport, "settled_then": settlement, "wagers_then": wagers},
    )
    both = F.col("sport_now").isNotNull() & F.col("settled_now").isNotNull()
    had_both = F.col("sport_then").isNotNull() & F.col("settled_then").isNotNull()
    placed = F.col("sport").isNotNull() & F.col("sport_then").isNull() & (F.col("wagers_then") == 0)
    kinds = F.array_compact(F.array(F.when(placed, "placed"), F.when(both & ~had_both, "result")))
    result = F.col("kind") == "result"
    return (
        steps.withColumn("kind", F.explode(kinds))
        .withColumn("championship_id", F.col("sport_now.championship_id"))
        .withColumn("bet_won_lost", F.when(result, F.when(F.col("settled_now.lost"), "lost").otherwise("won")))
        .withColumn("result_date", F.when(result, F.date_format("settled_now.wager_at", "yyyy-MM-dd")))
        .drop("sport_now", "settled_now", "sport_then", "settled_then", "wagers_then")
    )


def first_settled_bet(bets: DataFrame, owners: DataFrame, settled: Column, order: Sequence[str]) -> DataFrame:
    """First settled bet per player: first per bet, then per owner, both as aggregates."""
    per_bet = first_rows(bets.filter(settled), ["bet_id"], order)
    return first_rows(per_bet.join(owners, "bet_id"), ["player_wid", "brand_id"], [*order, "bet_id"])


def first_bet_outcome(result_id: Column) -> Column:
    """``0`` wins, everything else loses."""
    return F.when(result_id == "0", "first_winning_bet").otherwise("first_losing_bet")
