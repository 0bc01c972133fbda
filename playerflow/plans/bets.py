"""Queries over wagers and sports bets."""

from __future__ import annotations

from pyspark.sql import functions as F

from playerflow.operators import bets as B
from playerflow.operators import lookups as K
from playerflow.plans.registry import query
from playerflow.sources import tables as T

BS = f"WITH {T.BETS_CTE}, {T.SPORTS_CTE}"
ORDER = ("bet_datetime", "line_no", "game_id", "wager_amount", "price", "result", "vertical")
DESC = ", ".join(f"{c} DESC" for c in ORDER)
ASC = ", ".join(ORDER)


@query(
    "bet_join",
    f"""{BS}, w AS (SELECT *, row_number() OVER (PARTITION BY bet_id ORDER BY {DESC}) AS rn FROM bets)
    SELECT bet_id, player_id, strftime(bet_datetime, '%Y-%m-%d') AS bet_date, wager_amount, result, championship_id, event_id
    FROM w JOIN sports USING (bet_id) WHERE rn = 1""",
)
def bet_join(spark, sf):
    # Bet ids are unique here and the wager rows carry no player, so the bet alone is the key.
    joined = B.bet_join(T.bets(spark, sf), T.sports_bets(spark, sf), ORDER, ["placed_at"], keys=("bet_id",))
    return joined.select(
        "bet_id", "sportsbets.player_id", F.date_format("wagering.bet_datetime", "yyyy-MM-dd").alias("bet_date"),
        "wagering.wager_amount", "wagering.result", "sportsbets.championship_id", "sportsbets.event_id",
    )


# Watched championships and their selectors.
CHAMPIONSHIPS = {"1": "cup_bet", "3": "league_bet"}

WATCHED = """w AS (SELECT bet_id, bet_datetime AS t, result = 'R' AS lost, result <> 'N' AS settled FROM bets WHERE vertical = 'F'),
    j AS (SELECT s.bet_id, s.championship_id, count(t) FILTER (WHERE t < placed_at) AS earlier,
        coalesce(max({'at': t, 'lost': lost}) FILTER (WHERE settled AND t < placed_at), min({'at': t, 'lost': lost}) FILTER (WHERE settled AND t >= placed_at)) AS r
      FROM sports s LEFT JOIN w USING (bet_id) WHERE championship_id IN ('1', '3') GROUP BY 1, 2),
    m AS (SELECT bet_id, championship_id, 'placed' AS kind, NULL AS bet_won_lost, NULL AS result_date FROM j WHERE earlier = 0
    UNION ALL SELECT bet_id, championship_id, 'result', CASE WHEN r.lost THEN 'lost' ELSE 'won' END, strftime(r.at, '%Y-%m-%d') FROM j WHERE r IS NOT NULL)"""


def vertical_wagers(bets):
    return bets.filter(F.col("vertical") == "F").select(
        "bet_id", F.col("bet_datetime").alias("wager_at"), (F.col("result") != "N").alias("settled"), (F.col("result") == "R").alias("lost")
    )


@query(
    "bet_accumulate_join",
    f"{BS}, {WATCHED} SELECT *, CASE championship_id WHEN '1' THEN 'cup_bet' ELSE 'league_bet' END AS selector FROM m",
)
def bet_accumulate_join(spark, sf):
    news = B.bet_news(T.sports_bets(spark, sf), vertical_wagers(T.bets(spark, sf)), list(CHAMPIONSHIPS))
    selector = F.create_map(*[F.lit(x) for pair in CHAMPIONSHIPS.items() for x in pair])
    return B.watched_bets(news).select(
        "bet_id", "championship_id", "kind", "bet_won_lost", "result_date", selector[F.col("championship_id")].alias("selector")
    )


@query(
    "event_market_lookup",
    f"""WITH {T.SPORTS_CTE} SELECT bet_id, coalesce(e.p_name, '') AS event_description, coalesce(m.p_type, '') AS market_description
    FROM sports s LEFT JOIN part e ON e.p_partkey = s.event_id LEFT JOIN part m ON m.p_partkey = s.market_id""",
)
def event_market_lookup(spark, sf):
    part = T.read_table(spark, sf, "part")
    named = K.describe(T.sports_bets(spark, sf), part, "event_id", "p_partkey", "p_name", "event_description")
    both = K.describe(named, part, "market_id", "p_partkey", "p_type", "market_description")
    return both.select("bet_id", "event_description", "market_description")


@query(
    "first_resulted_bet",
    f"""{BS}, f AS (SELECT b.*, o_custkey AS player_wid, row_number() OVER (PARTITION BY o_custkey ORDER BY {ASC}, bet_id) AS rn
      FROM bets b JOIN orders ON o_orderkey = bet_id WHERE vertical = 'F' AND result <> 'N')
    SELECT player_wid, bet_id, wager_amount, CASE WHEN result = 'A' THEN 'first_winning_bet' ELSE 'first_losing_bet' END AS selector
    FROM f JOIN customer ON c_custkey = player_wid WHERE rn = 1 AND DATE '1996-01-01' + CAST(c_custkey % 1500 AS INT) > DATE '1997-01-01'""",
)
def first_resulted_bet(spark, sf):
    settled = (F.col("vertical") == "F") & (F.col("result") != "N")
    first = B.first_settled_bet(T.bets(spark, sf), T.bet_owners(spark, sf), settled, ORDER)
    registered = T.read_table(spark, sf, "customer").select(
        F.col("c_custkey").alias("player_wid"), F.date_add(F.lit("1996-01-01").cast("date"), (F.col("c_custkey") % 1500).cast("int")).alias("reg")
    ).filter(F.col("reg") > F.lit("1997-01-01").cast("date"))
    result_id = F.when(F.col("result") == "A", "0").otherwise("1")
    return first.join(registered, "player_wid").select(
        "player_wid", "bet_id", "wager_amount", B.first_bet_outcome(result_id).alias("selector")
    )


@query(
    "first_resulted_bet_within_2_days",
    f"""{BS}, f AS (SELECT b.*, o_custkey AS player_wid, row_number() OVER (PARTITION BY o_custkey ORDER BY {ASC}, bet_id) AS rn
      FROM bets b JOIN orders ON o_orderkey = bet_id),
    reg AS (SELECT o_custkey AS player_wid, min(o_orderdate) AS reg FROM orders GROUP BY 1)
    SELECT player_wid, bet_id, CASE WHEN result = 'A' THEN 'first_winning_bet' ELSE 'first_losing_bet' END AS selector
    FROM f JOIN reg USING (player_wid) WHERE rn = 1 AND vertical = 'F' AND result <> 'N' AND bet_datetime > reg AND bet_datetime <= reg + INTERVAL 2 DAY""",
)
def first_resulted_bet_within_2_days(spark, sf):
    """The very first bet must itself be settled, soon after the registration."""
    first = B.first_settled_bet(T.bets(spark, sf), T.bet_owners(spark, sf), F.lit(True), ORDER)
    registered = T.sports_bets(spark, sf).groupBy(F.col("player_id").alias("player_wid")).agg(F.min("placed_at").alias("reg"))
    hits = first.filter((F.col("vertical") == "F") & (F.col("result") != "N")).join(registered, "player_wid").filter(
        (F.col("bet_datetime") > F.col("reg")) & (F.col("bet_datetime") <= F.col("reg") + F.expr("INTERVAL 2 DAY"))
    )
    result_id = F.when(F.col("result") == "A", "0").otherwise("1")
    return hits.select("player_wid", "bet_id", B.first_bet_outcome(result_id).alias("selector"))


@query(
    "bet_retention",
    f"""{BS}, r AS (SELECT o_custkey AS player_wid, min(o_orderdate) AS reg FROM orders GROUP BY 1)
    SELECT player_wid, bet_id, count(*) AS kept FROM bets b JOIN orders ON o_orderkey = bet_id JOIN r ON r.player_wid = o_custkey
    WHERE bet_datetime <= reg + INTERVAL 20 DAY GROUP BY 1, 2""",
)
def bet_retention(spark, sf):
    """Bets kept in the per-player list: those within the retention time after registration."""
    registered = T.sports_bets(spark, sf).groupBy(F.col("player_id").alias("player_wid")).agg(F.min("placed_at").alias("reg"))
    counted = T.bets(spark, sf).groupBy("bet_id", "bet_datetime").agg(F.count(F.lit(1)).alias("n"))
    owned = counted.join(T.bet_owners(spark, sf), "bet_id").join(registered, "player_wid")
    kept = owned.filter(F.col("bet_datetime") <= F.col("reg") + F.expr("INTERVAL 20 DAY"))
    return kept.groupBy("player_wid", "bet_id").agg(F.sum("n").alias("kept"))


@query("first_by", f"WITH {T.BETS_CTE} SELECT bet_id, arg_min(wager_amount, {{'a': bet_datetime, 'b': line_no, 'c': game_id, 'd': wager_amount}}) AS first_amount FROM bets GROUP BY 1")
def first_by(spark, sf):
    at = F.struct("bet_datetime", "line_no", "game_id", "wager_amount")
    return T.bets(spark, sf).groupBy("bet_id").agg(F.min_by("wager_amount", at).alias("first_amount"))
