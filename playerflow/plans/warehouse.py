"""Batch queries over the warehouse tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from playerflow.functions.times import local_date
from playerflow.operators import lifetime as L
from playerflow.plans.registry import query
from playerflow.sources import tables as T

AS_OF = "2001-08-01"
WP = f"WITH {T.WALLET_CTE}, {T.PLAYERS_CTE}, {T.SUBTYPES_CTE}"
WB = f"WITH {T.BETS_CTE}, {T.PLAYERS_CTE}, owners AS (SELECT o_orderkey AS bet_id, o_custkey AS player_wid, o_custkey % 5 AS brand_id FROM orders)"


@query("read_table", f"WITH {T.WALLET_CTE} SELECT transaction_id, player_wid, brand_id, amount FROM wallet WHERE brand_id IN (1, 3)")
def read_table(spark, sf):
    return L.brand_filter(T.wallet(spark, sf), (1, 3)).select("transaction_id", "player_wid", "brand_id", "amount")


@query("read_in_parts", f"WITH {T.WALLET_CTE} SELECT transaction_id, player_wid, amount FROM wallet")
def read_in_parts(spark, sf):
    """The whole table as eight scans of about the same size, cut at quantiles of the player."""
    wallet = T.wallet(spark, sf)
    points = T.split_points(wallet.sample(0.1, seed=1), "player_wid", 8)
    return T.read_in_parts(wallet, T.split_predicates("player_wid", points)).select("transaction_id", "player_wid", "amount")


@query("brand_filter", f"WITH {T.PLAYERS_CTE} SELECT player_id, brand_id FROM players WHERE brand_id = 2")
def brand_filter(spark, sf):
    return L.brand_filter(T.players(spark, sf), [2]).select("player_id", "brand_id")


@query("brand_allowlist", f"WITH {T.PLAYERS_CTE} SELECT player_id, brand_id FROM players WHERE brand_id IN (SELECT r_regionkey FROM region WHERE r_name LIKE 'A%')")
def brand_allowlist(spark, sf):
    """Allowed brands come from a configuration table."""
    allowed = T.read_table(spark, sf, "region").filter(F.col("r_name").startswith("A"))
    return T.players(spark, sf).join(
        allowed.selectExpr("CAST(r_regionkey AS BIGINT) AS brand_id"), "brand_id", "left_semi"
    ).select("player_id", "brand_id")


@query(
    "recent_filter",
    f"""WITH {T.WALLET_CTE} SELECT transaction_id, strftime(transaction_datetime, '%Y%m%d%H%M%S') AS load_stamp FROM wallet
    WHERE datediff('day', transaction_datetime, DATE '{AS_OF}') <= 60""",
)
def recent_filter(spark, sf):
    stamped = T.wallet(spark, sf).withColumn("load_stamp", F.date_format("transaction_datetime", "yyyyMMddHHmmss"))
    return L.recent_load(stamped, F.col("load_stamp"), AS_OF, 60).select("transaction_id", "load_stamp")


@query(
    "star_join",
    f"""{WP} SELECT w.transaction_id, p.player_id, s.type_id, w.status_id, n_name AS currency, w.amount
    FROM wallet w JOIN players p ON p.player_wid = w.player_wid AND p.brand_id = w.brand_id
    JOIN subtypes s ON s.subtype_id = w.subtype_id JOIN nation ON n_nationkey = p.currency_id""",
)
def star_join(spark, sf):
    people = T.players(spark, sf).join(T.currencies(spark, sf), "currency_id").select(
        *L.PLAYER_KEY, "player_id", F.col("description").alias("currency")
    )
    return (
        T.wallet(spark, sf)
        .join(T.subtypes(spark), "subtype_id")
        .join(people, list(L.PLAYER_KEY))
        .select("transaction_id", "player_id", "type_id", "status_id", "currency", "amount")
    )


@query(
    "distinct_dim_join",
    f"""WITH {T.PLAYERS_CTE}, dim AS (SELECT DISTINCT s_nationkey AS currency_id, 'CUR_' || CAST(s_nationkey AS STRING) AS currency
      FROM supplier WHERE s_nationkey IS NOT NULL)
    SELECT player_id, players.currency_id, currency FROM players JOIN dim ON dim.currency_id = players.currency_id""",
)
def distinct_dim_join(spark, sf):
    """The dimension repeats its rows, so it is made distinct before the join."""
    dim = (
        T.read_table(spark, sf, "supplier")
        .filter(F.col("s_nationkey").isNotNull())
        .selectExpr("s_nationkey AS currency_id", "'CUR_' || CAST(s_nationkey AS STRING) AS currency")
        .distinct()
    )
    return T.players(spark, sf).join(dim, "currency_id").select("player_id", "currency_id", "currency")


@query(
    "last_deposit_amount",
    f"""{WP}, d AS (SELECT w.*, rank() OVER (PARTITION BY player_wid, brand_id ORDER BY transaction_datetime DESC) AS r
      FROM wallet w JOIN subtypes USING (subtype_id) WHERE type_id = 1 AND status_id = 2)
    SELECT player_wid, brand_id, transaction_id, amount, strftime(transaction_datetime, '%Y-%m-%d') AS last_deposit_date FROM d WHERE r = 1""",
)
def last_deposit_amount(spark, sf):
    deposits = L.by_type_and_status(T.wallet(spark, sf), T.subtypes(spark), 1, [2])
    return L.last_amount(deposits).select(
        *L.PLAYER_KEY, "transaction_id", "amount", L.day(F.col("transaction_datetime")).alias("last_deposit_date")
    )


@query(
    "last_deposit_amount_recent",
    f"""{WP}, active AS (SELECT DISTINCT player_wid, brand_id FROM wallet WHERE datediff('day', transaction_datetime, DATE '{AS_OF}') <= 120),
    d AS (SELECT w.*, rank() OVER (PARTITION BY player_wid, brand_id ORDER BY transaction_datetime DESC) AS r
      FROM wallet w JOIN subtypes USING (subtype_id) JOIN active USING (player_wid, brand_id) WHERE type_id = 1 AND status_id IN (1, 2))
    SELECT player_wid, brand_id, transaction_id, amount FROM d WHERE r = 1""",
)
def last_deposit_amount_recent(spark, sf):
    rows = L.last_amount_of_recent(T.wallet(spark, sf), T.subtypes(spark), 1, [1, 2], AS_OF, 120)
    return rows.select(*L.PLAYER_KEY, "transaction_id", "amount")


@query(
    "recent_insert_or_update",
    f"""WITH {T.WALLET_CTE} SELECT transaction_id FROM wallet WHERE datediff('day', transaction_datetime, DATE '{AS_OF}') <= 60
      OR datediff('day', transaction_datetime + CAST(transaction_id % 400 AS INT) * INTERVAL 1 DAY, DATE '{AS_OF}') <= 60""",
)
def recent_insert_or_update(spark, sf):
    stamp = lambda c: F.date_format(c, "yyyyMMddHHmmss")
    inserted = F.col("transaction_datetime")
    updated = F.date_add(inserted.cast("date"), (F.col("transaction_id") % 400).cast("int"))
    return L.recent_any(T.wallet(spark, sf), [stamp(inserted), stamp(updated)], AS_OF, 60).select("transaction_id")


@query(
    "recent_active_semi",
    f"""WITH {T.WALLET_CTE}, active AS (SELECT DISTINCT player_wid, brand_id FROM wallet
      WHERE datediff('day', transaction_datetime, DATE '{AS_OF}') <= 120)
    SELECT player_wid, brand_id, count(*) AS transactions, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_amount
    FROM wallet JOIN active USING (player_wid, brand_id) GROUP BY 1, 2""",
)
def recent_active_semi(spark, sf):
    return L.totals_of_recent_players(T.wallet(spark, sf), AS_OF, 120)


@query(
    "last_bet_date",
    f"""{WB} SELECT player_id, strftime(max(bet_datetime), '%Y-%m-%d') AS last_bet_date FROM bets JOIN owners USING (bet_id)
    JOIN players USING (player_wid, brand_id) WHERE datediff('day', bet_datetime, DATE '{AS_OF}') <= 400 GROUP BY player_id""",
)
def last_bet_date(spark, sf):
    fresh = L.recent(T.bets(spark, sf), F.col("bet_datetime"), AS_OF, 400)
    facts = L.bets_per_player(fresh, T.bet_owners(spark, sf), F.max("bet_datetime").alias("bet_at"))
    return L.last_date(facts, T.players(spark, sf), "bet_at", "last_bet_date")


def _last_deposit(spark, sf, statuses, days):
    fresh = L.recent(T.wallet(spark, sf), F.col("transaction_datetime"), AS_OF, days)
    deposits = L.by_type_and_status(fresh, T.subtypes(spark), 1, statuses)
    return L.last_date(deposits, T.players(spark, sf), "transaction_datetime", "last_deposit_date")


def _last_deposit_sql(status, days):
    return f"""{WP} SELECT player_id, strftime(max(transaction_datetime), '%Y-%m-%d') AS last_deposit_date
    FROM wallet JOIN players USING (player_wid, brand_id) JOIN subtypes USING (subtype_id)
    WHERE type_id = 1 AND {status} AND datediff('day', transaction_datetime, DATE '{AS_OF}') <= {days} GROUP BY player_id"""


@query("last_deposit_date", _last_deposit_sql("status_id = 2", 400))
def last_deposit_date(spark, sf):
    return _last_deposit(spark, sf, [2], 400)


@query("last_deposit_date_any_status", _last_deposit_sql("true", 400))
def last_deposit_date_any_status(spark, sf):
    return _last_deposit(spark, sf, None, 400)


@query("last_deposit_date_status_1", _last_deposit_sql("status_id = 1", 400))
def last_deposit_date_status_1(spark, sf):
    return _last_deposit(spark, sf, [1], 400)


@query(
    "last_played_local",
    f"""{WB} SELECT player_id, strftime(max(bet_datetime + INTERVAL 3 HOUR) AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York', '%Y-%m-%d') AS last_played_date
    FROM bets JOIN owners USING (bet_id) JOIN players USING (player_wid, brand_id) WHERE vertical = 'F' AND result = 'R' GROUP BY player_id""",
)
def last_played_local(spark, sf):
    """Bets carry midnight times here, so three hours are added to make the zone matter."""
    played = T.bets(spark, sf).filter((F.col("vertical") == "F") & (F.col("result") == "R"))
    facts = L.bets_per_player(
        played, T.bet_owners(spark, sf), F.max(F.expr("bet_datetime + INTERVAL 3 HOUR").cast("timestamp")).alias("bet_at")
    )
    latest = L.per_player(facts, F.max("bet_at").alias("at")).join(
        T.players(spark, sf).select(*L.PLAYER_KEY, "player_id"), list(L.PLAYER_KEY)
    )
    return latest.groupBy("player_id").agg(local_date(F.max("at"), "America/New_York").alias("last_played_date"))


@query(
    "last_played_all_time",
    f"""{WB} SELECT player_id, strftime(max(bet_datetime), '%Y-%m-%d') AS last_played_date FROM bets JOIN owners USING (bet_id)
    JOIN players USING (player_wid, brand_id) GROUP BY player_id""",
)
def last_played_all_time(spark, sf):
    facts = L.bets_per_player(T.bets(spark, sf), T.bet_owners(spark, sf), F.max("bet_datetime").alias("bet_at"))
    return L.last_date(facts, T.players(spark, sf), "bet_at", "last_played_date")


@query(
    "lifetime_deposits",
    f"""{WP} SELECT player_wid, brand_id, count(*) AS lifetime_deposit_count,
      CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS lifetime_deposit_amount
    FROM wallet JOIN subtypes USING (subtype_id) WHERE type_id = 1 AND status_id = 2 GROUP BY 1, 2""",
)
def lifetime_deposits(spark, sf):
    return L.lifetime_totals(L.by_type_and_status(T.wallet(spark, sf), T.subtypes(spark), 1, [2]))


@query(
    "lifetime_bundle",
    f"""{WP}, {T.BETS_CTE},
    m AS (SELECT player_wid, brand_id, count(*) FILTER (WHERE type_id = 1 AND status_id = 2) AS c,
        sum(CAST(amount AS DECIMAL(18,2))) FILTER (WHERE type_id = 1 AND status_id = 2) AS a,
        max(transaction_datetime) FILTER (WHERE type_id = 1 AND status_id = 2) AS d, max(transaction_datetime) AS s
      FROM wallet JOIN subtypes USING (subtype_id) GROUP BY 1, 2),
    b AS (SELECT o_custkey AS player_wid, o_custkey % 5 AS brand_id, max(bet_datetime) AS bd FROM bets JOIN orders ON o_orderkey = bet_id GROUP BY 1, 2)
    SELECT player_wid, brand_id, coalesce(c, 0) AS lifetime_deposit_count, coalesce(CAST(a AS DOUBLE), 0) AS lifetime_deposit_amount,
      strftime(d, '%Y-%m-%d') AS last_deposit_date, strftime(bd, '%Y-%m-%d') AS last_bet_date,
      strftime(greatest(s, bd), '%Y-%m-%d') AS last_activity_date
    FROM m FULL JOIN b USING (player_wid, brand_id)""",
)
def lifetime_bundle(spark, sf):
    return L.lifetime_bundle(T.wallet(spark, sf), T.subtypes(spark), T.bets(spark, sf), T.bet_owners(spark, sf))


EV = f"WITH {T.EVENTS_CTE}"


@query(
    "last_activity_date",
    f"""{EV}, a AS (SELECT brand_id, player_id, max(ts) AS seen_at FROM ev WHERE topic IN ('logins', 'wagering', 'wallet') GROUP BY 1, 2)
    SELECT brand_id, player_id, strftime(seen_at, '%Y-%m-%d') AS last_activity_date FROM a WHERE datediff('day', seen_at, DATE '2024-01-31') <= 2""",
)
def last_activity_date(spark, sf):
    seen = L.last_activity(T.events(spark, sf, "logins", "wagering", "wallet"))
    fresh = L.recent(seen, F.col("last_activity"), "2024-01-31", 2)
    return fresh.select("brand_id", "player_id", L.day(F.col("last_activity")).alias("last_activity_date"))


@query(
    "average_deposit",
    f"""{EV} SELECT seq, player_id, CASE WHEN lifetime_count > 0 THEN total_deposit_eur / lifetime_count END AS average_deposit
    FROM ev WHERE topic = 'wallet' AND lifetime_count > 0""",
)
def average_deposit(spark, sf):
    rows = T.events(spark, sf, "wallet")
    value = L.average_deposit(F.col("total_deposit_eur"), F.col("lifetime_count"))
    return rows.select("seq", "player_id", value.alias("average_deposit")).filter(F.col("average_deposit").isNotNull())


@query(
    "distinct",
    f"WITH {T.WALLET_CTE} SELECT DISTINCT player_wid, brand_id, status_id FROM wallet",
)
def distinct(spark, sf):
    return T.wallet(spark, sf).select("player_wid", "brand_id", "status_id").distinct()


@query(
    "churned",
    f"""{EV}, a AS (SELECT brand_id, player_id, max(ts) AS seen_at FROM ev WHERE topic <> 'players' GROUP BY 1, 2),
    sent AS (SELECT DISTINCT brand_id, player_id FROM ev WHERE topic = 'players' AND k = 7)
    SELECT brand_id, player_id, datediff('day', seen_at, DATE '2024-02-29') AS idle_days FROM a
    WHERE datediff('day', seen_at, DATE '2024-02-29') > 30 AND NOT EXISTS (SELECT 1 FROM sent s WHERE s.brand_id = a.brand_id AND s.player_id = a.player_id)""",
)
def churned(spark, sf):
    sent = T.events(spark, sf, "players").filter(F.col("k") == 7).select("brand_id", "player_id").distinct()
    idle = L.churned(T.events(spark, sf, "logins", "wagering", "wallet"), sent, "2024-02-29")
    return idle.select("brand_id", "player_id", F.col("idle_days").cast("bigint").alias("idle_days"))
