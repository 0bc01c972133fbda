"""The analytics tables, mapped from the parquet files at hand.

The expressions below are plain SQL that Spark and DuckDB both read, so the
query checks can state the same mapping as a common table expression.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOPIC = (
    "CASE event_type WHEN 'signup' THEN 'players' WHEN 'view' THEN 'logins' "
    "WHEN 'click' THEN 'wagering' ELSE 'wallet' END"
)


def _dt(expr: str) -> str:
    return f"substring(CAST({expr} AS STRING), 1, 19)"


def _on(event: str, expr: str) -> str:
    return f"CASE WHEN event_type = '{event}' THEN {expr} END"


_WALLET = "event_type IN ('purchase', 'error')"

# Typed event columns, each null outside its topic.
EVENT_COLUMNS: dict[str, str] = {
    "seq": "event_id",
    "ts": "ts",
    "player_id": "user_id",
    "brand_id": "user_id % 5",
    "topic": TOPIC,
    "k": "k",
    "value": "value",
    "dt": _dt("ts"),
    # player record
    "email": _on("signup", "CASE WHEN k % 3 <> 0 THEN 'p' || CAST(user_id AS STRING) || '.' || CAST(k % 4 AS STRING) || '@mail.test' END"),
    "phone": _on("signup", "CASE WHEN k % 4 = 0 THEN NULL WHEN k % 4 = 1 THEN '' ELSE '+44' || CAST(k AS STRING) END"),
    "language": _on("signup", "CASE k % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'en' WHEN 3 THEN 'fr' ELSE 'de' END"),
    "country_id": _on("signup", "CASE WHEN k % 6 <> 0 THEN k % 27 END"),
    "reg_datetime": _on(
        "signup",
        "CASE WHEN k % 6 = 0 THEN NULL WHEN k % 3 = 0 THEN " + _dt("ts - INTERVAL 1 HOUR")
        + " WHEN k % 3 = 1 THEN " + _dt("ts - INTERVAL 2 DAY") + " ELSE " + _dt("ts - INTERVAL 40 DAY") + " END",
    ),
    "first_dep_datetime": _on("signup", "CASE WHEN k % 9 = 0 THEN " + _dt("ts - INTERVAL 3 HOUR") + " WHEN k % 9 = 1 THEN " + _dt("ts - INTERVAL 3 DAY") + " END"),
    "is_self_excluded": _on("signup", "CASE WHEN k % 10 = 0 THEN 'true' WHEN k % 10 < 5 THEN 'false' END"),
    "is_verified": _on("signup", "CASE WHEN k % 4 = 0 THEN 'True' WHEN k % 4 = 1 THEN 'false' END"),
    "phone_confirmed": _on("signup", "CASE WHEN k % 5 = 0 THEN 'TRUE' WHEN k % 5 = 1 THEN 'false' END"),
    "email_confirmed": _on("signup", "CASE WHEN k % 7 = 0 THEN 'true' WHEN k % 7 = 1 THEN '' END"),
    "player_status": _on("signup", "CASE WHEN k % 7 <> 6 THEN CAST(k % 6 AS STRING) END"),
    "blocked_start": _on("signup", "CASE WHEN k % 4 <> 3 THEN " + _dt("ts") + " END"),
    "blocked_end": _on("signup", "CASE k % 5 WHEN 0 THEN NULL WHEN 1 THEN ' ' ELSE '2030-01-0' || CAST(k % 9 + 1 AS STRING) || ' 00:00:00' END"),
    "vip_level": _on("signup", "CASE WHEN k % 8 <> 0 THEN CAST(k % 3 AS STRING) END"),
    "channel": _on("signup", "CASE k % 3 WHEN 0 THEN 'EMAIL' WHEN 1 THEN 'sms' ELSE 'push' END"),
    "consented": _on("signup", "CASE k % 4 WHEN 0 THEN '0' WHEN 1 THEN '1' WHEN 2 THEN '1' END"),
    # wallet
    "transaction_type": f"CASE WHEN {_WALLET} THEN CASE k % 6 WHEN 0 THEN 'deposit-card' WHEN 1 THEN 'Deposit-coin' WHEN 2 THEN 'withdraw_bank' WHEN 3 THEN 'deposit' WHEN 4 THEN 'withdrawal' ELSE 'deposit_shop' END END",
    "transaction_status": "CASE event_type WHEN 'purchase' THEN CASE k % 4 WHEN 0 THEN 'complete' WHEN 1 THEN 'Completed' WHEN 2 THEN 'approved' ELSE 'successful' END WHEN 'error' THEN CASE k % 5 WHEN 0 THEN 'failed' WHEN 1 THEN 'decline' WHEN 2 THEN 'pending' WHEN 3 THEN 'cancelled' ELSE 'rejected' END END",
    "pay_method": f"CASE WHEN {_WALLET} THEN CASE k % 5 WHEN 0 THEN 'Bitcoin Cash wallet' WHEN 1 THEN 'visa' WHEN 2 THEN 'XBO pay' WHEN 3 THEN 'bank' END END",
    "transaction_id": f"CASE WHEN {_WALLET} THEN CAST(k % 40 AS STRING) END",
    "amount": f"CASE WHEN {_WALLET} THEN value END",
    "amount_cents": f"CASE WHEN {_WALLET} THEN CAST(round(value * 100) AS BIGINT) END",
    "lifetime_count": f"CASE WHEN {_WALLET} THEN k % 3 END",
    "total_deposit_eur": f"CASE WHEN {_WALLET} THEN round(value * 3, 2) END",
    # wagering
    "bet_datetime": _on("click", "CASE WHEN k % 2 = 0 THEN " + _dt("ts") + " ELSE " + _dt("ts - INTERVAL 40 DAY") + " END"),
    "ggr_amount": _on("click", "round(value * (k % 10), 2)"),
    "win_amount": _on("click", "round(value * (k % 30), 2)"),
    "result_id": _on("click", "CAST(k % 2 AS STRING)"),
    "has_resulted": _on("click", "CASE k % 3 WHEN 0 THEN 'false' WHEN 1 THEN 'true' ELSE '1' END"),
    "vertical_id": _on("click", "CAST(k % 3 AS STRING)"),
    "balance": "CASE WHEN event_type IN ('click', 'purchase') AND k % 5 <> 0 THEN value / 10 END",
    # logins
    "login_success": _on("view", "CASE WHEN k % 3 = 0 THEN 'false' ELSE 'true' END"),
    "login_datetime": _on("view", "CASE WHEN k % 4 = 0 THEN " + _dt("ts - INTERVAL 35 DAY") + " ELSE " + _dt("ts") + " END"),
}

WALLET_COLUMNS = {
    "transaction_id": "o_orderkey",
    "player_wid": "o_custkey",
    "brand_id": "o_custkey % 5",
    "subtype_id": "CAST(substring(o_orderpriority, 1, 1) AS INT)",
    "status_id": "CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 1 ELSE 3 END",
    "amount": "o_totalprice",
    "transaction_datetime": "o_orderdate",
}

PLAYER_COLUMNS = {
    "player_wid": "c_custkey",
    "player_id": "c_name",
    "brand_id": "c_custkey % 5",
    "country_id": "c_nationkey",
    "currency_id": "c_nationkey",
    "balance": "c_acctbal",
    "segment": "c_mktsegment",
}

BET_COLUMNS = {
    "bet_id": "l_orderkey",
    "line_no": "l_linenumber",
    "game_id": "l_partkey",
    "bet_datetime": "l_shipdate",
    "vertical": "l_linestatus",
    "result": "l_returnflag",
    "wager_amount": "l_extendedprice",
    "price": "l_quantity",
}

SPORTS_BET_COLUMNS = {
    "bet_id": "o_orderkey",
    "player_id": "o_custkey",
    "brand_id": "o_custkey % 5",
    "placed_at": "o_orderdate",
    "championship_id": "substring(o_orderpriority, 1, 1)",
    "event_id": "o_orderkey",
    "market_id": "o_custkey",
    "is_live": "o_orderstatus = 'F'",
}

# Fixed subtype -> type pairs: subtypes 1-3 are deposits (1), 4-5 withdrawals (2).
SUBTYPE_TYPES = ((1, 1), (2, 1), (3, 1), (4, 2), (5, 2))


def _select(columns: dict[str, str]) -> str:
    return ", ".join(f"{expr} AS {name}" for name, expr in columns.items())


EVENTS_CTE = (
    "ev AS (SELECT " + _select(EVENT_COLUMNS)
    + " FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events))"
)
WALLET_CTE = f"wallet AS (SELECT {_select(WALLET_COLUMNS)} FROM orders)"
PLAYERS_CTE = f"players AS (SELECT {_select(PLAYER_COLUMNS)} FROM customer)"
BETS_CTE = f"bets AS (SELECT {_select(BET_COLUMNS)} FROM lineitem)"
SPORTS_CTE = f"sports AS (SELECT {_select(SPORTS_BET_COLUMNS)} FROM orders)"
SUBTYPES_CTE = "subtypes AS (SELECT * FROM (VALUES " + ", ".join(map(str, SUBTYPE_TYPES)) + ") t(subtype_id, type_id))"


def read_table(
    spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str] | None = None, brands: Sequence[int] | None = None
) -> DataFrame:
    """Parquet scan with optional projection and brand predicate."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if brands is not None:
        df = df.filter(F.col("brand_id").isin(list(brands)))
    return df.select(*columns) if columns else df


def split_points(keys: DataFrame, column: str, parts: int) -> list:
    """Values that cut a column into ``parts`` of about the same number of rows, as a sample of its keys tells.

    A value that holds more than one part comes twice.
    """
    at = [i / parts for i in range(1, parts)]
    return (keys.agg(F.percentile_approx(column, at).alias("p")).first()["p"] or []) if at else []


def _literal(value) -> str:
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    return f"DATE '{value.isoformat()}'" if isinstance(value, date) else str(value)


def split_predicates(column: str, points: Sequence) -> list[str]:
    """Conditions of which each row meets just one: below, between and above the points, and null.

    A point that comes twice is a part of its own, apart from its neighbours.
    """
    conditions, lower = [], None
    for point in sorted(set(points)):
        value = _literal(point)
        conditions.append(" AND ".join([*([lower] if lower else []), f"{column} < {value}"]))
        lower = f"{column} >= {value}"
        if list(points).count(point) > 1:
            conditions.append(f"{column} = {value}")
            lower = f"{column} > {value}"
    return [*conditions, lower or f"{column} IS NOT NULL", f"{column} IS NULL"]


def read_in_parts(df: DataFrame, predicates: Sequence[str]) -> DataFrame:
    """The rows of each condition, one scan with its own pushed bounds after the other."""
    return reduce(DataFrame.unionAll, [df.filter(p) for p in predicates])


def read_jdbc_query(spark: SparkSession, url: str, query: str, predicates: Sequence[str] | None = None, **options: str) -> DataFrame:
    """Warehouse scan whose query text runs on the database side, as one task per predicate.

    The driver of the database decides how many rows it fetches at once (``fetchsize``).
    """
    if predicates:
        return spark.read.jdbc(url, f"({query}) part", predicates=list(predicates), properties=options)
    return spark.read.format("jdbc").option("url", url).option("query", query).options(**options).load()


def _mapped(spark, sf_dir, table, columns) -> DataFrame:
    return read_table(spark, sf_dir, table).selectExpr(*[f"{e} AS {n}" for n, e in columns.items()])


def events(spark: SparkSession, sf_dir: str, *topics: str) -> DataFrame:
    """All topics as one long table, ordered by ``(ts, seq)`` per player."""
    raw = read_table(spark, sf_dir, "events")
    if topics:
        kinds = {"players": ["signup"], "logins": ["view"], "wagering": ["click"], "wallet": ["purchase", "error"]}
        raw = raw.filter(F.col("event_type").isin([k for t in topics for k in kinds[t]]))
    with_k = raw.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return with_k.selectExpr(*[f"{e} AS {n}" for n, e in EVENT_COLUMNS.items()])


def wallet(spark, sf_dir) -> DataFrame:
    return _mapped(spark, sf_dir, "orders", WALLET_COLUMNS)


def players(spark, sf_dir) -> DataFrame:
    return _mapped(spark, sf_dir, "customer", PLAYER_COLUMNS)


def bets(spark, sf_dir) -> DataFrame:
    return _mapped(spark, sf_dir, "lineitem", BET_COLUMNS)


def sports_bets(spark, sf_dir) -> DataFrame:
    return _mapped(spark, sf_dir, "orders", SPORTS_BET_COLUMNS)


def bet_owners(spark, sf_dir) -> DataFrame:
    """Which player and brand a bet belongs to."""
    return read_table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS bet_id", "o_custkey AS player_wid", "o_custkey % 5 AS brand_id"
    )


def currencies(spark, sf_dir) -> DataFrame:
    return read_table(spark, sf_dir, "nation").selectExpr("n_nationkey AS currency_id", "n_name AS description", "n_regionkey AS region_id")


def subtypes(spark) -> DataFrame:
    values = ", ".join(map(str, SUBTYPE_TYPES))
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(subtype_id, type_id)")
