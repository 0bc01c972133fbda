"""Queries of the rule checker. Requests are derived from the sign-up events."""

from __future__ import annotations

from pyspark.sql import functions as F

from playerflow.operators import rules as R
from playerflow.plans.registry import query
from playerflow.sources import tables as T

EV = f"WITH {T.EVENTS_CTE}"

UNITS = "CASE k % 6 WHEN 0 THEN 'days' WHEN 1 THEN 'HOURS' WHEN 2 THEN 'weeks' WHEN 3 THEN 'fortnight' WHEN 4 THEN 'month' ELSE 'minutes' END"
URIS = "CASE k % 7 WHEN 0 THEN 'not a uri' ELSE 'https://accept.test/' || CAST(seq AS STRING) END"
# Rule 0 is a counting rule, rule 1 a single-deposit rule; the window start and end vary with k.
SYMBOL0 = "CASE k % 4 WHEN 0 THEN 'moreOrEqual' WHEN 1 THEN '<' WHEN 2 THEN 'more' ELSE 'lessOrEqual' END"
SYMBOL1 = "CASE k % 5 WHEN 0 THEN 'more' WHEN 1 THEN 'equal' WHEN 2 THEN 'lessOrEqual' WHEN 3 THEN 'less' ELSE '>' END"
FROM_DAYS, TO_DAYS = "k % 9", "CASE WHEN k % 13 = 0 THEN -10 WHEN k % 13 = 1 THEN 40 ELSE k % 20 END"


def _requests(spark, sf):
    return requests_of(T.events(spark, sf, "players"))


def requests_of(signups):
    # Timestamps without zone become instants, as the rule windows are in UTC.
    rows = signups.withColumn("at", F.col("ts").cast("timestamp"))
    shift = lambda sign, days: F.timestamp_micros(F.unix_micros("at") + sign * F.expr(days).cast("bigint") * F.lit(86_400_000_000))
    rule = lambda symbol, times, amount: F.struct(
        F.lit("deposit").alias("kind"), F.expr(symbol).alias("symbol"), F.expr(times).cast("int").alias("times"),
        F.expr(amount).cast("string").alias("amount"), shift(-1, FROM_DAYS).alias("from_ts"),
        F.when(F.col("k") % 11 != 0, shift(1, TO_DAYS)).alias("to_ts"), F.array().cast("array<string>").alias("sports"),
    )
    counting = rule(SYMBOL0, "1 + k % 2", "CASE WHEN k % 3 = 0 THEN 20 END")
    single = rule(SYMBOL1, "NULL", "5 + k % 30")
    rules = (
        F.when(F.col("k") % 3 == 0, F.array(counting, single)).when(F.col("k") % 3 == 1, F.array(counting)).otherwise(F.array(single))
    )
    return rows.select(
        F.col("seq").alias("request_id"), "player_id", F.expr(URIS).alias("accept_uri"), F.col("at").alias("requested_at"),
        (1 + F.col("k") % 20).alias("ttl"), F.expr(UNITS).alias("ttl_unit"), rules.alias("rules"),
    )


def _deposits(spark, sf):
    rows = T.events(spark, sf, "wallet")
    return R.valid_deposits(rows.withColumn("transaction_id", F.col("seq")))


DEPOSITS = """d AS (SELECT player_id, seq AS transaction_id, amount, date_trunc('second', ts) AS sec FROM ev
  WHERE starts_with(lower(transaction_type), 'deposit-') AND starts_with(lower(transaction_status), 'complete'))"""
TTL = """CASE k % 6 WHEN 0 THEN ts + (1 + k % 20) * INTERVAL 1 DAY WHEN 1 THEN ts + (1 + k % 20) * INTERVAL 1 HOUR WHEN 2 THEN ts + (1 + k % 20) * INTERVAL 7 DAY
  WHEN 4 THEN ts + (1 + k % 20) * INTERVAL 1 MONTH WHEN 5 THEN ts + (1 + k % 20) * INTERVAL 1 MINUTE END"""
REQUESTS = f"""q AS (SELECT seq AS request_id, player_id, k, ts, {TTL} AS expires_at, {URIS} AS accept_uri, ts - ({FROM_DAYS}) * INTERVAL 1 DAY AS f,
    CASE WHEN k % 11 <> 0 THEN ts + ({TO_DAYS}) * INTERVAL 1 DAY ELSE {TTL} END AS t, CASE WHEN k % 3 = 0 THEN 2 ELSE 1 END AS expected FROM ev WHERE topic = 'players'),
  v AS (SELECT *, CASE WHEN k % 6 = 3 THEN 'unit' WHEN k % 7 = 0 THEN 'uri' WHEN f > t THEN 'window'
    WHEN t - f >= INTERVAL 31 DAY OR epoch(t) - epoch(f) >= 31 * 86400 THEN 'too_long' END AS reason FROM q),
  ok AS (SELECT * FROM v WHERE reason IS NULL),
  r AS (SELECT request_id, player_id, f, t, k, 0 AS rule_no, CASE k % 4 WHEN 0 THEN 'moreOrEqual' WHEN 1 THEN 'less' WHEN 2 THEN 'more' ELSE 'lessOrEqual' END AS symbol,
      1 + k % 2 AS times, CASE WHEN k % 3 = 0 THEN 20 END AS amount FROM ok WHERE k % 3 IN (0, 1)
    UNION ALL SELECT request_id, player_id, f, t, k, CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END, CASE k % 5 WHEN 1 THEN 'equal' WHEN 2 THEN 'lessOrEqual' WHEN 3 THEN 'less' ELSE 'more' END,
      NULL, 5 + k % 30 FROM ok WHERE k % 3 IN (0, 2)),
  m AS (SELECT r.*, d.amount AS paid, d.sec, d.transaction_id FROM r JOIN d ON d.player_id = r.player_id AND d.sec BETWEEN date_trunc('second', f) AND date_trunc('second', t))"""


def _cmp(base, current):
    return f"""CASE symbol WHEN 'more' THEN {current} > {base} WHEN 'less' THEN {current} < {base} WHEN 'equal' THEN {current} = {base}
      WHEN 'moreOrEqual' THEN {current} >= {base} ELSE {current} <= {base} END"""


@query(
    "valid_deposits",
    f"""{EV}, {DEPOSITS} SELECT transaction_id, player_id, amount, strftime(sec, '%Y-%m-%d %H:%M:%S') AS second FROM d""",
)
def valid_deposits(spark, sf):
    return _deposits(spark, sf).select(
        "transaction_id", "player_id", "amount", F.date_format(F.timestamp_seconds("second"), "yyyy-MM-dd HH:mm:ss").alias("second")
    )


@query("normalise_rules", f"""{EV}, {DEPOSITS}, {REQUESTS} SELECT request_id, rule_no, symbol, strftime(f, '%Y-%m-%d %H:%M:%S') AS from_ts, strftime(t, '%Y-%m-%d %H:%M:%S') AS to_ts FROM r""")
def normalise_rules(spark, sf):
    accepted, _ = R.normalise(_requests(spark, sf))
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return accepted.select("request_id", "rule_no", "symbol", text("from_ts"), text("to_ts"))


@query("rejected_rules", f"{EV}, {DEPOSITS}, {REQUESTS} SELECT request_id, reason FROM v WHERE reason IS NOT NULL")
def rejected_rules(spark, sf):
    return R.normalise(_requests(spark, sf))[1]


@query("rule_range_join", f"{EV}, {DEPOSITS}, {REQUESTS} SELECT request_id, rule_no, count(*) AS deposits FROM m GROUP BY 1, 2")
def rule_range_join(spark, sf):
    accepted, _ = R.normalise(_requests(spark, sf))
    facts = R.summarise(R.with_threshold(accepted), _deposits(spark, sf))
    return facts.select("request_id", "rule_no", F.col("n").alias("deposits"))


@query("rule_count_sum", f"{EV}, {DEPOSITS}, {REQUESTS} SELECT request_id, rule_no, count(*) AS n, CAST(sum(CAST(paid AS DECIMAL(18,2))) AS DOUBLE) AS total FROM m WHERE times IS NOT NULL GROUP BY 1, 2")
def rule_count_sum(spark, sf):
    accepted, _ = R.normalise(_requests(spark, sf))
    counted = R.with_threshold(accepted.filter(F.col("times").isNotNull()))
    return R.summarise(counted, _deposits(spark, sf)).select("request_id", "rule_no", "n", "total")


@query(
    "rule_comparators",
    f"""{EV}, s AS (SELECT seq, {SYMBOL1} AS s, k % 30 AS base, floor(amount) AS paid FROM ev WHERE topic = 'wallet')
    SELECT seq, CASE WHEN CASE s WHEN 'equal' THEN paid = base WHEN 'lessOrEqual' THEN paid <= base WHEN 'less' THEN paid < base ELSE paid > base END THEN 1 ELSE 0 END AS met FROM s""",
)
def rule_comparators(spark, sf):
    symbol = F.element_at(F.create_map(*[F.lit(x) for p in R.SYMBOLS.items() for x in p]), F.expr(SYMBOL1))
    met = R.compare(symbol, F.col("k") % 30, F.floor("amount").cast("double"))
    return T.events(spark, sf, "wallet").select("seq", met.cast("int").alias("met"))


FIRED = f"""c AS (SELECT request_id, rule_no, symbol, times, amount, count(*) AS n, CAST(sum(CAST(paid AS DECIMAL(18,2))) AS DOUBLE) AS total FROM m WHERE times IS NOT NULL GROUP BY ALL),
  s1 AS (SELECT request_id, rule_no, NULL AS paid FROM c WHERE {_cmp('times', 'n')} AND (amount IS NULL OR {_cmp('amount', 'total')})),
  s2 AS (SELECT request_id, rule_no, arg_min(paid, {{'a': sec, 'b': transaction_id}}) AS paid FROM m WHERE times IS NULL AND {_cmp('amount', 'paid')} GROUP BY 1, 2),
  met AS (SELECT request_id, count(*) AS met, arg_min(paid, rule_no) AS amount FROM (SELECT * FROM s1 UNION ALL SELECT * FROM s2) GROUP BY 1)"""


@query(
    "evaluate_rules",
    f"{EV}, {DEPOSITS}, {REQUESTS}, {FIRED} SELECT request_id, player_id, accept_uri, amount FROM ok JOIN met USING (request_id) WHERE met = expected",
)
def evaluate_rules(spark, sf):
    accepted, _ = R.normalise(_requests(spark, sf))
    return R.evaluate(accepted, _deposits(spark, sf))


NOW = "2024-01-28 00:00:00"


@query("expired_requests", f"{EV}, {DEPOSITS}, {REQUESTS} SELECT request_id FROM q WHERE expires_at IS NULL OR TIMESTAMP '{NOW}' > expires_at")
def expired_requests(spark, sf):
    return R.expired(_requests(spark, sf), F.lit(NOW).cast("timestamp")).select("request_id")


@query(
    "retire_requests",
    f"""{EV}, {DEPOSITS}, {REQUESTS}, {FIRED} SELECT request_id, player_id FROM q WHERE expires_at IS NOT NULL AND TIMESTAMP '{NOW}' <= expires_at
      AND request_id NOT IN (SELECT request_id FROM ok JOIN met USING (request_id) WHERE met = expected)""",
)
def retire_requests(spark, sf):
    requests = _requests(spark, sf)
    accepted, _ = R.normalise(requests)
    fired = R.evaluate(accepted, _deposits(spark, sf))
    return R.retire(requests, fired, R.expired(requests, F.lit(NOW).cast("timestamp"))).select("request_id", "player_id")


@query(
    "wagered_rules",
    f"""WITH {T.BETS_CTE}, {T.SPORTS_CTE}, r AS (SELECT c_custkey AS player_id, CAST(c_custkey % 1000 AS INT) AS k, TIMESTAMP '1996-01-01 10:00:00' + (c_custkey % 1000) * INTERVAL 1 DAY AS f FROM customer)
    SELECT r.player_id, count(*) AS n, CAST(sum(CAST(wager_amount AS DECIMAL(18,2))) AS DOUBLE) AS total FROM bets JOIN sports USING (bet_id) JOIN r USING (player_id)
    WHERE bet_datetime BETWEEN f AND f + INTERVAL 25 DAY AND (k % 2 = 0 OR championship_id IN ('1', '2')) GROUP BY 1""",
)
def wagered_rules(spark, sf):
    """Rules on wagers: one per player, half of them for listed sports only."""
    start = F.expr("TIMESTAMP '1996-01-01 10:00:00' + make_dt_interval(CAST(c_custkey % 1000 AS INT))")
    sports = F.when(F.col("c_custkey") % 2 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("1"), F.lit("2")))
    rules = T.read_table(spark, sf, "customer").select(
        F.col("c_custkey").alias("request_id"), F.col("c_custkey").alias("player_id"), F.lit(0).alias("rule_no"),
        F.lit(None).cast("int").alias("times"), start.alias("from_ts"), (start + F.expr("INTERVAL 25 DAY")).alias("to_ts"), sports.alias("sports"),
    )
    owners = T.sports_bets(spark, sf).select("bet_id", "player_id", F.col("championship_id").alias("sport_id"))
    per_second = T.bets(spark, sf).select(
        "bet_id", F.unix_seconds(F.col("bet_datetime").cast("timestamp")).alias("second"), F.col("wager_amount").alias("amount")
    )
    return R.wagered(rules, per_second.join(owners.hint("merge"), "bet_id")).select(F.col("request_id").alias("player_id"), "n", "total")
