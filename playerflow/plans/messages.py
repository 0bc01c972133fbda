"""Queries that turn events into messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from playerflow.functions.flags import consent_text, to_bool
from playerflow.operators import profiles as P
from playerflow.operators import triggers as G
from playerflow.plans.profile import W, WB
from playerflow.plans.registry import query
from playerflow.sources import tables as T

EV = f"WITH {T.EVENTS_CTE}"
KIND, STATUS = "lower(coalesce(transaction_type, ''))", "lower(coalesce(transaction_status, ''))"

# Type and status columns with values for the families that the base tables lack.
SHOP = "CASE k % 4 WHEN 0 THEN 'Lucky_Egg' WHEN 1 THEN 'three_deposit_2' WHEN 2 THEN 'withdraw' ELSE 'new_unlock' END"
PLAIN = "CASE k % 3 WHEN 0 THEN 'Deposit' WHEN 1 THEN 'Withdraw' ELSE 'deposit' END"
CODED = "CASE k % 5 WHEN 0 THEN 'dep_declined' WHEN 1 THEN 'dep_success' WHEN 2 THEN 'wd_success' WHEN 3 THEN 'wd_pending' ELSE 'other' END"
ACCEPT = "CASE WHEN k % 2 = 0 THEN 'Accepted' ELSE transaction_status END"


def _in(values):
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _wallet_sql(branches, kind="transaction_type", status="transaction_status"):
    parts = [
        f"SELECT seq, brand_id, player_id, '{selector}' AS selector FROM w WHERE {condition}" for selector, condition in branches
    ]
    return f"{EV}, w AS (SELECT seq, brand_id, player_id, {kind} AS kind, lower({status}) AS status FROM ev WHERE topic = 'wallet') " + " UNION ALL ".join(parts)


def _wallet(name, family, branches, kind="transaction_type", status="transaction_status"):
    @query(name, _wallet_sql(branches, kind, status))
    def run(spark, sf):
        rows = T.events(spark, sf, "wallet").withColumn("kind", F.expr(kind)).withColumn("status", F.expr(status))
        return G.wallet_status_events(rows, family, "kind", "status").select("seq", *P.KEY, "selector")

    return run


_wallet("wallet_status_events", "exact_failed_seven", [
    ("failed_deposit", f"lower(kind) = 'deposit' AND status IN {_in(G.FAILED_SEVEN)}"),
    ("failed_withdrawal", f"lower(kind) = 'withdrawal' AND status IN {_in(G.FAILED_SEVEN)}"),
])
_wallet("wallet_exact_failed_four", "exact_failed_four", [
    ("failed_deposit", f"lower(kind) = 'deposit' AND status IN {_in(G.FAILED_FOUR)}"),
    ("failed_withdrawal", f"lower(kind) = 'withdraw' AND status IN {_in(G.FAILED_FOUR)}"),
], kind=PLAIN)
_wallet("wallet_shop_failed_six", "shop_failed_six", [
    ("failed_deposit", f"lower(kind) IN {_in(G.SHOP_DEPOSITS)} AND status IN {_in(G.FAILED_SIX)}"),
    ("failed_withdrawal", f"lower(kind) = 'withdraw' AND status IN {_in(G.FAILED_SIX)}"),
], kind=SHOP)
_wallet("wallet_prefix_both", "prefix_both", [
    ("failed_deposit", "starts_with(lower(kind), 'deposit_') AND status IN ('rejected', 'agentreject')"),
    ("failed_withdrawal", "starts_with(lower(kind), 'withdraw_') AND status IN ('rejected', 'agentreject')"),
    ("success_withdrawal", "starts_with(lower(kind), 'withdraw_') AND status = 'completed'"),
    ("success_deposit", "starts_with(lower(kind), 'deposit_') AND status = 'completed'"),
])
_wallet("wallet_prefix_failed", "prefix_failed", [
    ("failed_deposit", "starts_with(lower(kind), 'deposit_') AND status = 'failed'"),
    ("failed_withdrawal", "starts_with(lower(kind), 'withdraw_') AND status = 'failed'"),
])
_wallet("wallet_prefix_approved", "prefix_approved", [
    ("DEPOSIT_APPROVED", "starts_with(lower(kind), 'deposit') AND status IN ('completed', 'approved')"),
    ("WITHDRAWAL_APPROVED", "starts_with(lower(kind), 'withdraw') AND status = 'approved'"),
])
_wallet("wallet_not_accepted", "not_accepted", [
    ("failed_deposit", "kind = 'Deposit' AND status <> 'accepted'"),
    ("failed_withdrawal", "kind = 'Withdraw' AND status <> 'accepted'"),
], kind=PLAIN, status=ACCEPT)
_wallet("wallet_coded_status", "coded", [
    ("failed_deposit", "status = 'dep_declined'"),
    ("deposit_success", "status = 'dep_success'"),
    ("withdrawal_approved", "status = 'wd_success'"),
    ("withdrawal_pending", "status = 'wd_pending'"),
], status=CODED)
_wallet("wallet_any_status", "any", [
    ("deposit_event", "starts_with(lower(kind), 'deposit')"),
    ("withdrawal_event", "starts_with(lower(kind), 'withdraw')"),
])


@query(
    "trigger_purchases",
    f"""{EV}, w AS (SELECT seq, brand_id, player_id, {SHOP} AS kind, transaction_status AS status FROM ev WHERE topic = 'wallet')
    SELECT seq, brand_id, player_id, kind AS selector FROM w WHERE lower(kind) IN {_in(G.TRIGGER_PURCHASES)} AND lower(status) = 'successful'""",
)
def trigger_purchases(spark, sf):
    rows = T.events(spark, sf, "wallet").withColumn("kind", F.expr(SHOP))
    return G.trigger_purchases(rows, "kind").select("seq", *P.KEY, "selector")


@query("big_win", f"{EV} SELECT seq, brand_id, player_id, win_amount FROM ev WHERE topic = 'wagering' AND win_amount > 1000")
def big_win(spark, sf):
    return G.big_win(T.events(spark, sf, "wagering"), "win_amount", strict=True).select("seq", *P.KEY, "win_amount")


@query(
    "big_win_settled",
    f"{EV} SELECT seq, brand_id, player_id, win_amount FROM ev WHERE topic = 'wagering' AND win_amount >= 1000 AND result_id = '1' AND has_resulted IN ('true', '1')",
)
def big_win_settled(spark, sf):
    rows = T.events(spark, sf, "wagering")
    hits = G.big_win(rows, "win_amount", won=F.col("result_id") == "1", settled=to_bool(F.col("has_resulted")))
    return hits.select("seq", *P.KEY, "win_amount")


@query(
    "big_win_ggr",
    f"{EV} SELECT seq, brand_id, player_id, ggr_amount FROM ev WHERE topic = 'wagering' AND ggr_amount >= 1000 AND result_id = '1' AND has_resulted IN ('true', '1')",
)
def big_win_ggr(spark, sf):
    rows = T.events(spark, sf, "wagering")
    hits = G.big_win(rows, "ggr_amount", won=F.col("result_id") == "1", settled=to_bool(F.col("has_resulted")))
    return hits.select("seq", *P.KEY, "ggr_amount")


def _withdrawal(name, selector, condition):
    @query(
        name,
        f"{EV} SELECT seq, brand_id, player_id, amount FROM ev WHERE starts_with(lower(transaction_type), 'withdraw') AND amount IS NOT NULL AND {condition}",
    )
    def run(spark, sf):
        rows = G.withdrawal_requests(T.events(spark, sf, "wallet"))
        return rows.filter(F.col("selector") == selector).select("seq", *P.KEY, "amount")


_withdrawal("withdrawal_request", "withdrawal_request", "lower(transaction_status) = 'pending'")
_withdrawal("withdrawal_request_cancel", "withdrawal_cancel", "starts_with(lower(transaction_status), 'cancel')")


@query(
    "first_deposit_completed",
    f"{EV} SELECT seq, brand_id, player_id FROM ev WHERE lifetime_count = 1 AND transaction_status = 'complete'",
)
def first_deposit_completed(spark, sf):
    return G.first_deposit_completed(T.events(spark, sf, "wallet")).select("seq", *P.KEY)


BONUS = "CASE k % 4 WHEN 0 THEN 'deposit' WHEN 1 THEN 'manual' WHEN 2 THEN 'welcome' END"


@query("bonus_released", f"{EV} SELECT seq, brand_id, player_id, {BONUS} AS bonus_type FROM ev WHERE topic = 'wallet' AND k % 4 < 2")
def bonus_released(spark, sf):
    rows = T.events(spark, sf, "wallet").withColumn("bonus_type", F.expr(BONUS))
    return G.bonus_released(rows, "bonus_type").select("seq", *P.KEY, "bonus_type")


def _notice(name, selector, statuses):
    @query(
        name,
        f"""{EV} SELECT seq, brand_id, player_id, substring(blocked_start, 1, 10) AS start_date,
          CASE WHEN blocked_end IS NULL OR trim(blocked_end) = '' THEN strftime(CAST(blocked_start AS DATE) + INTERVAL 7300 DAY, '%Y-%m-%d') ELSE substring(blocked_end, 1, 10) END AS end_date
        FROM ev WHERE blocked_start IS NOT NULL AND player_status IN {_in(statuses)}""",
    )
    def run(spark, sf):
        rows = G.exclusion_notices(T.events(spark, sf, "players"))
        return rows.filter(F.col("selector") == selector).select("seq", *P.KEY, "start_date", "end_date")


_notice("self_exclusion_notice", "self_exclusion_communication", ("2", "3"))
_notice("timeout_notice", "timeout_communication", ("1",))


@query(
    "status_to_block",
    f"""{EV} SELECT seq, brand_id, player_id, CASE player_status WHEN '1' THEN 'false' ELSE 'true' END AS blocked
    FROM ev WHERE player_status IN ('1', '2', '3', '4', '5')""",
)
def status_to_block(spark, sf):
    return G.status_to_block(T.events(spark, sf, "players"), F.col("player_status")).select("seq", *P.KEY, "blocked")


@query(
    "block_by_end_date",
    f"""{EV} SELECT seq, brand_id, player_id, CASE WHEN trim(blocked_end) <> '' THEN substring(blocked_end, 1, 10) END AS blocked_until,
      CASE WHEN trim(blocked_end) <> '' THEN 'self_exclusion' ELSE 'player_blocked' END AS selector FROM ev WHERE topic = 'players'""",
)
def block_by_end_date(spark, sf):
    rows = G.block_by_end_date(T.events(spark, sf, "players"), F.col("blocked_end"))
    return rows.select("seq", *P.KEY, "blocked_until", "selector")


@query(
    "block_by_flag",
    f"""{EV}, s AS (SELECT seq, brand_id, player_id, is_self_excluded AS x, last_value({{'v': is_self_excluded}}) OVER {WB} AS p, FROM ev WHERE topic = 'players')
    SELECT seq, brand_id, player_id, CASE x WHEN 'true' THEN '2040-01-01' ELSE '2020-01-01' END AS blocked_until FROM s WHERE x IS NOT NULL AND x IS DISTINCT FROM p.v""",
)
def block_by_flag(spark, sf):
    return G.block_by_flag(T.events(spark, sf, "players"), "is_self_excluded").select("seq", *P.KEY, "blocked_until")


@query(
    "classify_status",
    f"""{EV} SELECT seq, CASE WHEN player_status = '1' THEN '1' WHEN is_self_excluded = 'true' THEN 'self-exclusion'
      WHEN player_status = '2' AND k % 3 = 0 THEN '2-playbreak' WHEN player_status IN ('2','3','4','5') THEN 'blocked' END AS status_class
    FROM ev WHERE topic = 'players'""",
)
def classify_status(spark, sf):
    play_break = F.when(F.col("k") % 3 == 0, "1").otherwise("0")
    status = G.classify_status(F.col("player_status"), F.col("is_self_excluded"), play_break)
    return T.events(spark, sf, "players").select("seq", status.alias("status_class"))


FRESH_LOGIN = "CAST(login_datetime AS TIMESTAMP) > ts - INTERVAL 30 DAY"


def _login(name, condition, **options):
    @query(name, f"{EV} SELECT seq, brand_id, player_id, substring(login_datetime, 1, 10) AS login_date FROM ev WHERE topic = 'logins' AND {condition}")
    def run(spark, sf):
        return G.login_events(T.events(spark, sf, "logins"), **options).select("seq", *P.KEY, "login_date")


_login("login_events", "true")
_login("login_events_recent", FRESH_LOGIN, max_age_days=30)
_login("login_events_successful", "login_success = 'true'", only_successful=True)


@query(
    "activity_gate_30d",
    f"{EV} SELECT seq, brand_id, player_id, bet_datetime FROM ev WHERE topic = 'wagering' AND CAST(bet_datetime AS TIMESTAMP) > ts - INTERVAL 30 DAY",
)
def activity_gate_30d(spark, sf):
    return G.activity_gate(T.events(spark, sf, "wagering"), "bet_datetime").select("seq", *P.KEY, "bet_datetime")


ACTIVITY = "CASE k % 11 " + " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(G.ACTIVITIES)) + " ELSE 'Other' END"


# The columns these tables have for the activity records, as SQL text.
RECORD = {
    "country": "CASE country_id % 3 WHEN 0 THEN 'fr' WHEN 1 THEN 'gb' END",
    "signup_language": "language",
    "emailAddress": "email",
    "account_creation_date": "reg_datetime",
    "player_tags": "CASE WHEN k % 2 = 0 THEN 'tag' || CAST(k AS STRING) END",
    "is_abuser": "is_self_excluded",
    "last_login_date": "dt",
    "last_deposit_date": "first_dep_datetime",
    "is_blocked": "is_verified",
    "is_self_excluded": "is_self_excluded",
    "FPP_CUSTOMER_LEVEL": "vip_level",
    "consent_marketingemail": "consented",
    "real_money_balance": "CAST(k AS STRING)",
}


def _record_sql(columns):
    cut = lambda c: f"substring({RECORD[c]}, 1, 10)" if c.endswith("_date") else RECORD[c]
    pairs = [f"""'"{c}":"' || {cut(c)} || '"'""" for c in columns if c in RECORD]
    ids = ["""'"original_id":"' || CAST(player_id AS STRING) || '"'""", """'"brand_id":"' || CAST(brand_id AS STRING) || '"'"""]
    return "'{' || concat_ws(',', " + ", ".join([*ids, *pairs]) + ") || '}'"


@query(
    "activity_dispatch",
    f"""{EV}, a AS (SELECT *, {ACTIVITY} AS activity FROM ev), m(activity, msg_type, selector) AS (VALUES
      {", ".join(f"('{n}', '{t}', '{s}')" for n, (t, s) in G.ACTIVITIES.items())})
    SELECT seq, brand_id, player_id, msg_type, selector, CASE activity {" ".join(f"WHEN '{n}' THEN {_record_sql(c)}" for n, c in G.ACTIVITY_COLUMNS.items())} END AS properties,
      CASE WHEN activity = 'Customer Blocks' THEN CASE WHEN lower(is_verified) = 'true' THEN 'true' ELSE 'false' END END AS blocked FROM a JOIN m USING (activity)""",
)
def activity_dispatch(spark, sf):
    columns = [f"{e} AS {n}" for n, e in RECORD.items()]
    rows = T.events(spark, sf).selectExpr("seq", *P.KEY, f"{ACTIVITY} AS activity", *columns)
    return G.activity_dispatch(rows, "activity").select("seq", *P.KEY, "msg_type", "selector", "properties", "blocked")


@query("sport_push", f"{EV} SELECT seq, brand_id, player_id, 'sportsPush_' || result_id AS selector FROM ev WHERE topic = 'wagering'")
def sport_push(spark, sf):
    return G.sport_push(T.events(spark, sf, "wagering"), "result_id").select("seq", *P.KEY, "selector")


ACTION = "CASE k % 8 WHEN 0 THEN 'withdrawal' WHEN 1 THEN 'email_verification' WHEN 2 THEN 'deposit' WHEN 3 THEN 'self_exclusion' WHEN 4 THEN 'panic_button' WHEN 5 THEN 'forgot_password' WHEN 6 THEN 'reg_resend' ELSE 'reset_password' END"
ACTION_VALUE = "CASE k % 5 WHEN 0 THEN 'SUCCESS' WHEN 1 THEN 'IN_PROGRESS' WHEN 2 THEN 'TRUE' WHEN 3 THEN 'x' END"


@query(
    "action_triggers",
    f"""{EV}, a AS (SELECT seq, brand_id, player_id, {ACTION} AS action, {ACTION_VALUE} AS v FROM ev WHERE topic = 'logins')
    SELECT seq, brand_id, player_id, 'player_action_triggers_' || CASE action WHEN 'withdrawal' THEN CASE v WHEN 'SUCCESS' THEN 'withdrawal_success' ELSE 'withdrawal_in_progress' END ELSE action END AS selector
    FROM a WHERE (action = 'withdrawal' AND v IN ('SUCCESS', 'IN_PROGRESS')) OR (action IN ('email_verification', 'forgot_password') AND v IS NOT NULL)
      OR (action = 'deposit' AND v = 'SUCCESS') OR (action IN ('self_exclusion', 'panic_button') AND v = 'TRUE')""",
)
def action_triggers(spark, sf):
    rows = T.events(spark, sf, "logins").withColumn("action", F.expr(ACTION)).withColumn("v", F.expr(ACTION_VALUE))
    return G.action_triggers(rows, "action", "v").select("seq", *P.KEY, "selector")


@query(
    "action_triggers_resend",
    f"""{EV}, a AS (SELECT seq, brand_id, player_id, {ACTION} AS action FROM ev WHERE topic = 'logins')
    SELECT seq, brand_id, player_id, CASE action WHEN 'reg_resend' THEN 'player_action_triggers_resend_email_verification' ELSE 'player_action_triggers_reset_password' END AS selector
    FROM a WHERE action IN ('reg_resend', 'reset_password')""",
)
def action_triggers_resend(spark, sf):
    rows = T.events(spark, sf, "logins").withColumn("action", F.expr(ACTION)).withColumn("v", F.lit(None).cast("string"))
    return G.action_triggers(rows, "action", "v", G.RESEND_TRIGGERS).select("seq", *P.KEY, "selector")


FACTORS = {f"sf_{n}": f"CASE WHEN k % {i + 3} <> 0 THEN (k + {i}) / 10.0 END" for i, n in enumerate(
    ("inplay", "inplay_casino", "inplay_livecasino", "inplay_lottery", "inplay_virtualsports",
     "prematch", "prematch_casino", "prematch_livecasino", "prematch_lottery", "prematch_virtualsports"))}
FACTOR_SQL = {n: e.replace("/ 10.0", "/ CAST(10 AS DOUBLE)") for n, e in FACTORS.items()}


@query(
    "stake_factors",
    f"""{EV}, f AS (SELECT seq, ts, brand_id, player_id, {", ".join(f"{e} AS {n}" for n, e in FACTOR_SQL.items())} FROM ev WHERE topic = 'wagering')
    SELECT seq, brand_id, player_id, {", ".join(f"last_value({n} IGNORE NULLS) OVER (PARTITION BY brand_id, player_id ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {n}" for n in FACTORS)} FROM f""",
)
def stake_factors(spark, sf):
    fields = {n: F.expr(e) for n, e in FACTOR_SQL.items()}
    return P.merge(T.events(spark, sf, "wagering"), fields).select("seq", *P.KEY, *FACTORS)




@query(
    "journey_events",
    f"""{EV} SELECT seq, CASE k % 5 WHEN 3 THEN 'unknown' ELSE 'p' || CAST(player_id AS STRING) END AS contact_id,
      CASE k % 5 WHEN 3 THEN 'unknownsel' ELSE 'sel' END AS selector, CASE k % 5 WHEN 0 THEN 'uK' WHEN 1 THEN 'br' ELSE 'fr' END AS country
    FROM ev WHERE topic = 'logins' AND k % 5 IN (0, 1, 3)""",
)
def journey_events(spark, sf):
    # Text parameters carry one more level of JSON escaping than objects.
    user = F.col("player_id").cast("string")
    body = lambda inner: F.concat(F.lit('{"mappingSelector":"sel","parameters":'), inner, F.lit("}"))
    known = lambda country: F.concat(F.lit('{"notification_PLAYER_ID":"p'), user, F.lit(f'","country":"{country}"}}'))
    as_text = lambda text: F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('\\"')), F.lit('"'))
    raw = (
        F.when(F.col("k") % 5 == 0, body(known("uK")))
        .when(F.col("k") % 5 == 1, body(as_text(known("br"))))
        .when(F.col("k") % 5 == 2, body(F.lit('""')))
        .when(F.col("k") % 5 == 3, body(F.lit('{"country":"fr"}')))
        .otherwise(body(F.lit('" "')))
    )
    rows = G.journey_events(T.events(spark, sf, "logins").withColumn("raw", raw), "raw")
    return rows.select("seq", "contact_id", "selector", F.get_json_object("properties", "$.country").alias("country"))


ACCOUNT = "CASE k % 9 WHEN 0 THEN 'PURGE' WHEN 1 THEN 'Purge' ELSE 'open' END"


@query("purge_events", f"{EV} SELECT seq, brand_id, player_id FROM ev WHERE topic = 'players' AND k % 9 < 2")
def purge_events(spark, sf):
    rows = T.events(spark, sf, "players").withColumn("account_status", F.expr(ACCOUNT))
    return G.purge_events(rows, "account_status").select("seq", *P.KEY)


@query(
    "consent_passthrough",
    f"{EV} SELECT seq, brand_id, player_id, channel, CASE consented WHEN '1' THEN 'true' WHEN '0' THEN 'false' END AS consented FROM ev WHERE topic = 'players'",
)
def consent_passthrough(spark, sf):
    rows = T.events(spark, sf, "players")
    return rows.select("seq", *P.KEY, "channel", consent_text(F.col("consented")).alias("consented"))


@query(
    "ingest_lag_alert",
    f"""{EV} SELECT seq, CAST(epoch(date_trunc('second', ts + k * INTERVAL 1 SECOND)) AS BIGINT) - CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS lag_seconds
    FROM ev WHERE k >= 30""",
)
def ingest_lag_alert(spark, sf):
    rows = T.events(spark, sf).withColumn("processed", F.expr("ts + make_dt_interval(0, 0, 0, k)"))
    return G.ingest_lag(rows, F.col("processed"), F.col("ts")).select("seq", "lag_seconds")


@query(
    "consent_passthrough_text",
    f"{EV} SELECT seq, brand_id, player_id, upper(channel) AS channel, lower(consented) AS consented FROM ev WHERE topic = 'players' AND channel IS NOT NULL AND consented IS NOT NULL",
)
def consent_passthrough_text(spark, sf):
    rows = T.events(spark, sf, "players").filter(F.col("channel").isNotNull() & F.col("consented").isNotNull())
    return rows.select("seq", *P.KEY, F.upper("channel").alias("channel"), F.lower("consented").alias("consented"))


@query(
    "brand_own_messages",
    f"""{EV}, p AS (SELECT seq, brand_id, player_id, row_number() OVER (PARTITION BY brand_id, player_id ORDER BY ts, seq) AS rn,
        last_value(email IGNORE NULLS) OVER {W} AS now_email, last_value(email IGNORE NULLS) OVER {WB} AS old_email FROM ev WHERE brand_id IN (3, 4) AND topic = 'players')
    SELECT seq, brand_id, player_id, 'player_registered' AS selector FROM p WHERE rn = 1 OR now_email IS DISTINCT FROM old_email
    UNION ALL SELECT seq, brand_id, player_id, 'player_login' FROM p
    UNION ALL SELECT seq, brand_id, player_id, 'kyc' FROM ev WHERE brand_id IN (3, 4) AND topic = 'logins'
    UNION ALL SELECT seq, brand_id, player_id, CASE WHEN starts_with(lower(transaction_type), 'deposit') THEN 'deposit_event' ELSE 'withdrawal_event' END FROM ev
      WHERE brand_id IN (3, 4) AND topic = 'wallet' AND (starts_with(lower(transaction_type), 'deposit') OR starts_with(lower(transaction_type), 'withdraw'))""",
)
def brand_own_messages(spark, sf):
    """Two brands with projections of their own; login events stand for identity checks here."""
    topic = F.col("topic")
    return P.own_brand_messages(T.events(spark, sf), (3, 4), {"email": F.col("email")}, topic == "players", topic == "logins")


OUT = ("email", "language", "is_self_excluded")


def _state_pairs(**columns):
    return ", ".join(f"last_value({e} IGNORE NULLS) OVER {W} AS {n}, last_value({e} IGNORE NULLS) OVER {WB} AS p_{n}" for n, e in columns.items())


@query(
    "player_messages",
    f"""{EV}, s AS (SELECT seq, brand_id, player_id, topic, player_status, {_state_pairs(
        email="email", language="language", is_self_excluded="is_self_excluded", is_verified="is_verified", first_dep="first_dep_datetime",
        failed="CASE WHEN transaction_status = 'decline' THEN dt END",
        c_email="CASE WHEN upper(channel) = 'EMAIL' THEN consented END", c_sms="CASE WHEN upper(channel) = 'SMS' THEN consented END")},
      count(*) FILTER (WHERE topic = 'players') OVER {WB} AS seen,
      last_value(CASE WHEN topic = 'players' THEN CASE WHEN player_status IN ('1','2','3') AND blocked_start IS NOT NULL THEN player_status WHEN player_status IS NULL THEN 'x' END END IGNORE NULLS) OVER {WB} AS stored
      FROM ev WHERE topic IN ('players', 'wallet'))
    SELECT seq, brand_id, player_id, CASE WHEN seen = 0 THEN 'player_registration' ELSE 'player_updated' END AS selector FROM s
      WHERE topic = 'players' AND (seen = 0 OR {" OR ".join(f"{c} IS DISTINCT FROM p_{c}" for c in OUT)})
    UNION ALL SELECT seq, brand_id, player_id, 'user_blocked_toggle' FROM s WHERE topic = 'players' AND (seen = 0 OR is_self_excluded IS DISTINCT FROM p_is_self_excluded)
    UNION ALL SELECT seq, brand_id, player_id, 'player_email_change_request' FROM s WHERE email <> p_email
    UNION ALL SELECT seq, brand_id, player_id, 'player_isverified' FROM s WHERE lower(is_verified) = 'true' AND coalesce(lower(trim(p_is_verified)), '') IN ('', 'false')
    UNION ALL SELECT seq, brand_id, player_id, 'first_deposit' FROM s WHERE first_dep IS NOT NULL AND p_first_dep IS NULL
    UNION ALL SELECT seq, brand_id, player_id, 'failed_deposit' FROM s WHERE failed IS NOT NULL AND failed IS DISTINCT FROM p_failed
    UNION ALL SELECT seq, brand_id, player_id, 'self_exclusion_expired' FROM s WHERE topic = 'players' AND player_status IS NULL AND stored = '3'
    UNION ALL SELECT seq, brand_id, player_id, 'timeout_expired' FROM s WHERE topic = 'players' AND player_status IS NULL AND stored = '1'
    UNION ALL SELECT seq, brand_id, player_id, 'consent_change_email' FROM s WHERE c_email IS DISTINCT FROM p_c_email
    UNION ALL SELECT seq, brand_id, player_id, 'consent_change_sms' FROM s WHERE c_sms IS DISTINCT FROM p_c_sms""",
)
def player_messages(spark, sf):
    """Every state-driven message of a feed with one shuffle."""
    return P.player_messages(T.events(spark, sf, "players", "wallet"), OUT).select("seq", *P.KEY, "selector")
