"""Queries over player state: merges, changes, milestones."""

from __future__ import annotations

from pyspark.sql import functions as F

from playerflow.functions.text import date10
from playerflow.operators import consents as C
from playerflow.operators import profiles as P
from playerflow.operators.lifetime import average_deposit
from playerflow.operators.timeline import latest_values
from playerflow.plans.registry import query
from playerflow.session import run_dir
from playerflow.sources import outbox as O
from playerflow.sources import tables as T

EV = f"WITH {T.EVENTS_CTE}"
W = "(PARTITION BY brand_id, player_id ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
WB = "(PARTITION BY brand_id, player_id ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
WO = "(PARTITION BY brand_id, player_id ORDER BY ts, seq)"


def _after(expr):
    return f"last_value({expr} IGNORE NULLS) OVER {W}"


def _before(expr):
    return f"last_value({expr} IGNORE NULLS) OVER {WB}"


def _cols(*names):
    return {n: F.col(n) for n in names}


FIELDS = ("email", "phone", "language", "country_id", "reg_datetime", "is_self_excluded", "player_status", "balance", "login_datetime")
OUTWARD = ("email", "language", "is_self_excluded")


@query(
    "profile_merge",
    f"{EV} SELECT seq, brand_id, player_id, " + ", ".join(f"{_after(c)} AS {c}" for c in FIELDS) + " FROM ev",
)
def profile_merge(spark, sf):
    return P.merge(T.events(spark, sf), _cols(*FIELDS)).select("seq", *P.KEY, *FIELDS)


BLANKABLE = ("email", "phone", "language")


@query(
    "profile_merge_skip_blank",
    f"{EV} SELECT seq, brand_id, player_id, "
    + ", ".join(_after(f"CASE WHEN trim({c}) <> '' THEN {c} END") + f" AS {c}" for c in BLANKABLE) + " FROM ev",
)
def profile_merge_skip_blank(spark, sf):
    return P.merge(T.events(spark, sf), _cols(*BLANKABLE), skip_blank=True).select("seq", *P.KEY, *BLANKABLE)


@query(
    "profile_merge_overwrite",
    f"""{EV} SELECT seq, brand_id, player_id,
      {_after("CASE WHEN topic = 'players' THEN {'v': vip_level} END")}.v AS vip_level,
      {_after("email")} AS email FROM ev""",
)
def profile_merge_overwrite(spark, sf):
    rows = P.running(
        T.events(spark, sf), P.KEY, P.ORDER,
        after={"vip": P.overwriting(F.col("topic") == "players", F.col("vip_level")), "email": P.Last(F.col("email"))},
    )
    return rows.select("seq", *P.KEY, F.col("vip.v").alias("vip_level"), "email")


@query(
    "latest_balance_by_event_time",
    f"""{EV}, r AS (SELECT *, row_number() OVER (PARTITION BY brand_id, player_id ORDER BY coalesce(bet_datetime, '') DESC, seq) AS rn
      FROM ev WHERE topic = 'wagering') SELECT brand_id, player_id, seq, bet_datetime, balance FROM r WHERE rn = 1""",
)
def latest_balance_by_event_time(spark, sf):
    return P.latest_by_text_time(T.events(spark, sf, "wagering"), "bet_datetime", ["balance"]).select(
        *P.KEY, "seq", "bet_datetime", "balance"
    )


@query(
    "latest_balance_by_arrival",
    f"""{EV} SELECT brand_id, player_id, arg_max(balance, seq) AS balance FROM ev WHERE balance IS NOT NULL GROUP BY 1, 2""",
)
def latest_balance_by_arrival(spark, sf):
    return P.latest_by_arrival(T.events(spark, sf), ["balance"])


@query(
    "last_successful_login",
    f"{EV} SELECT brand_id, player_id, arg_max(login_datetime, seq) AS last_login FROM ev WHERE login_success = 'true' GROUP BY 1, 2",
)
def last_successful_login(spark, sf):
    logins = T.events(spark, sf, "logins").filter(F.col("login_success") == "true")
    return latest_values(logins, P.KEY, P.ORDER, {"last_login": F.col("login_datetime")})


def _changes_sql(table_filter, condition, extra="", columns=OUTWARD):
    state = ", ".join(f"{_after(c)} AS {c}, {_before(c)} AS prior_{c}" for c in columns)
    return f"""{EV}, s AS (SELECT seq, brand_id, player_id, {state}, row_number() OVER {WO} AS rn {extra} FROM ev {table_filter})
    SELECT seq, brand_id, player_id, {", ".join(columns)} FROM s WHERE {condition}"""


DIFF = "(" + " OR ".join(f"{c} IS DISTINCT FROM prior_{c}" for c in OUTWARD) + ")"


@query("profile_changes", _changes_sql("", f"rn = 1 OR {DIFF}"))
def profile_changes(spark, sf):
    return P.profile_changes(T.events(spark, sf), _cols(*OUTWARD)).select("seq", *P.KEY, *OUTWARD)


@query(
    "profile_changes_after_full_record",
    _changes_sql("", f"coalesce(full_before, 0) > 0 AND {DIFF}", f", count(*) FILTER (WHERE topic = 'players' AND k % 2 = 0) OVER {WB} AS full_before"),
)
def profile_changes_after_full_record(spark, sf):
    full = (F.col("topic") == "players") & (F.col("k") % 2 == 0)
    return P.profile_changes(T.events(spark, sf), _cols(*OUTWARD), full).select("seq", *P.KEY, *OUTWARD)


@query("dedup_unchanged", _changes_sql("WHERE topic = 'players'", f"rn = 1 OR {DIFF}"))
def dedup_unchanged(spark, sf):
    return P.profile_changes(T.events(spark, sf, "players"), _cols(*OUTWARD)).select("seq", *P.KEY, *OUTWARD)


@query(
    "registration_or_update",
    f"""{EV} SELECT seq, brand_id, player_id, CASE WHEN row_number() OVER {WO} = 1 THEN 'player_registration' ELSE 'player_updated' END AS selector
    FROM ev WHERE topic = 'players'""",
)
def registration_or_update(spark, sf):
    return P.registration_or_update(T.events(spark, sf, "players")).select("seq", *P.KEY, "selector")


def _first_sql(column, fresh):
    keep = f"AND CAST({column} AS TIMESTAMP) > ts - INTERVAL 1 DAY" if fresh else ""
    return f"""{EV}, f AS (SELECT *, row_number() OVER {WO} AS rn FROM ev WHERE {column} IS NOT NULL)
    SELECT seq, brand_id, player_id, {column} FROM f WHERE rn = 1 {keep}"""


@query("registration_fresh", _first_sql("reg_datetime", True))
def registration_fresh(spark, sf):
    return P.first_known(T.events(spark, sf, "players"), "reg_datetime", 86400).select("seq", *P.KEY, "reg_datetime")


@query("first_deposit", _first_sql("first_dep_datetime", False))
def first_deposit(spark, sf):
    return P.first_known(T.events(spark, sf, "players"), "first_dep_datetime").select("seq", *P.KEY, "first_dep_datetime")


@query("first_deposit_fresh", _first_sql("first_dep_datetime", True))
def first_deposit_fresh(spark, sf):
    return P.first_known(T.events(spark, sf, "players"), "first_dep_datetime", 86400).select("seq", *P.KEY, "first_dep_datetime")


@query(
    "registration_needs_email",
    f"""{EV}, s AS (SELECT seq, brand_id, player_id, {_after("CASE WHEN trim(email) <> '' THEN email END")} AS email, {_before("CASE WHEN trim(email) <> '' THEN email END")} AS prior_email,
      {_after("CASE WHEN trim(language) <> '' THEN language END")} AS language, {_before("CASE WHEN trim(language) <> '' THEN language END")} AS prior_language, row_number() OVER {WO} AS rn
      FROM ev WHERE topic = 'players'),
    c AS (SELECT * FROM s WHERE email IS NOT NULL AND (rn = 1 OR email IS DISTINCT FROM prior_email OR language IS DISTINCT FROM prior_language))
    SELECT seq, brand_id, player_id, 'player_updated' AS selector, '' AS channel, email FROM c WHERE prior_email IS NOT NULL
    UNION ALL SELECT seq, brand_id, player_id, m.selector, m.channel, email FROM c,
      (VALUES ('player_registration', ''), ('player_consent', 'SMS'), ('player_consent', 'EMAIL')) m(selector, channel) WHERE prior_email IS NULL""",
)
def registration_needs_email(spark, sf):
    rows = P.registration_needs_email(T.events(spark, sf, "players"), _cols("email", "language"))
    return rows.select("seq", *P.KEY, "selector", "channel", "email")


@query(
    "first_last_deposit_withdrawal",
    f"""{EV}, s AS (SELECT *, lower(transaction_type) AS kind,
      {_before("CASE WHEN topic = 'wallet' AND lower(transaction_type) = 'deposit' THEN {'v': dt} WHEN topic = 'players' AND k % 9 < 2 THEN {'v': first_dep_datetime} END")}.v AS had_dep,
      {_before("CASE WHEN topic = 'wallet' AND lower(transaction_type) = 'withdrawal' THEN {'v': dt} WHEN topic = 'players' AND k % 9 < 2 THEN {'v': CAST(NULL AS STRING)} END")}.v AS had_wd FROM ev)
    SELECT seq, brand_id, player_id, amount, 'FIRST_DEPOSIT' AS selector FROM s WHERE kind LIKE '%deposit%' AND had_dep IS NULL
    UNION ALL SELECT seq, brand_id, player_id, amount, 'LAST_DEPOSIT' FROM s WHERE kind LIKE '%deposit%'
    UNION ALL SELECT seq, brand_id, player_id, amount, 'FIRST_WITHDRAWAL' FROM s WHERE kind LIKE '%withdrawal%' AND had_wd IS NULL
    UNION ALL SELECT seq, brand_id, player_id, amount, 'LAST_WITHDRAWAL' FROM s WHERE kind LIKE '%withdrawal%'""",
)
def first_last_deposit_withdrawal(spark, sf):
    history = (F.col("topic") == "players") & (F.col("k") % 9 < 2)
    return P.first_last_wallet(T.events(spark, sf, "players", "wallet"), history)


def _once_sql(flag):
    return f"""{EV}, s AS (SELECT *, {_after(flag)} AS flag, {_after("reg_datetime")} AS reg FROM ev WHERE topic = 'players'),
    q AS (SELECT *, row_number() OVER {WO} AS rn FROM s WHERE lower(flag) = 'true' AND substring(reg, 1, 10) >= '2023-12-20')
    SELECT seq, brand_id, player_id FROM q WHERE rn = 1"""


@query("once_flags", _once_sql("phone_confirmed"))
def once_flags(spark, sf):
    return P.confirmed_once(T.events(spark, sf, "players"), "phone_confirmed", "2023-12-20").select("seq", *P.KEY)


@query("once_flags_email", _once_sql("email_confirmed"))
def once_flags_email(spark, sf):
    return P.confirmed_once(T.events(spark, sf, "players"), "email_confirmed", "2023-12-20").select("seq", *P.KEY)


@query(
    "verified_events",
    f"""{EV}, s AS (SELECT seq, brand_id, player_id, {_after("is_verified")} AS is_verified, {_before("is_verified")} AS was FROM ev WHERE topic = 'players')
    SELECT seq, brand_id, player_id FROM s WHERE lower(is_verified) = 'true' AND (was IS NULL OR lower(trim(was)) IN ('', 'false'))""",
)
def verified_events(spark, sf):
    return P.verified_events(T.events(spark, sf, "players"), "is_verified").select("seq", *P.KEY)


@query(
    "first_deposit_loss",
    f"""{EV}, f AS (SELECT *, row_number() OVER {WO} AS rn FROM ev WHERE balance < 5 AND lifetime_count = 1)
    SELECT seq, brand_id, player_id, balance FROM f WHERE rn = 1""",
)
def first_deposit_loss(spark, sf):
    return P.first_deposit_loss(T.events(spark, sf, "wallet", "wagering")).select("seq", *P.KEY, "balance")


@query(
    "crypto_deposit_once",
    f"""{EV}, f AS (SELECT *, row_number() OVER (PARTITION BY brand_id, player_id, transaction_id ORDER BY ts, seq) AS rn FROM ev
      WHERE lower(transaction_type) LIKE '%deposit%' AND transaction_status = 'complete'
      AND regexp_matches(lower(pay_method), '{"|".join(P.CRYPTO_METHODS)}'))
    SELECT seq, brand_id, player_id, transaction_id, amount FROM f WHERE rn = 1""",
)
def crypto_deposit_once(spark, sf):
    return P.crypto_deposit_once(T.events(spark, sf, "wallet")).select("seq", *P.KEY, "transaction_id", "amount")


@query(
    "block_toggle",
    f"""{EV}, s AS (SELECT seq, brand_id, player_id, {_after("is_self_excluded")} AS x, {_before("is_self_excluded")} AS px, row_number() OVER {WO} AS rn
      FROM ev WHERE topic = 'players')
    SELECT seq, brand_id, player_id, CASE WHEN x IN ('true', '1') THEN 'true' ELSE 'false' END AS blocked FROM s WHERE rn = 1 OR x IS DISTINCT FROM px""",
)
def block_toggle(spark, sf):
    rows = P.transitions(T.events(spark, sf, "players"), _cols("is_self_excluded")).filter(P.changed_or_first("is_self_excluded"))
    return rows.select("seq", *P.KEY, P.to_bool(F.col("is_self_excluded")).cast("string").alias("blocked"))


@query(
    "block_toggle_present",
    f"""{EV}, s AS (SELECT seq, brand_id, player_id, lower({_after("is_verified")}) AS x, lower({_before("is_verified")}) AS px FROM ev WHERE topic = 'players')
    SELECT seq, brand_id, player_id, x AS locked FROM s WHERE x IS NOT NULL AND x IS DISTINCT FROM px""",
)
def block_toggle_present(spark, sf):
    rows = P.toggled_when_present(T.events(spark, sf, "players"), "is_verified")
    return rows.select("seq", *P.KEY, F.lower("is_verified").alias("locked"))


CW = "(PARTITION BY brand_id, player_id, upper(channel) ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


@query(
    "consent_changes",
    f"""{EV}, s AS (SELECT seq, brand_id, player_id, upper(channel) AS channel, consented, last_value({{'v': consented}}) OVER {CW} AS stored
      FROM ev WHERE upper(channel) IN ('EMAIL', 'SMS'))
    SELECT seq, brand_id, player_id, channel, coalesce(consented, '') AS consented FROM s WHERE stored.v IS NULL OR stored.v IS DISTINCT FROM consented""",
)
def consent_changes(spark, sf):
    rows = C.consent_changes(T.events(spark, sf, "players"), overwrite_null=True)
    return rows.select("seq", "brand_id", "player_id", "channel", F.coalesce("consented", F.lit("")).alias("consented"))


@query(
    "consent_changes_fan_out",
    f"""{EV}, s AS (SELECT seq, brand_id, player_id, upper(channel) AS channel, consented, lag(consented) OVER (PARTITION BY brand_id, player_id, upper(channel) ORDER BY ts, seq) AS stored
      FROM ev WHERE channel IS NOT NULL AND consented IS NOT NULL),
    c AS (SELECT * FROM s WHERE stored IS DISTINCT FROM consented)
    SELECT seq, brand_id, player_id, channel, CASE consented WHEN '0' THEN 'false' ELSE 'true' END AS consented FROM c WHERE brand_id <> 1
    UNION ALL SELECT seq, brand_id, player_id, t.channel, CASE consented WHEN '0' THEN 'false' ELSE 'true' END FROM c, (VALUES ('EMAIL'), ('SMS')) t(channel)
    WHERE brand_id = 1 AND c.channel = 'EMAIL'""",
)
def consent_changes_fan_out(spark, sf):
    changes = C.consent_changes(T.events(spark, sf, "players"), channels=None)
    return C.fan_out(changes, [1]).select(
        "seq", "brand_id", "player_id", "channel", C.channel_consent(F.col("consented")).alias("consented")
    )


@query(
    "consent_changes_history",
    f"""{EV}, s AS (SELECT seq, brand_id, player_id, upper(channel) AS channel, coalesce(consented, 'true') AS consented,
      lag(coalesce(consented, 'true')) OVER (PARTITION BY brand_id, player_id, upper(channel) ORDER BY ts, seq) AS stored FROM ev WHERE upper(channel) IN ('EMAIL', 'SMS'))
    SELECT seq, brand_id, player_id, channel, consented FROM s WHERE stored IS DISTINCT FROM consented""",
)
def consent_changes_history(spark, sf):
    return C.consent_changes(T.events(spark, sf, "players"), null_as="true").select(
        "seq", "brand_id", "player_id", "channel", "consented"
    )


AREAS = {
    "sms_casino": "CASE k % 4 WHEN 0 THEN 'true' WHEN 1 THEN 'false' END",
    "sms_betting": "CASE k % 5 WHEN 0 THEN 'true' WHEN 1 THEN NULL ELSE 'false' END",
    "sms_bingo": "CASE WHEN k % 11 = 0 THEN 'true' END",
    "email_casino": "CASE k % 3 WHEN 0 THEN 'true' END",
    "email_betting": "CASE k % 7 WHEN 0 THEN 'true' WHEN 1 THEN 'false' END",
    "email_bingo": "CASE WHEN k % 13 = 0 THEN 'true' END",
}


def _any_true(channel):
    return " OR ".join(f"coalesce({channel}_{a} = 'true', false)" for a in ("casino", "betting", "bingo"))


@query(
    "consent_rollup",
    f"""{EV}, c AS (SELECT seq, player_id, {", ".join(f"{e} AS {n}" for n, e in AREAS.items())} FROM ev WHERE topic = 'players')
    SELECT seq, player_id, 'SMS' AS channel, CASE WHEN {_any_true('sms')} THEN 1 ELSE 0 END AS consented FROM c WHERE sms_betting IS NOT NULL
    UNION ALL SELECT seq, player_id, 'EMAIL', CASE WHEN {_any_true('email')} THEN 1 ELSE 0 END FROM c WHERE email_betting IS NOT NULL""",
)
def consent_rollup(spark, sf):
    rows = T.events(spark, sf, "players").selectExpr("seq", "player_id", *[f"{e} AS {n}" for n, e in AREAS.items()])
    return C.rollup(rows).select("seq", "player_id", "channel", F.col("consented").cast("int").alias("consented"))


@query(
    "vip_level_changes",
    f"""{EV}, s AS (SELECT seq, brand_id, player_id, vip_level, lag(vip_level) OVER {WO} AS prior FROM ev WHERE topic = 'players')
    SELECT seq, brand_id, player_id, vip_level, 'vip_update' AS selector FROM s
    UNION ALL SELECT seq, brand_id, player_id, vip_level, 'viplevel25_changed' FROM s WHERE vip_level IS NOT NULL AND vip_level IS DISTINCT FROM prior""",
)
def vip_level_changes(spark, sf):
    return P.vip_level_changes(T.events(spark, sf, "players"), "vip_level")


@query(
    "hold_until_profile",
    f"""{EV}, f AS (SELECT brand_id, player_id, min({{'ts': ts, 'seq': seq}}) AS p FROM ev WHERE topic = 'players' GROUP BY 1, 2)
    SELECT seq, brand_id, player_id, CASE WHEN {{'ts': ts, 'seq': seq}} < p THEN 1 ELSE 0 END AS held,
      CASE WHEN {{'ts': ts, 'seq': seq}} < p THEN p.seq ELSE seq END AS released_by
    FROM ev JOIN f USING (brand_id, player_id) WHERE topic = 'wallet'""",
)
def hold_until_profile(spark, sf):
    rows = P.hold_until_profile(
        T.events(spark, sf, "players", "wallet"), F.col("topic") == "players", F.col("topic") == "wallet"
    )
    return rows.select("seq", *P.KEY, F.col("held").cast("int").alias("held"), "released_by")


SEGMENTS = {f"segment_{i:02d}": f"CASE WHEN (k + {i}) % 4 <> 0 THEN (k * {i + 1}) % 50 END" for i in range(50)}


@query(
    "segmentation_merge",
    f"""{EV}, s AS (SELECT seq, ts, brand_id, player_id, {", ".join(f"{e} AS {n}" for n, e in SEGMENTS.items())} FROM ev WHERE topic = 'players')
    SELECT brand_id, player_id, {", ".join(f"arg_max({n}, seq) FILTER (WHERE {n} IS NOT NULL) AS {n}" for n in SEGMENTS)}
    FROM s GROUP BY 1, 2 HAVING max(ts) > TIMESTAMP '2024-01-20'""",
)
def segmentation_merge(spark, sf):
    fields = {n: F.expr(e) for n, e in SEGMENTS.items()}
    return P.delta_snapshot(T.events(spark, sf, "players"), fields, "2024-01-20").select(*P.KEY, *SEGMENTS)


KPIS = {f"kpi_{i}": f"CASE WHEN k % {i + 2} = 0 THEN value * {i + 1} END" for i in range(7)}


@query(
    "kpi_merge",
    f"""{EV}, s AS (SELECT seq, brand_id, player_id, {", ".join(f"{e} AS {n}" for n, e in KPIS.items())} FROM ev WHERE topic = 'wagering'),
    m AS (SELECT brand_id, player_id, {", ".join(f"arg_max({n}, seq) FILTER (WHERE {n} IS NOT NULL) AS {n}" for n in KPIS)} FROM s GROUP BY 1, 2)
    SELECT * FROM m WHERE coalesce({", ".join(KPIS)}) IS NOT NULL""",
)
def kpi_merge(spark, sf):
    fields = {n: F.expr(e) for n, e in KPIS.items()}
    return P.drop_all_null(latest_values(T.events(spark, sf, "wagering"), P.KEY, P.ORDER, fields), list(KPIS))


@query(
    "drop_all_null",
    f"{EV} SELECT seq, email, language FROM ev WHERE topic = 'players' AND coalesce(email, language) IS NOT NULL",
)
def drop_all_null(spark, sf):
    return P.drop_all_null(T.events(spark, sf, "players").select("seq", "email", "language"), ["email", "language"])


@query(
    "wallet_lifetime_snapshot",
    f"""{EV}, m AS (SELECT brand_id, player_id, arg_max(total_deposit_eur, seq) AS total, arg_max(lifetime_count, seq) AS cnt, arg_max(dt, seq) AS dt
      FROM ev WHERE topic = 'wallet' GROUP BY 1, 2)
    SELECT brand_id, player_id, total AS total_deposit_eur, CAST(cnt AS BIGINT) AS lifetime_count, substring(dt, 1, 10) AS last_transaction_date,
      CASE WHEN cnt > 0 THEN total / cnt END AS average_deposit FROM m""",
)
def wallet_lifetime_snapshot(spark, sf):
    state = latest_values(T.events(spark, sf, "wallet"), P.KEY, P.ORDER, _cols("total_deposit_eur", "lifetime_count", "dt"))
    return state.select(
        *P.KEY, "total_deposit_eur", F.col("lifetime_count").cast("bigint").alias("lifetime_count"),
        date10(F.col("dt")).alias("last_transaction_date"),
        average_deposit(F.col("total_deposit_eur"), F.col("lifetime_count")).alias("average_deposit"),
    )


# What a wallet message holds of a player's lifetime; absent where the message does not tell it.
LIFETIME = {
    "LifetimeDepositCount": "CASE WHEN k % 7 <> 0 THEN CAST(k % 4 AS STRING) END", "TotalDepositEUR": "CASE WHEN k % 5 <> 0 THEN CAST(k * 2 AS STRING) END",
    "TotalDeposit": "CASE WHEN k % 5 <> 0 THEN CAST(k * 3 AS STRING) END", "LifetimeWithdrawalCount": "CASE WHEN k % 3 = 0 THEN CAST(k % 6 AS STRING) END",
    "LifetimeWithdrawalCountEUR": "CASE WHEN k % 3 = 1 THEN CAST(k % 6 AS STRING) END", "TotalWithdrawalLifetime": "CASE WHEN k % 11 = 0 THEN CAST(k AS STRING) END",
    "TotalWithdrawalLifetimeEUR": "CASE WHEN k % 11 = 1 THEN CAST(k AS STRING) END", "last_deposit_datetime": "CASE WHEN k % 2 = 0 THEN dt END",
}


@query(
    "wallet_lifetime_export",
    f"""{EV}, w AS (SELECT seq, brand_id, player_id, {", ".join(f"{e} AS {n}" for n, e in LIFETIME.items())} FROM ev WHERE topic = 'wallet'),
    m AS (SELECT brand_id, player_id, {", ".join(f"arg_max({n}, seq) FILTER (WHERE {n} IS NOT NULL) AS {n}" for n in LIFETIME)} FROM w GROUP BY 1, 2)
    SELECT brand_id, CAST(player_id AS STRING) AS id, TRY_CAST(LifetimeDepositCount AS INTEGER) AS lifetimeDepositCount,
      CASE WHEN TRY_CAST(LifetimeDepositCount AS INTEGER) > 0 THEN CAST(TotalDepositEUR AS DOUBLE) / TRY_CAST(LifetimeDepositCount AS INTEGER) END AS averageDeposit,
      substring(last_deposit_datetime, 1, 10) AS last_deposit_date, LifetimeWithdrawalCount, LifetimeWithdrawalCountEUR, TotalWithdrawalLifetime, TotalWithdrawalLifetimeEUR, TotalDeposit, TotalDepositEUR FROM m""",
)
def wallet_lifetime_export(spark, sf):
    """Deposit and withdrawal totals of each player, written as JSON lines of an id and its properties, and read back."""
    path = run_dir(spark, "lifetime")
    rows = T.events(spark, sf, "wallet").select(*P.KEY, *P.ORDER, *[F.expr(e).alias(n) for n, e in LIFETIME.items()])
    O.export_json(P.lifetime_properties(latest_values(rows, P.KEY, P.ORDER, _cols(*LIFETIME))), path)
    texts = ("LifetimeWithdrawalCount", "LifetimeWithdrawalCountEUR", "TotalWithdrawalLifetime", "TotalWithdrawalLifetimeEUR", "TotalDeposit", "TotalDepositEUR")
    properties = "lifetimeDepositCount:int, averageDeposit:double, last_deposit_date:string, " + ", ".join(f"{t}:string" for t in texts)
    return O.read_export(spark, path, f"id string, properties struct<{properties}>, brand_id bigint").select("brand_id", "id", "properties.*")


@query(
    "delta_snapshot",
    f"""{EV} SELECT brand_id, player_id, arg_max(email, seq) FILTER (WHERE email IS NOT NULL) AS email, arg_max(balance, seq) FILTER (WHERE balance IS NOT NULL) AS balance
    FROM ev GROUP BY 1, 2 HAVING max(ts) > TIMESTAMP '2024-01-30'""",
)
def delta_snapshot(spark, sf):
    return P.delta_snapshot(T.events(spark, sf), _cols("email", "balance"), "2024-01-30").drop("updated_ts")


@query(
    "email_change_request",
    f"""{EV}, s AS (SELECT seq, brand_id, player_id, email, {_before("email")} AS stored FROM ev WHERE topic = 'players')
    SELECT seq, brand_id, player_id, email FROM s WHERE email IS NOT NULL AND stored IS NOT NULL AND email <> stored""",
)
def email_change_request(spark, sf):
    return P.email_change_request(T.events(spark, sf, "players")).select("seq", *P.KEY, "email")


@query(
    "block_expiry",
    f"""{EV}, s AS (SELECT seq, brand_id, player_id, player_status, {_before("CASE WHEN player_status IN ('1','2','3') AND blocked_start IS NOT NULL THEN player_status WHEN player_status IS NULL THEN 'x' END")} AS stored
      FROM ev WHERE topic = 'players')
    SELECT seq, brand_id, player_id, CASE stored WHEN '3' THEN 'self_exclusion_expired' ELSE 'timeout_expired' END AS selector
    FROM s WHERE player_status IS NULL AND stored IN ('3', '1')""",
)
def block_expiry(spark, sf):
    return P.block_expiry(T.events(spark, sf, "players")).select("seq", *P.KEY, "selector")


COUNTERS = f"""s AS (SELECT seq, ts, brand_id, player_id,
      count(*) FILTER (WHERE player_status IN ('2','3') AND blocked_start IS NOT NULL) OVER {W} AS nb_self_exclusion,
      count(*) FILTER (WHERE player_status = '1' AND blocked_start IS NOT NULL) OVER {W} AS nb_timeout FROM ev WHERE topic = 'players')"""


@query("block_counters", f"{EV}, {COUNTERS} SELECT seq, brand_id, player_id, nb_self_exclusion, nb_timeout FROM s")
def block_counters(spark, sf):
    return P.block_counters(T.events(spark, sf, "players")).select("seq", *P.KEY, "nb_self_exclusion", "nb_timeout")


@query(
    "counter_diff",
    f"""{EV}, {COUNTERS}
    SELECT seq, brand_id, player_id, 'nb_self_exclusion' AS counter, nb_self_exclusion AS value FROM (SELECT *, lag(nb_self_exclusion) OVER {WO} AS p FROM s) WHERE nb_self_exclusion > coalesce(p, 0)
    UNION ALL SELECT seq, brand_id, player_id, 'nb_timeout', nb_timeout FROM (SELECT *, lag(nb_timeout) OVER {WO} AS p FROM s) WHERE nb_timeout > coalesce(p, 0)""",
)
def counter_diff(spark, sf):
    return P.counter_diff(T.events(spark, sf, "players"), P.notices())


@query(
    "achievement_latest",
    f"""{EV} SELECT brand_id, player_id, arg_max('level-' || CAST(k AS STRING), seq) AS achievement FROM ev WHERE topic = 'wagering' AND has_resulted = 'true' GROUP BY 1, 2""",
)
def achievement_latest(spark, sf):
    completed = T.events(spark, sf, "wagering").filter(F.col("has_resulted") == "true")
    return latest_values(completed, P.KEY, P.ORDER, {"achievement": F.concat(F.lit("level-"), F.col("k").cast("string"))})


@query(
    "deposit_state_flags",
    f"""{EV}, s AS (SELECT seq, brand_id, player_id, {_after("CASE WHEN transaction_status = 'decline' THEN dt END")} AS failed_deposit_date,
      {_before("CASE WHEN transaction_status = 'decline' THEN dt END")} AS prior,
      {_after("CASE WHEN k % 5 <> 0 AND (k % 3 = 0 OR k % 5 = k % 3) THEN 'true' END")} AS is_first_deposit FROM ev WHERE topic = 'wallet')
    SELECT seq, brand_id, player_id, failed_deposit_date, is_first_deposit,
      CASE WHEN failed_deposit_date IS NOT NULL AND failed_deposit_date IS DISTINCT FROM prior THEN 1 ELSE 0 END AS failed_changed FROM s""",
)
def deposit_state_flags(spark, sf):
    first, last = F.expr("CASE WHEN k % 5 <> 0 THEN k % 5 END"), F.expr("CASE WHEN k % 3 <> 0 THEN k % 3 END")
    rows = P.deposit_state(T.events(spark, sf, "wallet"), last, first)
    return rows.select(
        "seq", *P.KEY, "failed_deposit_date", "is_first_deposit", F.col("failed_changed").cast("int").alias("failed_changed")
    )


@query(
    "profile_registered_change",
    f"""{EV}, s AS (SELECT seq, brand_id, player_id, {_after("reg_datetime")} AS reg_datetime, {_before("reg_datetime")} AS prior, {_after("is_self_excluded")} AS x FROM ev WHERE topic = 'players')
    SELECT seq, brand_id, player_id, reg_datetime, 'player_registered' AS selector FROM s WHERE reg_datetime IS NOT NULL AND reg_datetime IS DISTINCT FROM prior
    UNION ALL SELECT seq, brand_id, player_id, reg_datetime, 'self_exclusion' FROM s WHERE x = 'true'""",
)
def profile_registered_change(spark, sf):
    return P.registered_change(T.events(spark, sf, "players"))


@query(
    "tombstones",
    f"""{EV}, r AS (SELECT *, row_number() OVER (PARTITION BY brand_id, player_id ORDER BY ts DESC, seq DESC) AS rn FROM ev WHERE topic = 'players')
    SELECT brand_id, player_id, seq, email FROM r WHERE rn = 1 AND k % 5 <> 0""",
)
def tombstones(spark, sf):
    return P.tombstones(T.events(spark, sf, "players"), F.col("k") % 5 == 0, ["email"]).select(*P.KEY, "seq", "email")
