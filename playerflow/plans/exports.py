"""Queries for projections, exports, webpush and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from playerflow.functions import flags, text, times
from playerflow.operators import consents as C
from playerflow.operators import lifetime as L
from playerflow.operators import lookups as K
from playerflow.operators import profiles as P
from playerflow.operators import webpush as W
from playerflow.operators.timeline import latest_values
from playerflow.plans import profile as PP
from playerflow.plans.registry import query
from playerflow.session import run_dir
from playerflow.sources import delivery as D
from playerflow.sources import outbox as O
from playerflow.sources import silver as V
from playerflow.sources import tables as T
from playerflow.sources import topics as J

EV = f"WITH {T.EVENTS_CTE}"
PL = f"WITH {T.PLAYERS_CTE}"
WP = f"WITH {T.WALLET_CTE}, {T.PLAYERS_CTE}, {T.SUBTYPES_CTE}"


def _deposit_totals(spark, sf):
    return L.lifetime_totals(L.by_type_and_status(T.wallet(spark, sf), T.subtypes(spark), 1, [2]))


@query(
    "property_map",
    f"""{WP}, d AS (SELECT player_wid, count(*) AS c, sum(CAST(amount AS DECIMAL(18,2))) AS a FROM wallet JOIN subtypes USING (subtype_id)
      WHERE type_id = 1 AND status_id = 2 GROUP BY 1)
    SELECT player_wid AS id, CAST(c AS STRING) AS lifetime_deposit_count, CAST(CAST(a AS DECIMAL(18,2)) AS STRING) AS lifetime_deposit_amount FROM d""",
)
def property_map(spark, sf):
    """Export rows ``(id, properties)``; the map is read back into columns for the check."""
    exported = O.property_rows(
        _deposit_totals(spark, sf), "player_wid",
        {"lifetime_deposit_count": F.col("lifetime_deposit_count"), "lifetime_deposit_amount": L.money(F.col("lifetime_deposit_amount"))},
    )
    return exported.select("id", *[F.col("properties")[n].alias(n) for n in ("lifetime_deposit_count", "lifetime_deposit_amount")])


@query(
    "history_export",
    f"""{PL} SELECT player_id AS id, '{{"brand_id":"' || CAST(brand_id AS STRING) || '","dob":"' || strftime(DATE '1970-01-01' + CAST(player_wid % 9000 AS INT), '%Y-%m-%d')
      || '","segment":"' || segment || '"}}' AS properties FROM players""",
)
def history_export(spark, sf):
    source = T.players(spark, sf).withColumn(
        "raw_dob", F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), (F.col("player_wid") % 9000).cast("int")), "dd/MM/yyyy")
    )
    return O.history_rows(
        source, "player_id",
        {"brand_id": F.col("brand_id").cast("string"), "dob": times.parse_day_first(F.col("raw_dob")), "segment": F.col("segment")},
    )


@query(
    "row_as_json",
    f"""{PL} SELECT CAST(brand_id AS STRING) || '-' || player_id AS key, '{{"player_id":"' || player_id || '","segment":"' || segment || '"}}' AS value FROM players""",
)
def row_as_json(spark, sf):
    return O.keyed_json(T.players(spark, sf), ("brand_id", "player_id"), ("player_id", "segment"))


@query(
    "publish_keyed_json",
    f"""{PL} SELECT CAST(brand_id AS STRING) || '-' || player_id AS key, '{{"player_wid":' || CAST(player_wid AS STRING) || '}}' AS value FROM players""",
)
def publish_keyed_json(spark, sf):
    """Publish to a sink that stands in for a topic, then read the rows back."""
    rows = O.keyed_json(T.players(spark, sf), ("brand_id", "player_id"), ("player_wid",))
    path = run_dir(spark, "topic")
    O.publish(rows, "parquet", path=path)
    return spark.read.schema("key string, value string").parquet(path)


@query("flags_to_int", f"{EV} SELECT seq, CASE WHEN is_self_excluded = 'true' THEN 1 ELSE 0 END AS self_excluded, CASE WHEN lower(is_verified) = 'true' THEN 1 ELSE 0 END AS verified FROM ev WHERE topic = 'players'")
def flags_to_int(spark, sf):
    flag = lambda c: F.when(F.lower(c) == "true", 1).otherwise(0)
    return T.events(spark, sf, "players").select(
        "seq", flag("is_self_excluded").alias("self_excluded"), flag("is_verified").alias("verified")
    )


@query("consent_history_export", f"{PL} SELECT player_id, lower(segment) AS consent FROM players")
def consent_history_export(spark, sf):
    return T.players(spark, sf).select("player_id", F.lower("segment").alias("consent"))


@query("login_history_export", f"{EV} SELECT seq, player_id, coalesce(substring(login_datetime, 1, 10), '') AS login_date, coalesce(login_success, '') AS login_success FROM ev WHERE topic IN ('logins', 'wagering')")
def login_history_export(spark, sf):
    blank = lambda c: F.coalesce(c, F.lit(""))
    return T.events(spark, sf, "logins", "wagering").select(
        "seq", "player_id", blank(text.date10(F.col("login_datetime"))).alias("login_date"), blank(F.col("login_success")).alias("login_success")
    )


@query(
    "first_deposit_date_export",
    f"{WP} SELECT player_wid, strftime(min(transaction_datetime), '%Y-%m-%d') AS first_deposit_date FROM wallet JOIN subtypes USING (subtype_id) WHERE type_id = 1 AND status_id = 2 GROUP BY 1",
)
def first_deposit_date_export(spark, sf):
    deposits = L.by_type_and_status(T.wallet(spark, sf), T.subtypes(spark), 1, [2])
    first = deposits.groupBy("player_wid").agg(F.min("transaction_datetime").alias("first"))
    return first.filter(F.col("first").isNotNull()).select("player_wid", L.day(F.col("first")).alias("first_deposit_date"))


@query("balance_export", f"{PL} SELECT player_id AS id, balance FROM players")
def balance_export(spark, sf):
    return T.players(spark, sf).select(F.col("player_id").alias("id"), "balance")


@query(
    "recommendation_export",
    f"""{PL}, r AS (SELECT player_id, {", ".join(f"CASE WHEN player_wid % {i + 2} <> 0 THEN 'game_' || CAST((player_wid * {i}) % 97 AS STRING) END AS game_{i}" for i in range(1, 6))} FROM players)
    SELECT player_id AS id, '{{' || concat_ws(',', {", ".join(f"""'"game_{i}":"' || game_{i} || '"'""" for i in range(1, 6))}) || '}}' AS properties FROM r""",
)
def recommendation_export(spark, sf):
    games = {
        f"game_{i}": F.expr(f"CASE WHEN player_wid % {i + 2} <> 0 THEN 'game_' || CAST((player_wid * {i}) % 97 AS STRING) END") for i in range(1, 6)
    }
    return O.history_rows(T.players(spark, sf), "player_id", games)


OUTWARD = ("originalId", "brand_id", "reg_datetime", "emailaddress", "language", "country", "is_deposited_restricted")


@query(
    "public_projection",
    f"""{EV}, s AS (SELECT player_id, brand_id, {", ".join(f"arg_max({c}, seq) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in ("reg_datetime", "email", "language", "country_id", "is_self_excluded"))} FROM ev GROUP BY 1, 2)
    SELECT player_id AS "originalId", s.brand_id, substring(reg_datetime, 1, 10) AS reg_datetime, email AS emailaddress, language,
      CASE WHEN country_id IS NOT NULL THEN coalesce(n_name, '') END AS country, CASE WHEN s.brand_id IN (1, 4) THEN is_self_excluded END AS is_deposited_restricted
    FROM s LEFT JOIN nation ON n_regionkey = s.brand_id AND n_nationkey = country_id""",
)
def public_projection(spark, sf):
    fields = ("reg_datetime", "email", "language", "country_id", "is_self_excluded")
    state = latest_values(T.events(spark, sf), P.KEY, P.ORDER, {c: F.col(c) for c in fields})
    dim = T.read_table(spark, sf, "nation").selectExpr("CAST(n_regionkey AS BIGINT) AS brand_id", "n_nationkey AS id", "n_name AS text")
    return P.outward(K.referential(state, dim, "country_id", "country"), restricted_brands=(1, 4))


@query("full_snapshot", f"""{EV}, s AS (SELECT brand_id, player_id, {", ".join(f"arg_max({c}, seq) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in ("email", "language", "is_self_excluded", "balance"))} FROM ev GROUP BY 1, 2)
    SELECT brand_id, player_id, email, language, balance, CASE WHEN is_self_excluded IN ('true', '1') THEN 'true' ELSE 'false' END AS blocked FROM s""")
def full_snapshot(spark, sf):
    """Whole profile store with the blocked flag of every player."""
    state = P.snapshot(T.events(spark, sf), {c: F.col(c) for c in ("email", "language", "is_self_excluded", "balance")})
    return state.select(
        *P.KEY, "email", "language", "balance", flags.to_bool(F.col("is_self_excluded")).cast("string").alias("blocked")
    )


@query("full_snapshot_gender", f"""{EV}, s AS (SELECT brand_id, player_id, arg_max(player_status, seq) FILTER (WHERE player_status IS NOT NULL) AS g FROM ev GROUP BY 1, 2)
    SELECT brand_id, player_id, CASE g WHEN '0' THEN 'Male' ELSE 'Female' END AS gender_description FROM s WHERE g IN ('0', '1')""")
def full_snapshot_gender(spark, sf):
    """Text derived from a code; players with another code are not exported."""
    state = P.snapshot(T.events(spark, sf), {"gender_id": F.col("player_status")})
    return P.gender_export(state).select(*P.KEY, "gender_description")


@query("full_snapshot_blocked", f"""{EV}, s AS (SELECT brand_id, player_id, arg_max(is_self_excluded, seq) FILTER (WHERE is_self_excluded IS NOT NULL) AS x FROM ev GROUP BY 1, 2)
    SELECT brand_id, player_id FROM s WHERE x = 'true'""")
def full_snapshot_blocked(spark, sf):
    state = P.snapshot(T.events(spark, sf), {"is_self_excluded": F.col("is_self_excluded")})
    return state.filter(flags.to_bool(F.col("is_self_excluded"))).select(*P.KEY)


@query("constant_cross_join", f"{PL} SELECT player_id, 'true' AS blocked FROM players")
def constant_cross_join(spark, sf):
    return T.players(spark, sf).select("player_id", F.lit("true").alias("blocked"))


@query("adhoc_backfill", f"{PL} SELECT player_id, 'vip' AS segment_label FROM players WHERE player_id LIKE 'Customer#0000000%' AND player_wid IN (3, 5, 8, 13, 21, 1200)")
def adhoc_backfill(spark, sf):
    listed = spark.sql("SELECT * FROM VALUES (3L), (5L), (8L), (13L), (21L), (1200L) AS t(player_wid)")
    people = T.players(spark, sf).filter(F.col("player_id").like("Customer#0000000%"))
    return people.join(listed, "player_wid", "left_semi").select("player_id", F.lit("vip").alias("segment_label"))


@query(
    "export_jsonl",
    f"""{WP}, d AS (SELECT player_wid, brand_id, count(*) AS c FROM wallet JOIN subtypes USING (subtype_id) WHERE type_id = 1 AND status_id = 2 GROUP BY 1, 2)
    SELECT brand_id, player_wid AS id, CAST(c AS STRING) AS lifetime_deposit_count FROM d""",
)
def export_jsonl(spark, sf):
    rows = O.property_rows(
        _deposit_totals(spark, sf), "player_wid", {"lifetime_deposit_count": F.col("lifetime_deposit_count")}, "brand_id"
    )
    path = run_dir(spark, "lifetime_deposit")
    O.export_json(rows, path)
    back = O.read_export(spark, path, "id bigint, properties map<string,string>, brand_id bigint")
    return back.select("brand_id", "id", F.col("properties")["lifetime_deposit_count"].alias("lifetime_deposit_count"))


@query("export_text", f"""{PL} SELECT '{{"id":"' || player_id || '"}}' AS line FROM players""")
def export_text(spark, sf):
    path = run_dir(spark, "lines")
    O.export_text(T.players(spark, sf).select(F.to_json(F.struct(F.col("player_id").alias("id"))).alias("line")), "line", path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query(
    "export_manifest",
    f"""{WP}, d AS (SELECT DISTINCT player_wid, brand_id FROM wallet JOIN subtypes USING (subtype_id) WHERE type_id = 1 AND status_id = 2)
    SELECT brand_id, 'lifetime_deposit' AS dataset, 'BATCH_NOTIFICATION' AS msg_type, count(*) AS row_count FROM d GROUP BY 1""",
)
def export_manifest(spark, sf):
    """Written once for all brands; the manifest counts what the files hold."""
    rows = O.property_rows(
        _deposit_totals(spark, sf), "player_wid", {"lifetime_deposit_count": F.col("lifetime_deposit_count")}, "brand_id"
    )
    path = run_dir(spark, "lifetime_deposit")
    O.export_json(rows, path)
    written = O.read_export(spark, path, "id bigint, brand_id bigint")
    return O.manifest(written, "lifetime_deposit", path).select("brand_id", "dataset", "msg_type", "row_count")


@query("append_table", f"WITH {T.WALLET_CTE} SELECT status_id, count(*) AS n FROM wallet GROUP BY 1")
def append_table(spark, sf):
    """Completed and other transactions arrive one after the other in the same table."""
    path = run_dir(spark, "appended")
    complete = F.col("status_id") == 2
    for condition in (complete, ~complete):
        O.append_rows(T.wallet(spark, sf).filter(condition), path)
    schema = "transaction_id bigint, status_id int"
    return spark.read.schema(schema).parquet(path).groupBy("status_id").agg(F.count(F.lit(1)).alias("n"))


@query("read_json_typed", f"{EV} SELECT CAST(seq AS STRING) AS seq, CAST(player_id AS STRING) AS player_id, email FROM ev WHERE topic = 'players'")
def read_json_typed(spark, sf):
    """Written as JSON lines with native types, read back with an all-text schema."""
    path = run_dir(spark, "json")
    T.events(spark, sf, "players").select("seq", "player_id", "email", "phone").write.json(path)
    return J.read_json(spark, path, J.text_schema("seq", "player_id", "email"))


@query("quarantine", f"{EV} SELECT seq FROM ev WHERE k % 10 = 0")
def quarantine(spark, sf):
    return _parsed(spark, sf)[1].select("seq")


@query("quarantine_clean", f"{EV} SELECT seq, CAST(k AS STRING) AS code FROM ev WHERE k % 10 <> 0")
def quarantine_clean(spark, sf):
    return _parsed(spark, sf)[0].select("seq", "code")


def _parsed(spark, sf):
    good = F.to_json(F.struct(F.col("k").alias("code")))
    raw = F.when(F.col("k") % 10 == 0, F.substring(good, 1, 4)).otherwise(good)
    return J.split_malformed(T.events(spark, sf).select("seq", raw.alias("raw")), "raw", J.text_schema("code"))


@query("require_keys", f"{EV} SELECT seq, CASE WHEN k % 7 <> 0 THEN player_id END AS player_id FROM ev WHERE k % 7 <> 0 AND email IS NOT NULL")
def require_keys(spark, sf):
    rows = T.events(spark, sf).withColumn("player_id", F.expr("CASE WHEN k % 7 <> 0 THEN player_id END"))
    return J.require(rows, "player_id", "brand_id", "email").select("seq", "player_id")


@query(
    "control_as_of_join",
    f"""{EV}, c AS (SELECT seq, ts, brand_id, topic, CASE WHEN topic = 'logins' AND k % 20 = 0 THEN 'stop' WHEN topic = 'logins' AND k % 20 = 1 THEN 'start' END AS action FROM ev),
    s AS (SELECT *, last_value(action IGNORE NULLS) OVER (PARTITION BY brand_id ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS switch FROM c)
    SELECT seq, brand_id FROM s WHERE action IS NULL AND coalesce(switch, 'start') <> 'stop'""",
)
def control_as_of_join(spark, sf):
    action = F.expr("CASE WHEN topic = 'logins' AND k % 20 = 0 THEN 'stop' WHEN topic = 'logins' AND k % 20 = 1 THEN 'start' END")
    return P.between_start_and_stop(T.events(spark, sf).withColumn("action", action), ("brand_id",)).select("seq", "brand_id")


def _consent_sql(channel, flag):
    head = f"""'{{"type":"USER_CONSENT_EVENT","brand_id":"' || CAST(brand_id AS STRING) || '","player_id":"' || player_id || '","channel":"{channel}","consented":'"""
    return f"""SELECT player_id, {head} || '"' || CAST({flag} AS STRING) || '"}}' AS value FROM c WHERE {flag} IS NOT NULL
    UNION ALL SELECT player_id, {head} || 'null}}' AS value FROM c WHERE {flag} IS NULL"""


RECEIVE = "CASE WHEN player_wid % 3 <> 0 THEN player_wid % 2 END AS receive_sms, CASE WHEN player_wid % 5 <> 0 THEN player_wid % 2 END AS receive_email"


@query(
    "union_all",
    f"{PL}, c AS (SELECT *, {RECEIVE} FROM players) " + _consent_sql("sms", "receive_sms") + " UNION ALL " + _consent_sql("email", "receive_email"),
)
def union_all(spark, sf):
    """One event per player and channel in a single pass; an absent flag stays an explicit null."""
    rows = T.players(spark, sf).selectExpr("player_id", "brand_id", *RECEIVE.split(", "))
    return C.history_events(rows, {"sms": "receive_sms", "email": "receive_email"})


@query("string_functions", f"""{EV} SELECT seq, substring(dt, 1, 10) AS day, lower(email) AS low, CASE WHEN trim(phone) <> '' THEN phone END AS phone, starts_with(coalesce(email, ''), 'p1')::INT AS p1,
      split_part(email, '@', 1) AS local_part, concat_ws('|', email, language) AS joined FROM ev WHERE topic = 'players'""")
def string_functions(spark, sf):
    return T.events(spark, sf, "players").select(
        "seq", text.date10(F.col("dt")).alias("day"), F.lower("email").alias("low"), text.blank_to_null(F.col("phone")).alias("phone"),
        text.starts_with_ci(F.col("email"), "P1").cast("int").alias("p1"), F.split_part("email", F.lit("@"), F.lit(1)).alias("local_part"),
        text.pipe_join(F.array("email", "language")).alias("joined"),
    )


@query("boolean_parse", f"""{EV} SELECT seq, CASE WHEN has_resulted IN ('true', '1') THEN 1 ELSE 0 END AS resulted, CASE WHEN has_resulted IN ('true', '1') THEN '1' ELSE '0' END AS flag,
      CASE WHEN email_confirmed IS NULL OR trim(email_confirmed) = '' THEN email_confirmed WHEN lower(email_confirmed) = 'true' THEN '1' ELSE '0' END AS digit FROM ev WHERE topic IN ('wagering', 'players')""")
def boolean_parse(spark, sf):
    value = flags.to_bool(F.col("has_resulted"))
    return T.events(spark, sf, "wagering", "players").select(
        "seq", value.cast("int").alias("resulted"), flags.to_flag(value).alias("flag"),
        flags.true_to_digit(F.col("email_confirmed")).alias("digit"),
    )


@query("datetime_parse", f"""{EV}, s AS (SELECT seq, k, ts FROM ev)
    SELECT seq, strftime(CASE k % 4 WHEN 0 THEN date_trunc('millisecond', ts) WHEN 1 THEN date_trunc('second', ts) + INTERVAL 500 MILLISECOND WHEN 2 THEN date_trunc('day', ts) ELSE date_trunc('millisecond', ts) END, '%Y-%m-%d %H:%M:%S.%g') AS parsed FROM s""")
def datetime_parse(spark, sf):
    at = F.col("ts")
    raw = (
        F.when(F.col("k") % 4 == 0, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSS"))
        .when(F.col("k") % 4 == 1, F.concat(F.date_format(at, "yyyy-MM-dd HH:mm:ss"), F.lit(".5")))
        .when(F.col("k") % 4 == 2, F.date_format(at, "yyyy-MM-dd"))
        .otherwise(F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSS"))
    )
    return T.events(spark, sf).select("seq", F.date_format(times.parse_by_length(raw), "yyyy-MM-dd HH:mm:ss.SSS").alias("parsed"))


@query("date_math", f"""{EV} SELECT seq, strftime(ts - INTERVAL 30 DAY, '%Y-%m-%d') AS month_ago, datediff('day', ts, DATE '2024-02-01') AS days, CAST(floor((epoch(TIMESTAMP '2024-02-01') - epoch(ts)) / 3600) AS BIGINT) AS hours,
      strftime(CASE k % 3 WHEN 0 THEN ts + k * INTERVAL 1 HOUR WHEN 1 THEN ts + INTERVAL 1 MONTH * (k % 5) ELSE ts + k * INTERVAL 7 DAY END, '%Y-%m-%d') AS expiry FROM ev""")
def date_math(spark, sf):
    at = F.col("ts").cast("timestamp")
    target = F.lit("2024-02-01").cast("timestamp")
    amount = F.when(F.col("k") % 3 == 1, F.col("k") % 5).otherwise(F.col("k"))
    unit = F.when(F.col("k") % 3 == 0, "hours").when(F.col("k") % 3 == 1, "MONTH").otherwise("Week")
    return T.events(spark, sf).select(
        "seq", F.date_format(at - F.expr("INTERVAL 30 DAY"), "yyyy-MM-dd").alias("month_ago"),
        F.datediff(target, at).cast("bigint").alias("days"), times.whole_hours(at, target).alias("hours"),
        F.date_format(times.add_ttl(at, amount, unit), "yyyy-MM-dd").alias("expiry"),
    )


@query("math_functions", f"WITH {T.WALLET_CTE} SELECT transaction_id, round(amount, 1) AS rounded, CASE WHEN status_id > 1 THEN amount / (status_id - 1) END AS share, TRY_CAST('x' || CAST(status_id AS STRING) AS INT) AS bad FROM wallet")
def math_functions(spark, sf):
    return T.wallet(spark, sf).select(
        "transaction_id", F.round("amount", 1).alias("rounded"),
        L.average_deposit(F.col("amount"), F.col("status_id") - 1).alias("share"),
        F.concat(F.lit("x"), F.col("status_id").cast("string")).try_cast("int").alias("bad"),
    )


@query("json_functions", f"""{EV} SELECT seq, '{{"a":' || CAST(k AS STRING) || ',"b":{{"t":"' || topic || '"}},"c":[1,' || CAST(k AS STRING) || ']}}' AS doc, topic AS back FROM ev""")
def json_functions(spark, sf):
    doc = F.to_json(F.struct(F.col("k").alias("a"), F.struct(F.col("topic").alias("t")).alias("b"), F.array_append(F.array(F.lit(1)), F.col("k")).alias("c")))
    back = F.from_json(doc, "a int, b struct<t:string>, c array<int>")["b"]["t"]
    return T.events(spark, sf).select("seq", doc.alias("doc"), back.alias("back"))


@query("limit", "SELECT count(*) AS n FROM (SELECT * FROM customer LIMIT 1)")
def limit(spark, sf):
    """One-row preview before a publish."""
    return T.players(spark, sf).limit(1).agg(F.count(F.lit(1)).alias("n"))


COUNTRY = "CASE country_id % 4 WHEN 0 THEN 'JPN' WHEN 1 THEN 'GHA' WHEN 2 THEN 'FR' WHEN 3 THEN 'XX' END"
WAGER_BALANCE = "CASE WHEN topic = 'wagering' THEN balance END"
EVENT_TIME = "CASE topic WHEN 'logins' THEN login_datetime WHEN 'wagering' THEN bet_datetime END"

STATE_ROWS = (
    f"SELECT brand_id, player_id, seq, ts, CAST({EVENT_TIME} AS TIMESTAMP) AS t, last_value({WAGER_BALANCE} IGNORE NULLS) OVER {PP.W} AS balance, "
    f"last_value({COUNTRY} IGNORE NULLS) OVER {PP.W} AS code FROM ev"
)


def web_push_sql(rows):
    """Slot decisions over ``rows`` by recursion along each player's events."""
    return f"""WITH RECURSIVE {T.EVENTS_CTE}, z(code, zone) AS (VALUES ('JPN', 'Asia/Tokyo'), ('GHA', 'Africa/Accra'), ('FR', 'Europe/Paris')),
  e AS ({rows}),
  c AS (SELECT brand_id, player_id, seq, t, hour(t AT TIME ZONE 'UTC' AT TIME ZONE zone) AS h
    FROM e JOIN z USING (code) WHERE balance < 5 AND t > ts - INTERVAL 30 MINUTE),
  o AS (SELECT *, row_number() OVER (PARTITION BY brand_id, player_id ORDER BY t, seq) AS rn FROM c),
  w AS (
    SELECT brand_id, player_id, CAST(0 AS BIGINT) AS rn, CAST(NULL AS TIMESTAMP) AS t, CAST(NULL AS STRING) AS slot, CAST(NULL AS TIMESTAMP) AS owl, CAST(NULL AS TIMESTAMP) AS bird,
      CAST(NULL AS TIMESTAMP) AS happy, CAST(NULL AS TIMESTAMP) AS dailies FROM (SELECT DISTINCT brand_id, player_id FROM o)
    UNION ALL
    SELECT brand_id, player_id, rn, t, slot, CASE WHEN slot = 'WebPush_NightOwl' THEN t ELSE owl END, CASE WHEN slot = 'WebPush_EarlyBird' THEN t ELSE bird END,
      CASE WHEN slot = 'WebPush_HappyHour' THEN t ELSE happy END, CASE WHEN slot = 'WebPush_Dailies' THEN t ELSE dailies END
    FROM (SELECT o.brand_id, o.player_id, o.rn, o.t, w.owl, w.bird, w.happy, w.dailies, CASE
        WHEN (h >= 23 OR h < 4) AND (owl IS NULL OR date_sub('hour', owl, o.t) > 240) THEN 'WebPush_NightOwl'
        WHEN h >= 4 AND h < 9 AND (bird IS NULL OR date_sub('hour', bird, o.t) > 240) THEN 'WebPush_EarlyBird'
        WHEN h >= 16 AND h < 18 AND (happy IS NULL OR date_sub('hour', happy, o.t) > 24) THEN 'WebPush_HappyHour'
        WHEN (h >= 18 OR h < 16) AND (dailies IS NULL OR date_sub('hour', dailies, o.t) > 24) THEN 'WebPush_Dailies' END AS slot
      FROM w JOIN o ON o.brand_id = w.brand_id AND o.player_id = w.player_id AND o.rn = w.rn + 1))
  SELECT brand_id, player_id, strftime(t, '%Y-%m-%d %H:%M:%S') AS event_time, slot AS selector FROM w WHERE slot IS NOT NULL"""


@query("web_push_slot", web_push_sql(STATE_ROWS))
def web_push_slot(spark, sf):
    """Logins and wagers trigger; balance and country come from the profile at that moment."""
    state = P.merge(
        T.events(spark, sf, "players", "logins", "wagering").withColumn("event_time", F.expr(EVENT_TIME)),
        {"balance": F.expr(WAGER_BALANCE), "country": F.expr(COUNTRY)},
    )
    sent = W.web_push(state.filter(F.col("event_time").isNotNull()), K.country_zones(spark), event_time="event_time")
    return sent.select("brand_id", "player_id", F.date_format(F.timestamp_seconds("second"), "yyyy-MM-dd HH:mm:ss").alias("event_time"), "selector")


RAW = {
    "amount": "CASE WHEN k % 9 = 0 THEN 'n/a' ELSE CAST(amount AS STRING) END",
    "dt": "CASE WHEN k % 11 = 0 THEN 'soon' ELSE dt END",
    "settled": "CASE k % 4 WHEN 0 THEN 'TRUE' WHEN 1 THEN '1' WHEN 2 THEN 'false' END",
}
RAW_SQL = f"r AS (SELECT seq, CASE WHEN k % 17 = 0 THEN NULL ELSE player_id END AS player_id, {', '.join(f'{e} AS {n}' for n, e in RAW.items())} FROM ev WHERE topic = 'wallet')"
FAULT_SQL = "CASE WHEN player_id IS NULL THEN 'player_id' WHEN amount = 'n/a' THEN 'amount' WHEN dt = 'soon' THEN 'dt' END"


def _conformed(spark, sf):
    rows = T.events(spark, sf, "wallet").selectExpr("seq", "CASE WHEN k % 17 = 0 THEN NULL ELSE player_id END AS player_id", *[f"{e} AS {n}" for n, e in RAW.items()])
    return V.conform(rows, {"amount": "money", "dt": "time", "settled": "flag"}, ["player_id"])


@query(
    "silver_rows",
    f"""{EV}, {RAW_SQL} SELECT seq, player_id, CAST(CAST(amount AS DECIMAL(18,2)) AS DOUBLE) AS amount, dt AS at,
      CASE WHEN settled IS NOT NULL THEN CASE WHEN lower(settled) IN ('true', '1') THEN 'true' ELSE 'false' END END AS settled FROM r WHERE {FAULT_SQL} IS NULL""",
)
def silver_rows(spark, sf):
    """Text feed to money, time and flag columns."""
    good, _ = _conformed(spark, sf)
    return good.select(
        "seq", "player_id", F.col("amount").cast("double").alias("amount"), F.date_format("dt", "yyyy-MM-dd HH:mm:ss").alias("at"),
        F.col("settled").cast("string").alias("settled"),
    )


@query("silver_faults", f"{EV}, {RAW_SQL} SELECT seq, {FAULT_SQL} AS fault FROM r WHERE {FAULT_SQL} IS NOT NULL")
def silver_faults(spark, sf):
    return _conformed(spark, sf)[1].select("seq", "fault")


@query("silver_layout", f"{EV} SELECT brand_id, substring(dt, 1, 10) AS day, count(*) AS n, count(DISTINCT player_id) AS players FROM ev WHERE substring(dt, 1, 10) >= '2024-01-10' GROUP BY 1, 2")
def silver_layout(spark, sf):
    """Events written by brand and day, then read with pruning on the day."""
    rows = T.events(spark, sf).select("seq", "ts", "player_id", "brand_id", "topic", "value")
    path = run_dir(spark, "silver")
    V.write_events(rows, path)
    back = V.read_events(spark, path, "seq bigint, ts timestamp_ntz, player_id bigint, topic string, value double, brand_id bigint, day string", first_day="2024-01-10")
    return back.groupBy("brand_id", "day").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("player_id").alias("players"))


def _partner():
    """A sink that refuses the messages of every eleventh row."""

    async def send(message):
        if message["seq"] % 11 == 0:
            raise ConnectionError(message["dedup_id"])

    return send


def _login_messages(spark, sf):
    logins = T.events(spark, sf, "logins").withColumn("selector", F.lit("player_login"))
    return O.outbox(logins.drop("channel"), ("dt",))


LOGIN_IDS = f"WITH {T.EVENTS_CTE}, m AS (SELECT seq, sha256(CAST(brand_id AS STRING) || '|' || CAST(player_id AS STRING) || '|player_login|' || CAST(seq AS STRING)) AS dedup_id FROM ev WHERE topic = 'logins')"


@query("deliver_each", f"{LOGIN_IDS} SELECT dedup_id, seq % 11 <> 0 AS delivered FROM m")
def deliver_each(spark, sf):
    """What came of each message, a hundred in flight per task."""
    return D.deliver_each(_login_messages(spark, sf), _partner).select("dedup_id", "delivered")


@query("dead_letters", f"{LOGIN_IDS} SELECT seq, dedup_id, 3 AS attempts, 'ConnectionError' AS error FROM m WHERE seq % 11 = 0")
def dead_letters(spark, sf):
    messages = _login_messages(spark, sf)
    return D.dead_letters(messages, D.deliver_each(messages, _partner)).select("seq", "dedup_id", "attempts", "error")
