"""Streaming queries: each runs over all that is available and reads its output back."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as S

from playerflow.operators import lookups as K
from playerflow.operators import profiles as P
from playerflow.operators import webpush as W
from playerflow.plans import profile as PP
from playerflow.plans import rules as PR
from playerflow.operators.bets import bet_news
from playerflow.operators.timeline import latest_values
from playerflow.plans.bets import BS, CHAMPIONSHIPS, WATCHED, vertical_wagers
from playerflow.plans.exports import web_push_sql
from playerflow.plans.registry import ORACLES, query
from playerflow.session import run_dir
from playerflow.sources import outbox as O
from playerflow.sources import tables as T
from playerflow.sources import topics as J
from playerflow.streaming import jobs, ordered
from playerflow.streaming.sources import json_columns, stream_json_files, stream_table, union_watermarked
from playerflow.streaming.state import BatchOutput, BatchState

EV = f"WITH {T.EVENTS_CTE}"


PLAYER_COUNTRY = "CASE player_id % 4 WHEN 0 THEN 'JPN' WHEN 1 THEN 'GHA' WHEN 2 THEN 'FR' ELSE 'XX' END"


def event_stream(spark, sf, files_per_trigger=None):
    raw = stream_table(spark, sf, "events", files_per_trigger)
    with_k = raw.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return with_k.selectExpr(*[f"{e} AS {n}" for n, e in T.EVENT_COLUMNS.items()])


def stream_profile_changes(spark, sf, fields=PP.OUTWARD, files_per_trigger=None, delay="0 seconds"):
    """Merged profiles, which are the state of the job, and a message for each row that changed the outward record."""
    rows = event_stream(spark, sf, files_per_trigger).select(*P.KEY, *P.ORDER, *fields)
    out = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in fields)
    base = run_dir(spark, "profiles")
    told = in_order(spark, "profiles", rows, ordered.Changes(fields), out, fields, delay=delay, base=base)
    changed = told.filter(~F.col("late")).withColumn("ts", F.timestamp_micros("us").cast("timestamp_ntz"))
    messages = O.outbox(changed.withColumn("selector", F.lit("player_updated")), tuple(fields))
    return ordered.table_of(spark, f"{base}/checkpoint", ordered.key_types(rows, P.KEY), out), messages


@query(
    "stream_profile_changes",
    f"SELECT seq, brand_id, CAST(player_id AS STRING) AS contact_id, 'player_updated' AS selector FROM ({ORACLES['profile_changes']})",
)
def stream_profile_messages(spark, sf):
    return stream_profile_changes(spark, sf)[1].select("seq", "brand_id", "contact_id", "selector")


@query("stream_profile_state", f"""{EV} SELECT brand_id, player_id, {", ".join(f"arg_max({c}, seq) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in PP.OUTWARD)} FROM ev GROUP BY 1, 2""")
def stream_profile_state(spark, sf):
    return stream_profile_changes(spark, sf)[0]


#: No event is later; a row with this time closes a bounded run.
END_OF_TIME = "2999-12-31"


def closing_row(rows, keys=P.KEY):
    """One row of a key that nobody has, at the end of time."""
    types = {f.name: f.dataType for f in rows.schema.fields}
    return rows.sparkSession.range(1).select(
        *[F.lit(-1).cast(types[k]).alias(k) for k in (*keys, "seq")], F.lit(END_OF_TIME).cast(types["ts"]).alias("ts"))


def in_order(spark, name, rows, fold, out, columns, keys=P.KEY, delay="0 seconds", streams=None, base=None, reduced=None):
    """What the fold tells of a stream that is read to its end; ``streams`` makes it of rows and closing rows.

    ``reduced`` maps what each micro-batch tells to what is written of it.
    """
    jobs.stream_session(spark)
    base = base or run_dir(spark, name)
    output = BatchOutput(spark, f"{base}/rows")
    streams = streams or (lambda close: rows.unionByName(close, allowMissingColumns=True))
    build = lambda close: ordered.in_order(streams(close), keys, fold, out, columns, delay)
    step = (lambda batch, batch_id: output.write(reduced(batch), batch_id)) if reduced else output.write
    jobs.run_closed(build, closing_row(rows, keys), f"{base}/close", step, f"{base}/checkpoint")
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join(f"{k} {types[k]}" for k in keys) + f", us bigint, seq bigint, late boolean, {out}"
    return output.read(schema).drop("batch")


@query("keyed_process", ORACLES["profile_changes"])
def keyed_process(spark, sf, files_per_trigger=None, delay="0 seconds"):
    """The same changes as rows: a keyed process in event-time order, with the merged profile as state."""
    rows = event_stream(spark, sf, files_per_trigger).select(*P.KEY, *P.ORDER, *PP.OUTWARD)
    out = ", ".join(f"{c} string" for c in PP.OUTWARD)
    told = in_order(spark, "keyed", rows, ordered.Changes(PP.OUTWARD), out, PP.OUTWARD, delay=delay)
    return told.filter(~F.col("late")).select(*P.KEY, "seq", *PP.OUTWARD)


@query("stream_hold_until_profile", f"SELECT brand_id, player_id, seq, released_by FROM ({ORACLES['hold_until_profile']})")
def stream_hold_until_profile(spark, sf, files_per_trigger=None, delay="0 seconds"):
    """Waiting actions are state of their player and are deleted when the first profile row releases them."""
    events = event_stream(spark, sf, files_per_trigger).filter(F.col("topic").isin("players", "wallet"))
    rows = events.select(*P.KEY, *P.ORDER, (F.col("topic") == "players").alias("is_profile"))
    told = in_order(spark, "hold", rows, ordered.HoldUntilProfile(), "action bigint, released_by bigint", ["is_profile"], delay=delay)
    return told.filter(~F.col("late")).select(*P.KEY, F.col("action").alias("seq"), "released_by")


WAGER_ROWS = f"SELECT brand_id, player_id, seq, ts, CAST(bet_datetime AS TIMESTAMP) AS t, balance, {PLAYER_COUNTRY} AS code FROM ev WHERE topic = 'wagering'"


@query("stream_web_push", web_push_sql(WAGER_ROWS).replace("strftime(t, '%Y-%m-%d %H:%M:%S') AS event_time", "CAST(epoch(t) AS BIGINT) AS second"))
def stream_web_push(spark, sf, files_per_trigger=None):
    """Wagers with their own balance; the last time of each slot is the state."""
    base = run_dir(spark, "web-push")
    wagers = event_stream(spark, sf, files_per_trigger).filter(F.col("topic") == "wagering").withColumn("country", F.expr(PLAYER_COUNTRY))
    state = BatchState(spark, f"{base}/state", P.KEY, S.StructType.fromDDL(", ".join(f"{c} bigint" for c in (*P.KEY, *[f"last_{n}" for n in W.STATE]))))
    output = BatchOutput(spark, f"{base}/rows")
    jobs.finish(jobs.run(wagers, jobs.web_push(K.country_zones(spark), "bet_datetime", state, output), f"{base}/checkpoint"))
    columns = [*P.KEY, "second", "selector"]
    return output.read("brand_id bigint, player_id bigint, second bigint, selector string").select(*columns)


@query(
    "state_retention",
    f"""{EV}, c AS (SELECT brand_id, player_id, ts, seq, topic, bet_datetime, least(epoch_us(CAST(reg_datetime AS TIMESTAMP)), epoch_us(CAST(bet_datetime AS TIMESTAMP)),
        CASE WHEN has_resulted IN ('true', '1') THEN epoch_us(ts) END) AS own FROM ev),
    l AS (SELECT *, min(own) OVER (PARTITION BY brand_id, player_id ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM c)
    SELECT brand_id, player_id, CAST(count(*) FILTER (WHERE bet_datetime IS NOT NULL AND (before IS NULL OR epoch_us(ts) <= before + 2 * 86400000000)) AS BIGINT) AS kept
    FROM l GROUP BY 1, 2 HAVING min(own) IS NOT NULL""",
)
def state_retention(spark, sf, files_per_trigger=None, delay="0 seconds"):
    """Bets per player until two days after registration, first bet or first result; a timer of the player clears the list."""
    events = event_stream(spark, sf, files_per_trigger)
    micros = lambda text: F.unix_micros(F.to_timestamp(text))
    rows = events.select(
        *P.KEY, *P.ORDER, micros(F.col("reg_datetime")).alias("reg_us"), micros(F.col("bet_datetime")).alias("bet_us"),
        F.when(F.col("has_resulted").isin("true", "1"), F.unix_micros(F.col("ts").cast("timestamp"))).alias("result_us"))
    told = in_order(spark, "retention", rows, ordered.BetRetention(), "kept bigint", ["reg_us", "bet_us", "result_us"], delay=delay)
    return told.filter(~F.col("late")).select(*P.KEY, "kept")


TOPIC_DELAYS = {"players": "1 hour", "logins": "0 seconds", "wagering": "2 hours", "wallet": "30 minutes"}


def topic_streams(spark, sf, files_per_trigger=None, folders=None):
    """One stream over four sources, each with its own watermark, in event-time order per player."""
    parts = {t: event_stream(spark, (folders or {}).get(t, sf), files_per_trigger).filter(F.col("topic") == t).select(*P.KEY, *P.ORDER) for t in TOPIC_DELAYS}
    streams = lambda close: union_watermarked({t: (p.unionByName(close), TOPIC_DELAYS[t]) for t, p in parts.items()})
    rows = parts["players"]
    told = in_order(spark, "topics", rows, ordered.Dispatched(), "topic string, n bigint", ["topic"], delay=None, streams=streams)
    return told.filter(~F.col("late"))


@query("stream_union", f"{EV} SELECT seq, topic, player_id, row_number() OVER (PARTITION BY brand_id, player_id ORDER BY ts, seq) AS n FROM ev")
def stream_union(spark, sf, files_per_trigger=None):
    """The rows of all topics and their number in their player's order, which the slowest topic decides."""
    return topic_streams(spark, sf, files_per_trigger).select("seq", "topic", "player_id", "n")


@query("multi_topic_stream", f"{EV} SELECT topic, count(*) AS n, count(DISTINCT player_id) AS players FROM ev GROUP BY 1")
def multi_topic_stream(spark, sf, files_per_trigger=None):
    rows = topic_streams(spark, sf, files_per_trigger)
    return rows.groupBy("topic").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("player_id").alias("players"))


@query("stream_json_topic", f"{EV} SELECT CAST(seq AS STRING) AS seq, email FROM ev WHERE topic = 'players'")
def stream_json_topic(spark, sf):
    """A topic of JSON lines, read as a capped stream with an all-text schema."""
    base = run_dir(spark, "topic")
    T.events(spark, sf, "players").select("seq", "email", "phone").write.json(f"{base}/in")
    parsed = json_columns(stream_json_files(spark, f"{base}/in"), J.text_schema("seq", "email"))
    output = BatchOutput(spark, f"{base}/rows")
    jobs.finish(jobs.run(parsed, output.write, f"{base}/checkpoint"))
    return output.read(parsed.schema).select("seq", "email")


@query("stream_to_json_files", f"{EV} SELECT seq, player_id, dt FROM ev WHERE topic = 'logins'")
def stream_to_json_files(spark, sf):
    base = run_dir(spark, "json-sink")
    rows = event_stream(spark, sf).filter(F.col("topic") == "logins").select("seq", "player_id", "dt")
    jobs.finish(jobs.to_json_files(rows, f"{base}/rows", f"{base}/checkpoint"))
    return spark.read.schema("seq bigint, player_id bigint, dt string").json(f"{base}/rows")


def _changelog(spark, sf, deleted, files_per_trigger, delay):
    """Changes of the table of a changelog, and the table itself, which is the state of the job."""
    rows = event_stream(spark, sf, files_per_trigger).select(*P.KEY, *P.ORDER, "dt", deleted.alias("deleted"))
    base = run_dir(spark, "changelog")
    told = in_order(spark, "changelog", rows, ordered.Upserts(), "op string, dt string", ["dt", "deleted"], delay=delay, base=base)
    return told.filter(~F.col("late")), ordered.table_of(spark, f"{base}/checkpoint", ordered.key_types(rows, P.KEY), "seq bigint, dt string")


@query("changelog_to_table", f"""{EV} SELECT brand_id, player_id, max(seq) AS seq, arg_max(dt, seq) AS dt FROM ev GROUP BY 1, 2""")
def changelog_to_table(spark, sf, files_per_trigger=None, delay="0 seconds"):
    return _changelog(spark, sf, F.lit(False), files_per_trigger, delay)[1]


#: Rows whose value is missing, which remove their player.
REMOVAL = "coalesce(k % 5 = 0, false)"
REMOVALS = f"{EV}, c AS (SELECT *, {REMOVAL} AS deleted, lag(NOT {REMOVAL}) OVER w AS there, row_number() OVER (PARTITION BY brand_id, player_id ORDER BY ts DESC, seq DESC) AS rn FROM ev WINDOW w AS (PARTITION BY brand_id, player_id ORDER BY ts, seq))"


@query("changelog_deletes", f"{REMOVALS} SELECT brand_id, player_id, seq, dt FROM c WHERE rn = 1 AND NOT deleted")
def changelog_deletes(spark, sf, files_per_trigger=None, delay="0 seconds"):
    """The table of a changelog with removals: a player whose last row is one is not in it."""
    return _changelog(spark, sf, F.expr(REMOVAL), files_per_trigger, delay)[1]


@query("changelog_feed", f"{REMOVALS} SELECT seq, brand_id, player_id, CASE WHEN deleted THEN 'delete' WHEN there THEN 'update' ELSE 'insert' END AS op FROM c WHERE NOT deleted OR coalesce(there, false)")
def changelog_feed(spark, sf, files_per_trigger=None, delay="0 seconds"):
    """Inserts, updates and deletes of that table, one row for each change."""
    return _changelog(spark, sf, F.expr(REMOVAL), files_per_trigger, delay)[0].select("seq", *P.KEY, "op")


@query(
    "outbox_sink",
    f"""{EV} SELECT seq, sha256(CAST(brand_id AS STRING) || '|' || CAST(player_id AS STRING) || '|player_login|' || CAST(seq AS STRING)) AS dedup_id FROM ev WHERE topic = 'logins'""",
)
def outbox_sink(spark, sf):
    """Every message is sent to the sink twice and delivered once."""
    base = run_dir(spark, "outbox")
    logins = event_stream(spark, sf).filter(F.col("topic") == "logins").withColumn("selector", F.lit("player_login"))
    messages = O.outbox(logins.drop("channel"), ("dt",))
    repeated = messages.withColumn("__twice", F.explode(F.array(F.lit(1), F.lit(2)))).drop("__twice")
    ledger, output = BatchOutput(spark, f"{base}/ledger"), BatchOutput(spark, f"{base}/sent")
    jobs.finish(jobs.run(repeated, jobs.deliver(ledger, output), f"{base}/checkpoint"))
    return output.read(messages.schema).select("seq", "dedup_id")


@query(
    "stream_bet_join",
    f"""{BS}, w AS (SELECT *, row_number() OVER (PARTITION BY bet_id ORDER BY bet_datetime DESC, line_no DESC, wager_amount DESC) AS rn FROM bets)
    SELECT bet_id, wager_amount, championship_id FROM w JOIN sports USING (bet_id) WHERE rn = 1""",
)
def stream_bet_join(spark, sf, files_per_trigger=None, delay="0 seconds"):
    """Two streams, told again whenever either side of a bet comes; the last of it is the joined table. Sides may lie years apart here, so no bet is forgotten."""
    wagers = stream_table(spark, sf, "lineitem", files_per_trigger).selectExpr(*[f"{e} AS {n}" for n, e in T.BET_COLUMNS.items()])
    sports = stream_table(spark, sf, "orders", files_per_trigger).selectExpr(*[f"{e} AS {n}" for n, e in T.SPORTS_BET_COLUMNS.items()])
    left = wagers.select(
        "bet_id", F.col("bet_datetime").alias("ts"), _wager_seq().alias("seq"),
        F.struct("wager_amount").alias("wagering"), F.lit(None).cast("struct<championship_id:string>").alias("sportsbets"),
    )
    right = sports.select(
        "bet_id", F.col("placed_at").alias("ts"), F.lit(0).cast("bigint").alias("seq"),
        F.lit(None).cast("struct<wager_amount:double>").alias("wagering"), F.struct("championship_id").alias("sportsbets"),
    )
    sides = {"wagering": "struct<wager_amount:double>", "sportsbets": "struct<championship_id:string>"}
    out = ", ".join(f"{n} {t}" for n, t in sides.items())
    told = in_order(spark, "bet-join", left.unionByName(right), ordered.BothSides(sides), out, list(sides), keys=("bet_id",), delay=delay)
    final = told.filter(~F.col("late")).groupBy("bet_id").agg(F.max_by(F.struct(*sides), F.struct("us", "seq")).alias("v"))
    return final.select("bet_id", "v.wagering.wager_amount", "v.sportsbets.championship_id")


def _wager_seq():
    # Line number first, then the amount in cents, as one sortable number.
    return (F.col("line_no").cast("bigint") * F.lit(10**12) + F.round(F.col("wager_amount") * 100).cast("bigint")).cast("bigint")


@query("stream_bet_accumulate_join", f"{BS}, {WATCHED} SELECT * FROM m")
def stream_bet_accumulate_join(spark, sf, files_per_trigger=None, delay="0 seconds"):
    bets = stream_table(spark, sf, "lineitem", files_per_trigger).selectExpr(*[f"{e} AS {n}" for n, e in T.BET_COLUMNS.items()])
    sports = stream_table(spark, sf, "orders", files_per_trigger).selectExpr(*[f"{e} AS {n}" for n, e in T.SPORTS_BET_COLUMNS.items()])
    rows = bet_news(sports, vertical_wagers(bets), list(CHAMPIONSHIPS))
    out = "championship_id string, kind string, bet_won_lost string, result_date string"
    told = in_order(spark, "watched", rows, ordered.WatchedBets(), out, ["sport", "settlement", "is_wager"], keys=("bet_id",), delay=delay)
    return told.filter(~F.col("late")).drop("us", "seq", "late")


@query("recheck_all", f"SELECT request_id, player_id, accept_uri FROM ({ORACLES['evaluate_rules']})")
def recheck_all(spark, sf, files_per_trigger=None, whole=False):
    """Rules evaluated per micro-batch of deposits, for the players it touches."""
    requests = PR._requests(spark, sf)
    rows = event_stream(spark, sf, files_per_trigger).filter(F.col("topic") == "wallet").withColumn("transaction_id", F.col("seq"))
    deposits = PR.R.valid_deposits(rows).select("player_id", "second", "amount", "transaction_id")
    base = run_dir(spark, "recheck")
    fired = BatchOutput(spark, f"{base}/fired")
    schema = S.StructType.fromDDL("request_id bigint, player_id bigint, accept_uri string, amount double")
    step = jobs.recheck_rules(requests, BatchOutput(spark, f"{base}/deposits"), fired, schema, whole)
    jobs.finish(jobs.run(deposits, step, f"{base}/checkpoint"))
    return fired.read(schema).select("request_id", "player_id", "accept_uri")


@query(
    "recheck_live",
    f"""{EV}, dep AS (SELECT player_id, seq, amount, ts, date_trunc('second', ts) AS sec FROM ev WHERE starts_with(lower(transaction_type), 'deposit-') AND starts_with(lower(transaction_status), 'complete')),
    {PR.REQUESTS.replace("JOIN d ON d.player_id", "JOIN (SELECT *, seq AS transaction_id FROM dep) d ON d.player_id")},
    mo AS (SELECT request_id, player_id, ts AS mt, request_id AS mt_seq FROM ok
      UNION ALL SELECT ok.request_id, ok.player_id, dep.ts, dep.seq FROM ok JOIN dep ON dep.player_id = ok.player_id AND (dep.ts > ok.ts OR (dep.ts = ok.ts AND dep.seq > ok.request_id)) AND dep.ts <= ok.expires_at),
    fact AS (SELECT mo.request_id, mt, mt_seq, rule_no, any_value(symbol) AS symbol, any_value(times) AS times, any_value(r.amount) AS amount, count(*) AS n, CAST(sum(CAST(dep.amount AS DECIMAL(18,2))) AS DOUBLE) AS total,
        bool_or(times IS NULL AND {PR._cmp('r.amount', 'dep.amount')}) AS hit
      FROM mo JOIN r USING (request_id) JOIN dep ON dep.player_id = mo.player_id AND (dep.ts < mt OR (dep.ts = mt AND dep.seq <= mt_seq)) AND dep.sec BETWEEN date_trunc('second', f) AND date_trunc('second', t) GROUP BY 1, 2, 3, 4),
    met AS (SELECT request_id, mt, mt_seq FROM fact WHERE CASE WHEN times IS NULL THEN hit ELSE {PR._cmp('times', 'n')} AND (amount IS NULL OR {PR._cmp('amount', 'total')}) END),
    fired AS (SELECT request_id, min(mt) AS mt FROM (SELECT request_id, mt, mt_seq, count(*) AS c FROM met GROUP BY ALL) JOIN ok USING (request_id) WHERE c = expected GROUP BY 1)
    SELECT request_id, ok.player_id, fired.mt IS NULL AS expired, CASE WHEN fired.mt IS NULL THEN epoch_us(expires_at) + 1 ELSE epoch_us(fired.mt) END AS us FROM ok LEFT JOIN fired USING (request_id)""",
)
def recheck_live(spark, sf, files_per_trigger=None, delay="0 seconds"):
    """Requests and deposits as two topics of one keyed process: a request fires at the first moment at which all its rules hold, or expires."""
    events = event_stream(spark, sf, files_per_trigger)
    requests = PR.requests_of(events.filter(F.col("topic") == "players"))
    wallet = event_stream(spark, sf, files_per_trigger).filter(F.col("topic") == "wallet").withColumn("transaction_id", F.col("seq"))
    rows = PR.R.live_rows(requests, PR.R.valid_deposits(wallet))
    out = "request_id bigint, accept_uri string, expired boolean"
    told = in_order(spark, "live", rows, ordered.LiveRequests(), out, ["request", "deposit"], keys=("player_id",), delay=delay)
    return told.filter(~F.col("late")).select("request_id", "player_id", "expired", "us")


@query("stream_delta_snapshot", f"""{EV} SELECT brand_id, player_id, arg_max(email, seq) FILTER (WHERE email IS NOT NULL) AS email, arg_max(balance, seq) FILTER (WHERE balance IS NOT NULL) AS balance FROM ev GROUP BY 1, 2""")
def stream_delta_snapshot(spark, sf, files_per_trigger=None, delay="0 seconds"):
    """Each micro-batch exports the players it touched, once and with their whole merged state."""
    fields = ("email", "balance")
    rows = event_stream(spark, sf, files_per_trigger).select(*P.KEY, *P.ORDER, *fields)
    out = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in fields)
    latest = lambda told: told.groupBy(*P.KEY, "late").agg(F.max_by(F.struct("us", "seq", *fields), F.struct("us", "seq")).alias("v")).select(*P.KEY, "late", "v.*")
    told = in_order(spark, "deltas", rows, ordered.Merged(fields), out, fields, delay=delay, reduced=latest)
    return latest(told.filter(~F.col("late"))).select(*P.KEY, *fields)


@query("scheduled_emit", f"{EV} SELECT seq, player_id FROM ev WHERE hour(ts) >= 4 AND hour(ts) < 12")
def scheduled_emit(spark, sf):
    """Rows whose time lies in the hours a scheduled job may send."""
    return T.events(spark, sf).filter(jobs.in_hours(F.col("ts"), 4, 12)).select("seq", "player_id")


#: Moments at which the schedule starts the export; two lie outside its hours, one comes twice.
STARTS = ("2024-01-08 03:59:59", "2024-01-08 04:00:00", "2024-01-15 11:59:59", "2024-01-15 11:59:59", "2024-01-20 12:00:00", "2024-01-27 08:30:00")
_RUNS = ", ".join(f"(TIMESTAMP '{now}', TIMESTAMP '{before}')" for now, before in (("2024-01-08 04:00:00", "1900-01-01 00:00:00"), ("2024-01-15 11:59:59", "2024-01-08 04:00:00"), ("2024-01-27 08:30:00", "2024-01-15 11:59:59")))


@query(
    "scheduled_export",
    f"""{EV}, s(now, mark) AS (VALUES {_RUNS})
    SELECT CAST(epoch_us(now) AS BIGINT) AS until, brand_id, player_id, arg_max(email, seq) FILTER (WHERE email IS NOT NULL) AS email, arg_max(balance, seq) FILTER (WHERE balance IS NOT NULL) AS balance
    FROM ev JOIN s ON ts <= now GROUP BY now, mark, 2, 3 HAVING max(ts) > any_value(mark)""",
)
def scheduled_export(spark, sf):
    """Profiles touched between two exports go out once, in the hours of the job only."""
    export = jobs.ScheduledExport(spark, run_dir(spark, "scheduled"))
    fields = {c: F.col(c) for c in ("email", "balance")}
    snapshot = lambda known: latest_values(T.events(spark, sf).filter(known), P.KEY, P.ORDER, {**fields, "updated_ts": F.col("ts")})
    for now in STARTS:
        export.run(datetime.fromisoformat(now), snapshot)
    rows = spark.read.schema("brand_id bigint, player_id bigint, email string, balance double, until bigint").json(export.path)
    return rows.select("until", *P.KEY, "email", "balance")


@query("ordering_late_data", f"{EV} SELECT brand_id, player_id, seq, row_number() OVER w AS n, lag(seq) OVER w AS previous, false AS late FROM ev WINDOW w AS (PARTITION BY brand_id, player_id ORDER BY ts, seq)")
def ordering_late_data(spark, sf, files_per_trigger=None, delay="0 seconds"):
    """Rows wait for the watermark and are numbered in event-time order; those behind it are told as late, without a number."""
    rows = event_stream(spark, sf, files_per_trigger).select(*P.KEY, *P.ORDER)
    told = in_order(spark, "ordering", rows, ordered.Numbered(), "n bigint, previous bigint", ["seq"], delay=delay)
    return told.select(*P.KEY, "seq", "n", "previous", "late")


@query("exactly_once", f"{EV} SELECT count(*) AS delivered, count(*) AS distinct_ids FROM ev WHERE topic = 'logins'")
def exactly_once(spark, sf):
    """Two runs over the same input deliver the same ids: replays can be recognised."""
    first, second = outbox_sink(spark, sf), outbox_sink(spark, sf)
    both = first.unionByName(second)
    return both.agg((F.count(F.lit(1)) / 2).cast("bigint").alias("delivered"), F.countDistinct("dedup_id").alias("distinct_ids"))
