"""Per-player state over the event history, and what its changes emit.

A state machine step "merge event, compare old and new, emit" becomes: the
state before and after each row as running values, then a filter. Milestones
that happen once per player are aggregates and need no running value at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playerflow.functions.flags import to_bool
from playerflow.functions.text import blank_to_null, contains_any_ci
from playerflow.functions.times import newer_than, parse_prefix19
from playerflow.operators.timeline import Count, Last, first_rows, last_rows, latest_values, running

KEY = ("brand_id", "player_id")
ORDER = ("ts", "seq")
BEFORE = "prior_"
SEEN = "prior_rows"

# Payment method names that mark a crypto deposit.
CRYPTO_METHODS = (
    "letknowpay", "xbo", "coinpayments", "bitcoin", "doge", "litecoin", "usdtether trc20",
    "usdtether erc20", "usdtether bep20", "ethereum", "ripple", "usdcoin", "bitcoin cash", "cardano",
)


def overwriting(applies: Column, value: Column) -> Last:
    """Latest value of the rows where ``applies``, even when that value is null."""
    return Last(F.when(applies, F.struct(value.alias("v"))))


def merge(df: DataFrame, fields: dict[str, Column], skip_blank: bool = False, keys=KEY) -> DataFrame:
    """State after every event: latest non-null value per field."""
    picked = {n: blank_to_null(c) if skip_blank else c for n, c in fields.items()}
    return running(df, keys, ORDER, after={n: Last(c) for n, c in picked.items()})


def transitions(df: DataFrame, fields: dict[str, Column], keys=KEY, skip_blank: bool = False) -> DataFrame:
    """State before (``prior_`` columns) and after every event, plus the number of earlier rows."""
    lasts = {n: Last(blank_to_null(c) if skip_blank else c) for n, c in fields.items()}
    return running(
        df,
        keys,
        ORDER,
        after=lasts,
        before={**{BEFORE + n: a for n, a in lasts.items()}, SEEN: Count(F.lit(True))},
    )


def differs(*fields: str) -> Column:
    """Null-safe: some field changed."""
    changed = F.lit(False)
    for name in fields:
        changed = changed | ~F.col(name).eqNullSafe(F.col(BEFORE + name))
    return changed


def changed_or_first(*fields: str) -> Column:
    return (F.col(SEEN) == 0) | differs(*fields)


def profile_changes(df: DataFrame, fields: dict[str, Column], needs_full_record: Column | None = None) -> DataFrame:
    """Rows after which the outward projection differs.

    The first row counts as changed, unless a full record must come first:
    then only rows after the first full record can emit.
    """
    if needs_full_record is None:
        return transitions(df, fields).filter(changed_or_first(*fields))
    lasts = {n: Last(c) for n, c in fields.items()}
    rows = running(
        df, KEY, ORDER, after=lasts,
        before={**{BEFORE + n: a for n, a in lasts.items()}, "full_records": Count(needs_full_record)},
    )
    return rows.filter((F.col("full_records") > 0) & differs(*fields))


def toggled_when_present(df: DataFrame, flag: str) -> DataFrame:
    """The merged flag is known and differs, in any case, from the one before."""
    rows = transitions(df, {flag: F.col(flag)})
    return rows.filter(F.col(flag).isNotNull() & ~F.lower(flag).eqNullSafe(F.lower(BEFORE + flag)))


def registration_or_update(df: DataFrame) -> DataFrame:
    """First record of a player registers, every later one updates."""
    rows = running(df, KEY, ORDER, before={SEEN: Count(F.lit(True))})
    return rows.withColumn("selector", F.when(F.col(SEEN) == 0, "player_registration").otherwise("player_updated"))


def first_known(df: DataFrame, value: str, fresh_seconds: int | None = None) -> DataFrame:
    """First event that carries ``value``; optionally only when it was recent at that time."""
    rows = first_rows(df.filter(F.col(value).isNotNull()), KEY, ORDER, ["ts", "seq", value])
    if fresh_seconds is None:
        return rows
    return rows.filter(newer_than(parse_prefix19(F.col(value)), F.col("ts"), fresh_seconds))


DEFAULT_CONSENT_CHANNELS = ("SMS", "EMAIL")


def registration_needs_email(df: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """Nothing until the e-mail is known; then a registration with default "no consent" rows, later updates."""
    source = df.drop("selector", "channel")
    rows = transitions(source, fields, skip_blank=True).filter(F.col("email").isNotNull() & changed_or_first(*fields))
    message = lambda selector, channel: F.struct(F.lit(selector).alias("selector"), F.lit(channel).alias("channel"))
    first = F.array(
        message("player_registration", ""), *[message("player_consent", c) for c in DEFAULT_CONSENT_CHANNELS]
    )
    later = F.array(message("player_updated", ""))
    return rows.select("*", F.explode(F.when(F.col(BEFORE + "email").isNull(), first).otherwise(later)).alias("m")).select(
        "*", "m.selector", "m.channel"
    ).drop("m")


def first_last_wallet(df: DataFrame, history: Column) -> DataFrame:
    """First and last deposit and withdrawal messages.

    A message matches when the type *contains* the word, the state is set only
    when it *equals* the word; history rows overwrite the state, blank is none.
    """
    kind = F.lower("transaction_type")
    is_wallet = F.col("topic") == "wallet"
    seed = blank_to_null(F.col("first_dep_datetime"))

    def state(word, seeded):
        value = F.when(is_wallet & (kind == word), F.struct(F.col("dt").alias("v")))
        return Last(F.coalesce(value, F.when(history, F.struct(seeded.alias("v")))))

    rows = running(
        df, KEY, ORDER,
        before={"had_deposit": state("deposit", seed), "had_withdrawal": state("withdrawal", F.lit(None).cast("string"))},
    ).filter(is_wallet)
    deposit, withdrawal = kind.contains("deposit"), kind.contains("withdrawal")
    messages = F.array_compact(
        F.array(
            F.when(deposit & F.col("had_deposit.v").isNull(), "FIRST_DEPOSIT"),
            F.when(withdrawal & F.col("had_withdrawal.v").isNull(), "FIRST_WITHDRAWAL"),
            F.when(deposit, "LAST_DEPOSIT"),
            F.when(withdrawal, "LAST_WITHDRAWAL"),
        )
    )
    return rows.select("seq", *KEY, "amount", F.explode(messages).alias("selector"))


def confirmed_once(df: DataFrame, flag: str, registered_from: str) -> DataFrame:
    """First event at which the merged flag is true for a player registered on or after a date."""
    state = merge(df, {flag: F.col(flag), "reg_datetime": F.col("reg_datetime")})
    ready = to_bool(F.col(flag), ("true",), ignore_case=True) & (
        F.coalesce(F.substring("reg_datetime", 1, 10) >= registered_from, F.lit(False))
    )
    return first_rows(state.filter(ready), KEY, ORDER, ["ts", "seq"])


def verified_events(df: DataFrame, flag: str) -> DataFrame:
    """The merged flag turns true (again) after being absent, blank or false."""
    rows = transitions(df, {flag: F.col(flag)})
    was = F.lower(F.trim(F.col(BEFORE + flag)))
    return rows.filter((F.coalesce(was, F.lit("")).isin("", "false")) & (F.lower(flag) == "true"))


def first_deposit_loss(df: DataFrame, limit: float = 5) -> DataFrame:
    """Once: balance under the limit while the player has exactly one deposit."""
    hits = df.filter((F.col("balance") < limit) & (F.col("lifetime_count") == 1) & F.col("ts").isNotNull())
    return first_rows(hits, KEY, ORDER, ["ts", "seq", "balance"])


def crypto_deposit_once(df: DataFrame, methods: Sequence[str] = CRYPTO_METHODS) -> DataFrame:
    """Completed crypto deposit, once per player and transaction."""
    hits = df.filter(
        F.lower("transaction_type").contains("deposit")
        & (F.col("transaction_status") == "complete")
        & contains_any_ci(F.col("pay_method"), methods)
    )
    return first_rows(hits, [*KEY, "transaction_id"], ORDER, ["ts", "seq", "amount"])


def latest_by_text_time(df: DataFrame, text_time: str, columns: Sequence[str]) -> DataFrame:
    """Row with the greatest datetime text; the earliest arrival wins ties, absent text sorts first."""
    ranked = df.withColumn("__t", F.coalesce(text_time, F.lit(""))).withColumn("__s", -F.col("seq"))
    return last_rows(ranked, KEY, ["__t", "__s"], ["__s", text_time, *columns]).withColumn("seq", -F.col("__s")).drop("__s")


def latest_by_arrival(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Last non-null value by arrival, each column on its own."""
    return drop_all_null(latest_values(df, KEY, ORDER, {c: F.col(c) for c in columns}), columns)


def vip_level_changes(df: DataFrame, level: str) -> DataFrame:
    """Every event updates; a level that differs from the one before sends a second message."""
    rows = running(df, KEY, ORDER, before={"prior_level": overwriting(F.lit(True), F.col(level))})
    changed = F.col(level).isNotNull() & ~F.col("prior_level.v").eqNullSafe(F.col(level))
    messages = F.array_compact(F.array(F.lit("vip_update"), F.when(changed, "viplevel25_changed")))
    return rows.select("seq", *KEY, level, F.explode(messages).alias("selector"))


def hold_until_profile(df: DataFrame, is_profile: Column, is_action: Column) -> DataFrame:
    """Actions before the first player record are released, in order, when it arrives.

    Only the first record per player is needed on the other side, an aggregate.
    """
    first = first_rows(df.filter(is_profile), KEY, ORDER, list(ORDER)).select(
        *KEY, F.col("ts").alias("profile_ts"), F.col("seq").alias("profile_seq")
    )
    held = F.struct("ts", "seq") < F.struct(F.col("profile_ts").alias("ts"), F.col("profile_seq").alias("seq"))
    return df.filter(is_action).join(first, list(KEY)).select(
        "*", held.alias("held"), F.when(held, F.col("profile_seq")).otherwise(F.col("seq")).alias("released_by")
    )


def lifetime_properties(state: DataFrame) -> DataFrame:
    """brand_id, id and the lifetime properties of a wallet's merged state, as texts but for the count and the average.

    A count that is no number counts as unknown; the average needs a count above zero.
    """
    count = F.col("LifetimeDepositCount").try_cast("int")
    average = F.when(count > 0, F.col("TotalDepositEUR").try_cast("double") / count)
    same = ("LifetimeWithdrawalCount", "LifetimeWithdrawalCountEUR", "TotalWithdrawalLifetime", "TotalWithdrawalLifetimeEUR", "TotalDeposit", "TotalDepositEUR")
    properties = F.struct(count.alias("lifetimeDepositCount"), average.alias("averageDeposit"), F.substring("last_deposit_datetime", 1, 10).alias("last_deposit_date"), *same)
    return state.select("brand_id", F.col("player_id").cast("string").alias("id"), properties.alias("properties"))


def drop_all_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Skip records whose metrics are all absent."""
    present = F.lit(False)
    for name in columns:
        present = present | F.col(name).isNotNull()
    return df.filter(present)


def delta_snapshot(df: DataFrame, fields: dict[str, Column], last_export: str) -> DataFrame:
    """Current state of the players touched since the last export."""
    state = latest_values(df, KEY, ORDER, {**fields, "updated_ts": F.col("ts")})
    return state.filter(F.col("updated_ts") > F.lit(last_export).cast("timestamp_ntz"))


def email_change_request(df: DataFrame) -> DataFrame:
    """Stored and incoming e-mail are both known and differ."""
    rows = running(df, KEY, ORDER, before={"stored_email": Last(F.col("email"))})
    return rows.filter(F.col("email") != F.col("stored_email"))


def block_expiry(df: DataFrame) -> DataFrame:
    """Status turns absent while 3 or 1 is stored; the stored status is then reset."""
    status = F.col("player_status")
    stored = F.when(status.isin("1", "2", "3") & F.col("blocked_start").isNotNull(), status).when(
        status.isNull(), F.lit("cleared")
    )
    rows = running(df, KEY, ORDER, before={"stored": Last(stored)})
    return rows.filter(status.isNull() & F.col("stored").isin("3", "1")).withColumn(
        "selector", F.when(F.col("stored") == "3", "self_exclusion_expired").otherwise("timeout_expired")
    )


def notices() -> dict[str, Column]:
    """What counts as a self-exclusion or timeout notice."""
    started = F.col("blocked_start").isNotNull()
    return {
        "nb_self_exclusion": F.col("player_status").isin("2", "3") & started,
        "nb_timeout": (F.col("player_status") == "1") & started,
    }


def block_counters(df: DataFrame) -> DataFrame:
    """Running number of self-exclusion and timeout notices per player."""
    return running(df, KEY, ORDER, after={n: Count(c) for n, c in notices().items()})


def counter_diff(df: DataFrame, counters: dict[str, Column]) -> DataFrame:
    """One row per counter that exceeds the value already processed."""
    counts = {n: Count(c) for n, c in counters.items()}
    rows = running(df, KEY, ORDER, after=counts, before={BEFORE + n: a for n, a in counts.items()})
    grew = [
        F.when(F.col(n) > F.col(BEFORE + n), F.struct(F.lit(n).alias("counter"), F.col(n).alias("value")))
        for n in counters
    ]
    return rows.select("seq", *KEY, F.explode(F.array_compact(F.array(*grew))).alias("c")).select(
        "seq", *KEY, "c.counter", "c.value"
    )


def deposit_state(df: DataFrame, last_deposit: Column, first_deposit: Column) -> DataFrame:
    """``failed_deposit_date`` on decline and the sticky ``is_first_deposit`` flag, with the change mark."""
    failed = Last(F.when(F.col("transaction_status") == "decline", F.col("dt")))
    first = Last(F.when(first_deposit.isNotNull() & (last_deposit.isNull() | (first_deposit == last_deposit)), F.lit("true")))
    rows = running(
        df, KEY, ORDER,
        after={"failed_deposit_date": failed, "is_first_deposit": first},
        before={BEFORE + "failed_deposit_date": failed},
    )
    return rows.withColumn(
        "failed_changed", F.col("failed_deposit_date").isNotNull() & differs("failed_deposit_date")
    )


def registered_change(df: DataFrame) -> DataFrame:
    """``player_registered`` on a new or changed registration time, ``self_exclusion`` while excluded."""
    rows = transitions(df, {"reg_datetime": F.col("reg_datetime"), "is_self_excluded": F.col("is_self_excluded")})
    messages = F.array_compact(
        F.array(
            F.when(F.col("is_self_excluded") == "true", "self_exclusion"),
            F.when(F.col("reg_datetime").isNotNull() & differs("reg_datetime"), "player_registered"),
        )
    )
    return rows.select("seq", *KEY, "reg_datetime", F.explode(messages).alias("selector"))


def player_messages(df: DataFrame, outward: Sequence[str], channels: Sequence[str] = ("EMAIL", "SMS")) -> DataFrame:
    """All state-driven messages of the player, wallet and consent events in one pass.

    Run one by one, each rule would shuffle the same events by the same key.
    Here all states are running values of a single window, and the rules are
    conditions on one row: one shuffle and one sort for the whole set.
    """
    is_player = F.col("topic") == "players"
    status = F.col("player_status")
    blocking = F.when(
        is_player,
        F.when(status.isin("1", "2", "3") & F.col("blocked_start").isNotNull(), status).when(status.isNull(), "cleared"),
    )
    state = {c: Last(F.col(c)) for c in dict.fromkeys([*outward, "email", "is_self_excluded", "is_verified", "first_dep_datetime"])}
    state["failed_date"] = Last(F.when(F.col("transaction_status") == "decline", F.col("dt")))
    consent = {f"consent_{c.lower()}": F.when(F.upper("channel") == c, F.col("consented")) for c in channels}
    state.update({n: Last(c) for n, c in consent.items()})
    players_seen = Count(is_player)
    rows = running(
        df, KEY, ORDER,
        after=state,
        before={**{BEFORE + n: a for n, a in state.items()}, SEEN: players_seen, "stored_status": Last(blocking)},
    )
    first = F.col(SEEN) == 0
    was_verified = F.coalesce(F.lower(F.trim(F.col(BEFORE + "is_verified"))), F.lit(""))
    messages = [
        (is_player & (first | differs(*outward)), F.when(first, "player_registration").otherwise("player_updated")),
        (is_player & (first | differs("is_self_excluded")), F.lit("user_blocked_toggle")),
        (F.col("email") != F.col(BEFORE + "email"), F.lit("player_email_change_request")),
        (was_verified.isin("", "false") & (F.lower("is_verified") == "true"), F.lit("player_isverified")),
        (F.col(BEFORE + "first_dep_datetime").isNull() & F.col("first_dep_datetime").isNotNull(), F.lit("first_deposit")),
        (F.col("failed_date").isNotNull() & differs("failed_date"), F.lit("failed_deposit")),
        (is_player & status.isNull() & (F.col("stored_status") == "3"), F.lit("self_exclusion_expired")),
        (is_player & status.isNull() & (F.col("stored_status") == "1"), F.lit("timeout_expired")),
        *[(differs(n), F.lit("consent_change_" + n.removeprefix("consent_"))) for n in consent],
    ]
    picked = F.array_compact(F.array(*[F.when(condition, selector) for condition, selector in messages]))
    return rows.withColumn("selector", F.explode(picked))


def own_brand_messages(df: DataFrame, brands: Sequence, fields: dict[str, Column], is_player: Column, is_check: Column, kind: str = "transaction_type") -> DataFrame:
    """Messages of the brands with their own pipeline.

    A player record sends a login and, if the outward fields changed, a
    registration; an identity check sends ``kyc``; wallet rows go by the start of their type.
    """
    rows = df.filter(F.col("brand_id").isin(list(brands)))
    players = transitions(rows.filter(is_player), fields)
    messages = F.array_compact(F.array(F.when(changed_or_first(*fields), "player_registered"), F.lit("player_login")))
    others = F.when(is_check, "kyc").when(F.lower(kind).startswith("deposit"), "deposit_event").when(
        F.lower(kind).startswith("withdraw"), "withdrawal_event"
    )
    columns = ["seq", *KEY, "selector"]
    rest = rows.filter(~is_player).withColumn("selector", others).filter(F.col("selector").isNotNull())
    return players.withColumn("selector", F.explode(messages)).select(*columns).unionByName(rest.select(*columns))


def tombstones(df: DataFrame, deleted: Column, columns: Sequence[str]) -> DataFrame:
    """Latest row per key, unless that row deletes the key."""
    marked = df.withColumn("__deleted", deleted)
    return last_rows(marked, KEY, ORDER, ["ts", "seq", *columns, "__deleted"]).filter(~F.col("__deleted")).drop("__deleted")


def between_start_and_stop(df: DataFrame, keys: Sequence[str], action: str = "action") -> DataFrame:
    """Drop events after the latest ``stop`` until the next ``start``; control rows themselves go too.

    The switch holds for a whole pipeline, so its timeline is as long as the
    feed: the block-wise running value is what keeps it out of a single task.
    """
    rows = running(df, keys, ORDER, after={"switch": Last(F.col(action))})
    return rows.filter(F.col(action).isNull() & (F.coalesce("switch", F.lit("start")) != "stop"))


def snapshot(df: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """Whole profile store: final state of every player."""
    return latest_values(df, KEY, ORDER, fields)


# Gender codes and their texts.
GENDERS = {"0": "Male", "1": "Female"}


def gender_export(state: DataFrame, code: str = "gender_id") -> DataFrame:
    """Description by code; players with another or no code are left out."""
    table = F.create_map(*[F.lit(x) for pair in GENDERS.items() for x in pair])
    return state.withColumn("gender_description", table[F.col(code)]).filter(F.col("gender_description").isNotNull())


def outward(state: DataFrame, restricted_brands: Sequence) -> DataFrame:
    """Public record: renamed columns, ten-character dates, and one column only some brands carry."""
    return state.select(
        F.col("player_id").alias("originalId"),
        "brand_id",
        F.substring("reg_datetime", 1, 10).alias("reg_datetime"),
        F.col("email").alias("emailaddress"),
        "language",
        "country",
        F.when(F.col("brand_id").isin(list(restricted_brands)), F.col("is_self_excluded")).alias("is_deposited_restricted"),
    )
