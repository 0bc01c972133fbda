"""Event-to-message rules. Each family is a list of rules; a row emits every rule it meets."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playerflow.functions.flags import to_bool
from playerflow.functions.text import blank_to_null, date10
from playerflow.functions.times import newer_than, parse_prefix19
from playerflow.operators.timeline import Last, running

# Statuses and transaction types of the wallet families.
FAILED_SEVEN = ("rejected", "error", "cancelled", "voided", "failed", "cancel", "decline")
FAILED_FOUR = ("rejected", "error", "cancelled", "voided")
FAILED_SIX = ("rejected", "error", "cancelled", "voided", "cancel", "failed")
AGENT_FAILED = ("rejected", "agentreject")
SHOP_DEPOSITS = (
    "lucky_egg", "deposit", "day7pack_deposit", "three_deposit", "three_deposit_1", "three_deposit_2",
    "three_deposit_3", "safe_box_deposit", "day7pack_deposit_1", "day7pack_deposit_2", "day7pack_deposit_3",
    "day7pack_deposit_4", "day7pack_deposit_5", "day7pack_deposit_6", "miss_deposit", "lucky_egg_1",
    "lucky_egg_2", "starter_deposit", "promotion_deposit", "shop_charge", "unlock_deposit_2",
    "balance_not_enough_1", "balance_not_enough_2", "vote_charge_1", "vote_charge_2", "repeat_charge",
    "double_reward", "double_room", "lucky_bonus", "activity_charge", "progression_recharge_1",
    "progression_recharge_2", "progression_recharge_3", "progression_recharge_4", "progression_recharge_5",
    "progression_recharge_6", "progression_recharge_7", "new_unlock",
)
TRIGGER_PURCHASES = (
    "shop_charge", "promotion_deposit", "three_deposit_1", "three_deposit_2", "three_deposit_3",
    "unlock_deposit_2", "starter_deposit", "miss_deposit", "day7pack_deposit_1", "day7pack_deposit_2",
    "day7pack_deposit_3", "day7pack_deposit_4", "day7pack_deposit_5", "day7pack_deposit_6",
    "balance_not_enough_1", "balance_not_enough_2", "vote_charge_1", "vote_charge_2", "repeat_charge",
    "double_reward", "double_room", "lucky_bonus", "safe_box_deposit", "lucky_egg_2", "activity_charge",
    "progression_recharge_1", "progression_recharge_2", "progression_recharge_3", "progression_recharge_4",
    "progression_recharge_5", "progression_recharge_6", "progression_recharge_7", "new_unlock",
)


@dataclass(frozen=True)
class WalletRule:
    """Type and status conditions of one selector. Empty means any."""

    selector: str
    types: Sequence[str] = ()
    prefix: str = ""
    statuses: Sequence[str] = ()
    except_statuses: Sequence[str] = ()
    case_sensitive_type: bool = False

    def condition(self, kind: Column, status: Column) -> Column:
        kind = F.coalesce(kind, F.lit(""))
        kind = kind if self.case_sensitive_type else F.lower(kind)
        status = F.lower(F.coalesce(status, F.lit("")))
        met = F.lit(True)
        if self.types:
            met = met & kind.isin(list(self.types))
        if self.prefix:
            met = met & kind.startswith(self.prefix)
        if self.statuses:
            met = met & status.isin(list(self.statuses))
        if self.except_statuses:
            met = met & ~status.isin(list(self.except_statuses))
        return met


WALLET_FAMILIES: dict[str, tuple[WalletRule, ...]] = {
    "exact_failed_seven": (
        WalletRule("failed_deposit", types=("deposit",), statuses=FAILED_SEVEN),
        WalletRule("failed_withdrawal", types=("withdrawal",), statuses=FAILED_SEVEN),
    ),
    "exact_failed_four": (
        WalletRule("failed_deposit", types=("deposit",), statuses=FAILED_FOUR),
        WalletRule("failed_withdrawal", types=("withdraw",), statuses=FAILED_FOUR),
    ),
    "shop_failed_six": (
        WalletRule("failed_deposit", types=SHOP_DEPOSITS, statuses=FAILED_SIX),
        WalletRule("failed_withdrawal", types=("withdraw",), statuses=FAILED_SIX),
    ),
    "prefix_both": (
        WalletRule("failed_deposit", prefix="deposit_", statuses=AGENT_FAILED),
        WalletRule("failed_withdrawal", prefix="withdraw_", statuses=AGENT_FAILED),
        WalletRule("success_withdrawal", prefix="withdraw_", statuses=("completed",)),
        WalletRule("success_deposit", prefix="deposit_", statuses=("completed",)),
    ),
    "prefix_failed": (
        WalletRule("failed_deposit", prefix="deposit_", statuses=("failed",)),
        WalletRule("failed_withdrawal", prefix="withdraw_", statuses=("failed",)),
    ),
    "prefix_approved": (
        WalletRule("DEPOSIT_APPROVED", prefix="deposit", statuses=("completed", "approved")),
        WalletRule("WITHDRAWAL_APPROVED", prefix="withdraw", statuses=("approved",)),
    ),
    "not_accepted": (
        WalletRule("failed_deposit", types=("Deposit",), except_statuses=("accepted",), case_sensitive_type=True),
        WalletRule("failed_withdrawal", types=("Withdraw",), except_statuses=("accepted",), case_sensitive_type=True),
    ),
    "coded": (
        WalletRule("failed_deposit", statuses=("dep_declined",)),
        WalletRule("deposit_success", statuses=("dep_success",)),
        WalletRule("withdrawal_approved", statuses=("wd_success",)),
        WalletRule("withdrawal_pending", statuses=("wd_pending",)),
    ),
    "any": (
        WalletRule("deposit_event", prefix="deposit"),
        WalletRule("withdrawal_event", prefix="withdraw"),
    ),
}


def emit(df: DataFrame, *messages: tuple[Column, Column | str]) -> DataFrame:
    """One row per (condition, selector) that holds: a narrow step, no shuffle."""
    picked = F.array_compact(F.array(*[F.when(c, s if isinstance(s, Column) else F.lit(s)) for c, s in messages]))
    return df.withColumn("selector", F.explode(picked))


def wallet_status_events(df: DataFrame, family: str, kind: str = "transaction_type", status: str = "transaction_status") -> DataFrame:
    rules = WALLET_FAMILIES[family]
    rows = df if family != "exact_failed_four" else df.filter(F.col("dt").isNotNull())
    return emit(rows, *[(r.condition(F.col(kind), F.col(status)), r.selector) for r in rules])


def trigger_purchases(df: DataFrame, kind: str = "transaction_type", status: str = "transaction_status") -> DataFrame:
    """A successful purchase of a listed type sends its own type as selector."""
    hit = F.lower(kind).isin(list(TRIGGER_PURCHASES)) & (F.lower(status) == "successful")
    return emit(df, (hit, F.col(kind)))


def big_win(df: DataFrame, amount: str, limit: float = 1000, strict: bool = False, won: Column | None = None, settled: Column | None = None) -> DataFrame:
    """Large win; ``won`` and ``settled`` narrow it where the feed carries them."""
    met = F.col(amount) > limit if strict else F.col(amount) >= limit
    for condition in (won, settled):
        if condition is not None:
            met = met & condition
    return emit(df, (met, "big_win"))


def withdrawal_requests(df: DataFrame) -> DataFrame:
    status = F.lower("transaction_status")
    withdraw = F.lower("transaction_type").startswith("withdraw") & F.col("amount").isNotNull()
    return emit(df, (withdraw & (status == "pending"), "withdrawal_request"), (withdraw & status.startswith("cancel"), "withdrawal_cancel"))


def first_deposit_completed(df: DataFrame) -> DataFrame:
    hit = (F.col("lifetime_count").cast("string") == "1") & (F.col("transaction_status") == "complete")
    return emit(df, (hit, "first_deposit_completed"))


def bonus_released(df: DataFrame, kind: str) -> DataFrame:
    return emit(df, (F.col(kind).isin("deposit", "manual"), "bonus_released"))


# Fixed value: the length of a block without an end.
FAR_END_DAYS = 20 * 365


def exclusion_notices(df: DataFrame) -> DataFrame:
    """Self-exclusion (2, 3) and timeout (1) notices; a blank end is the start plus 20 x 365 days."""
    start, end = F.col("blocked_start"), blank_to_null(F.col("blocked_end"))
    text = F.trim(start)
    far = F.when(
        F.length(text) == 19, F.date_format(F.date_add(F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")).cast("date"), FAR_END_DAYS), "yyyy-MM-dd")
    ).otherwise(date10(start))
    rows = df.filter(start.isNotNull()).select(
        "*", date10(start).alias("start_date"), F.coalesce(date10(end), far).alias("end_date")
    )
    status = F.col("player_status")
    return emit(rows, (status.isin("2", "3"), "self_exclusion_communication"), (status == "1", "timeout_communication"))


# End dates that stand for blocked and for not blocked.
BLOCKED_UNTIL = {True: "2040-01-01", False: "2020-01-01"}


def status_to_block(df: DataFrame, status: Column) -> DataFrame:
    """Status 1 unblocks, 2 to 5 block; others send nothing."""
    blocked = F.when(status == "1", "false").when(status.isin("2", "3", "4", "5"), "true")
    return df.withColumn("blocked", blocked).filter(F.col("blocked").isNotNull())


def block_by_end_date(df: DataFrame, end: Column) -> DataFrame:
    """An end date means self-exclusion until then, none means a plain block."""
    until = date10(blank_to_null(end))
    return df.withColumn("blocked_until", until).withColumn(
        "selector", F.when(until.isNotNull(), "self_exclusion").otherwise("player_blocked")
    )


def block_by_flag(df: DataFrame, flag: str, keys=("brand_id", "player_id")) -> DataFrame:
    """A boolean that changes sets a far-future or past end date; a blank one sends nothing."""
    rows = running(df, keys, ("ts", "seq"), before={"prior_flag": Last(F.struct(F.col(flag).alias("v")))})
    changed = ~F.col("prior_flag.v").eqNullSafe(F.col(flag))
    until = F.when(F.lower(flag) == "true", BLOCKED_UNTIL[True]).otherwise(BLOCKED_UNTIL[False])
    return rows.filter(changed & blank_to_null(F.col(flag)).isNotNull()).withColumn("blocked_until", until)


def classify_status(status: Column, self_excluded: Column, play_break: Column) -> Column:
    """Ordered status class."""
    return (
        F.when(status == "1", "1")
        .when(to_bool(self_excluded), "self-exclusion")
        .when((status == "2") & to_bool(play_break), "2-playbreak")
        .when(status.isin("2", "3", "4", "5"), "blocked")
    )


def login_events(df: DataFrame, max_age_days: int | None = None, only_successful: bool = False) -> DataFrame:
    rows = df
    if max_age_days is not None:
        rows = rows.filter(newer_than(parse_prefix19(F.col("login_datetime")), F.col("ts"), max_age_days * 86400))
    if only_successful:
        rows = rows.filter(to_bool(F.col("login_success"), ignore_case=True))
    return rows.withColumn("login_date", date10(F.col("login_datetime"))).withColumn("selector", F.lit("player_login"))


def activity_gate(df: DataFrame, text_time: str, days: int = 30) -> DataFrame:
    """Ignore events whose own time is older than ``days`` days at arrival."""
    return df.filter(newer_than(parse_prefix19(F.col(text_time)), F.col("ts"), days * 86400))


# Activity names and the selector and message type each sends.
ACTIVITIES = {
    "Customer Created": ("GENERIC_USER", "CUSTOMER_CREATED"),
    "Customer Updated": ("GENERIC_USER", "CUSTOMER_UPDATED"),
    "Customer Verified": ("GENERIC_USER", "CUSTOMER_VERIFIED"),
    "Customer Tag": ("GENERIC_USER", "CUSTOMER_TAG"),
    "Customer Session": ("GENERIC_USER", "CUSTOMER_SESSION"),
    "Customer Blocks": ("USER_BLOCKED_TOGGLE", "CUSTOMER_BLOCKS"),
    "Customer Fpp": ("GENERIC_USER", "CUSTOMER_FPP"),
    "Customer Consent": ("USER_CONSENT_UPDATE", "CUSTOMER_CONSENT"),
    "Customer Balance": ("STATE_ONLY", "CUSTOMER_BALANCE"),
}


# Columns of the record each activity sends.
_ACCOUNT = (
    "lastName", "country", "acquisition_source_code", "city", "mobileNumber", "sex", "dateOfBirth", "signup_language",
    "zipcode", "firstName", "emailAddress", "account_creation_date", "phone", "customer_currency_code", "username",
)
ACTIVITY_COLUMNS = {
    "Customer Created": (*_ACCOUNT, "player_roles"),
    "Customer Updated": (*_ACCOUNT, "player_roles"),
    "Customer Verified": (*_ACCOUNT, "account_verification_date", "reference", "click_id", "player_roles"),
    "Customer Tag": ("player_tags", "is_abuser"),
    "Customer Session": ("last_login_date", "last_deposit_date"),
    "Customer Blocks": ("is_blocked", "last_login_date", "is_self_excluded", "last_deposit_date"),
    "Customer Fpp": ("FPP_CUSTOMER_LEVEL", "FPP_REWARD_LEVEL_ID", "FPP_UPDATE_DATETIME"),
    "Customer Consent": (
        "consent_marketingemail", "consent_marketingtextmessage", "consent_marketingdirectmail",
        "consent_marketingtelephone", "consent_marketingoms",
    ),
    "Customer Balance": ("locked_money_balance", "wallet_balance_total_money", "bonus_money_balance", "real_money_balance"),
}


def activity_dispatch(df: DataFrame, activity: str) -> DataFrame:
    """Message type, selector and record by activity name; unknown names send nothing.

    A record holds the player, the brand and those of the activity's columns
    that ``df`` has; names that end in ``_date`` keep ten characters. ``blocked``
    is set for block activities only.
    """
    kind = F.create_map(*[F.lit(x) for name, (t, _) in ACTIVITIES.items() for x in (name, t)])
    selector = F.create_map(*[F.lit(x) for name, (_, s) in ACTIVITIES.items() for x in (name, s)])

    def record(columns):
        value = lambda c: date10(F.col(c)) if c.endswith("_date") else F.col(c).cast("string")
        ids = [F.col("player_id").cast("string").alias("original_id"), F.col("brand_id").cast("string").alias("brand_id")]
        return F.to_json(F.struct(*ids, *[value(c).alias(c) for c in columns if c in df.columns]))

    properties = None
    for name, columns in ACTIVITY_COLUMNS.items():
        met = F.col(activity) == name
        properties = F.when(met, record(columns)) if properties is None else properties.when(met, record(columns))
    rows = df.withColumn("msg_type", kind[F.col(activity)]).withColumn("selector", selector[F.col(activity)])
    if "is_blocked" in df.columns:
        blocked = F.coalesce(F.lower("is_blocked") == "true", F.lit(False)).cast("string")
        rows = rows.withColumn("blocked", F.when(F.col(activity) == "Customer Blocks", blocked))
    return rows.filter(F.col("selector").isNotNull()).withColumn("properties", properties)


def sport_push(df: DataFrame, kind: str) -> DataFrame:
    return df.withColumn("selector", F.concat(F.lit("sportsPush_"), F.col(kind)))


# Action, required action value ("" for any present value), selector.
ACTION_TRIGGERS = (
    ("withdrawal", "SUCCESS", "player_action_triggers_withdrawal_success"),
    ("withdrawal", "IN_PROGRESS", "player_action_triggers_withdrawal_in_progress"),
    ("email_verification", "", "player_action_triggers_email_verification"),
    ("deposit", "SUCCESS", "player_action_triggers_deposit"),
    ("self_exclusion", "TRUE", "player_action_triggers_self_exclusion"),
    ("panic_button", "TRUE", "player_action_triggers_panic_button"),
    ("forgot_password", "", "player_action_triggers_forgot_password"),
)
RESEND_TRIGGERS = (
    ("reg_resend", None, "player_action_triggers_resend_email_verification"),
    ("reset_password", None, "player_action_triggers_reset_password"),
)


def action_triggers(df: DataFrame, action: str, value: str, rules=ACTION_TRIGGERS, needs_time: Sequence[str] = ("deposit",), time: str = "ts") -> DataFrame:
    """Action and value pairs; some actions also need their own time."""
    messages = []
    for name, wanted, selector in rules:
        met = F.col(action) == name
        if wanted == "":
            met = met & F.col(value).isNotNull()
        elif wanted is not None:
            met = met & (F.col(value) == wanted)
        if name in needs_time:
            met = met & F.col(time).isNotNull()
        messages.append((met, selector))
    return emit(df, *messages)


def purge_events(df: DataFrame, status: str, word: str = "purge") -> DataFrame:
    return emit(df, (F.lower(status) == word, "player_purge"))


def ingest_lag(df: DataFrame, processed: Column, source: Column, limit: int = 30) -> DataFrame:
    """Rows processed at least ``limit`` whole seconds after their source time."""
    lag = F.unix_seconds(processed.cast("timestamp")) - F.unix_seconds(source.cast("timestamp"))
    return df.withColumn("lag_seconds", lag).filter(F.col("lag_seconds") >= limit)


# Fixed value: the parameter that names the player.
JOURNEY_ID = "notification_PLAYER_ID"


def journey_events(df: DataFrame, raw: str) -> DataFrame:
    """Journey messages whose parameters are a JSON object or the same object as JSON text.

    Blank text sends nothing, a missing player id gives ``unknown``.
    """
    direct = F.get_json_object(raw, "$.parameters")
    params = F.when(F.trim(direct) != "", direct)
    player = F.get_json_object(params, f"$.{JOURNEY_ID}")
    selector = F.get_json_object(raw, "$.mappingSelector")
    return (
        df.withColumn("properties", params)
        .withColumn("contact_id", F.coalesce(player, F.lit("unknown")))
        .withColumn("selector", F.when(player.isNull(), F.concat(F.lit("unknown"), selector)).otherwise(selector))
        .filter(F.col("properties").isNotNull())
    )
