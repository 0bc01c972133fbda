"""Golden event-to-message pairs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from playerflow.operators import lookups as K
from playerflow.operators import profiles as P
from playerflow.operators import triggers as G
from playerflow.sources import outbox as O
from playerflow.sources import topics as J

T0 = dt.datetime(2024, 1, 1)


def _events(spark, rows, columns):
    data = [(1, 1, T0 + dt.timedelta(minutes=i), i, *r) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, "brand_id bigint, player_id bigint, ts timestamp, seq bigint, " + ", ".join(f"{c} string" for c in columns))


def test_registration_then_update_with_merged_fields(spark):
    rows = _events(spark, [("a@x", None), (None, "fr"), ("a@x", None)], ["email", "language"])
    selectors = {r["seq"]: r["selector"] for r in P.registration_or_update(rows).collect()}
    assert selectors == {0: "player_registration", 1: "player_updated", 2: "player_updated"}
    changed = P.profile_changes(rows, {"email": F.col("email"), "language": F.col("language")}).orderBy("seq").collect()
    assert [(r["seq"], r["email"], r["language"]) for r in changed] == [(0, "a@x", None), (1, "a@x", "fr")]


def test_first_deposit_only_once(spark):
    rows = _events(spark, [(None,), ("2029-09-12Tddd",), ("2029-09-13",)], ["first_dep_datetime"])
    first = P.first_known(rows, "first_dep_datetime").collect()
    assert [(r["seq"], r["first_dep_datetime"]) for r in first] == [(1, "2029-09-12Tddd")]


def test_end_date_means_self_exclusion(spark):
    rows = _events(spark, [("2099-09-09R",), (" ",), (None,)], ["end"])
    got = [(r["selector"], r["blocked_until"]) for r in G.block_by_end_date(rows, F.col("end")).orderBy("seq").collect()]
    assert got == [("self_exclusion", "2099-09-09"), ("player_blocked", None), ("player_blocked", None)]


@pytest.mark.parametrize(
    "family,kind,status,expected",
    [
        ("prefix_failed", "withdraw_money", "failed", ["failed_withdrawal"]),
        ("prefix_failed", "deposit_money", "success", []),
        ("exact_failed_seven", "Deposit", "DECLINE", ["failed_deposit"]),
        ("exact_failed_four", "deposit", "decline", []),
        ("shop_failed_six", "LUCKY_EGG", "voided", ["failed_deposit"]),
        ("prefix_both", "deposit_x", "agentreject", ["failed_deposit"]),
        ("prefix_both", "withdraw_x", "Completed", ["success_withdrawal"]),
        ("prefix_approved", "withdrawal", "approved", ["WITHDRAWAL_APPROVED"]),
        ("prefix_approved", "withdrawal", "completed", []),
        ("not_accepted", "Deposit", "Accepted", []),
        ("not_accepted", "Deposit", None, ["failed_deposit"]),
        ("not_accepted", "deposit", "x", []),
        ("coded", None, "wd_pending", ["withdrawal_pending"]),
        ("any", "Withdraw-x", None, ["withdrawal_event"]),
    ],
)
def test_wallet_families(spark, family, kind, status, expected):
    rows = _events(spark, [(kind, status, "2024-01-01")], ["transaction_type", "transaction_status", "dt"])
    assert [r["selector"] for r in G.wallet_status_events(rows, family).collect()] == expected


def test_fixed_lists():
    assert len(G.SHOP_DEPOSITS) == len(set(G.SHOP_DEPOSITS)) == 38
    assert len(G.TRIGGER_PURCHASES) == len(set(G.TRIGGER_PURCHASES)) == 33
    assert len(P.CRYPTO_METHODS) == len(set(P.CRYPTO_METHODS)) == 14


def test_twenty_years_are_7300_days(spark):
    rows = _events(spark, [("2", "2024-01-01 10:00:00", None), ("1", "2024-01-01", " "), ("3", None, None)], ["player_status", "blocked_start", "blocked_end"])
    got = [(r["selector"], r["end_date"]) for r in G.exclusion_notices(rows).orderBy("seq").collect()]
    assert got == [("self_exclusion_communication", "2043-12-27"), ("timeout_communication", "2024-01-01")]


def test_journey(spark):
    raws = [
        '{"mappingSelector":"s","parameters":{"notification_PLAYER_ID":"7","country":"uK"}}',
        '{"mappingSelector":"s","parameters":"{\\"country\\":\\"fr\\"}"}',
        '{"mappingSelector":"s","parameters":""}',
    ]
    rows = _events(spark, [(r,) for r in raws], ["raw"])
    got = G.journey_events(rows, "raw").orderBy("seq").collect()
    assert [(r["contact_id"], r["selector"]) for r in got] == [("7", "s"), ("unknown", "unknowns")]
    route = K.route_by_jurisdiction(
        F.get_json_object("properties", "$.licenseuid"), F.get_json_object("properties", "$.country"), F.get_json_object("properties", "$.operator")
    )
    assert [r[0] for r in G.journey_events(rows, "raw").orderBy("seq").select(route).collect()] == ["UK", "DEFAULT"]


def test_mirror_key_and_quarantine(spark):
    rows = spark.createDataFrame([('{"brand_id":"brand123","player_id":"player456","x":"1"}',), ("{broken",)], "raw string")
    clean, bad = J.split_malformed(rows, "raw", J.text_schema("brand_id", "player_id"))
    assert [r["key"] for r in O.keyed_json(clean, ("brand_id", "player_id")).collect()] == ["brand123-player456"]
    assert [r["raw"] for r in bad.collect()] == ["{broken"]


def test_body_keeps_properties_and_drops_absent(spark):
    rows = _events(spark, [("a@x", None)], ["email", "language"]).withColumn("selector", F.lit("player_updated"))
    body = O.outbox(rows, ("email", "language")).select(O.body()).collect()[0][0]
    assert body == '{"type":"GENERIC_USER","contactId":"1","mappingSelector":"player_updated","properties":{"email":"a@x"}}'


def test_block_expiry_resets_the_status(spark):
    rows = _events(
        spark, [("3", "2024-01-01"), (None, None), (None, None), ("2", "2024-01-01"), (None, None), ("1", "2024-01-01"), ("5", None), (None, None)],
        ["player_status", "blocked_start"],
    )
    got = [(r["seq"], r["selector"]) for r in P.block_expiry(rows).orderBy("seq").collect()]
    assert got == [(1, "self_exclusion_expired"), (7, "timeout_expired")]


def test_iso_names_and_zones(spark):
    names = {r["code"]: r["country"] for r in K.iso_countries(spark).collect()}
    zones = {r["code"]: r["zone"] for r in K.country_zones(spark).collect()}
    assert names["JPN"] == names["JP"] == "Japan"
    assert zones["JPN"] == "Asia/Tokyo" and zones["GH"] == "Africa/Accra"
