"""Golden slot decisions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from playerflow.operators import lookups as K
from playerflow.operators import webpush as W

D = "2023-12-12 "
# event, balance, now, country, seeds, expected
CASES = [
    (None, None, D + "07:01:00", "JPN", {}, None),
    (D + "07:00:00", None, D + "07:01:00", "JPN", {}, None),
    (D + "07:00:00", 5.0, D + "07:01:00", "JPN", {}, None),
    (None, 5.0, D + "07:01:00", "JPN", {}, None),
    (D + "07:00:00", 4.99, D + "07:31:00", "JPN", {}, None),
    (D + "07:00:00", 4.99, D + "07:01:00", "JPN", {}, "WebPush_HappyHour"),
    (D + "07:01:00", 4.99, D + "07:01:00", "JPN", {"dailies": D + "06:01:00", "happy": D + "06:01:00"}, None),
    (D + "23:59:59", 3.33, D + "23:59:59", "GHA", {}, "WebPush_NightOwl"),
    (D + "23:59:59", 3.33, D + "23:59:59", "GHA", {"owl": "2023-12-11 23:59:59"}, "WebPush_Dailies"),
    (D + "07:00:00", 4.99, D + "07:01:00", "XXX", {}, None),
]


def _seconds(text):
    return None if text is None else int(dt.datetime.strptime(text, "%Y-%m-%d %H:%M:%S").replace(tzinfo=dt.timezone.utc).timestamp())


def test_golden(spark):
    rows = [
        (0, i, event, balance, now, country, *[_seconds(seeds.get(n)) for n in W.STATE])
        for i, (event, balance, now, country, seeds, _) in enumerate(CASES)
    ]
    schema = "brand_id bigint, player_id bigint, bet_datetime string, balance double, now string, country string, " + ", ".join(
        f"last_{n} bigint" for n in W.STATE
    )
    df = spark.createDataFrame(rows, schema).withColumn("ts", F.col("now").cast("timestamp"))
    sent = W.web_push(df, K.country_zones(spark), seed=True)
    got = {r["player_id"]: r["selector"] for r in sent.collect()}
    assert got == {i: c[-1] for i, c in enumerate(CASES) if c[-1]}


@pytest.mark.parametrize(
    "hours,fires", [(24, False), (24.5, False), (25, True)]
)
def test_cool_down_counts_whole_hours(hours, fires):
    last = {"dailies": 0}
    assert (W.choose(int(hours * 3600), 10 * 3600, last) is not None) is fires


def test_priority_and_half_open_slots():
    at = lambda h, m=0: h * 3600 + m * 60
    assert W.choose(0, at(23), {}) == "WebPush_NightOwl"
    assert W.choose(0, at(3, 59), {}) == "WebPush_NightOwl"
    assert W.choose(0, at(4), {}) == "WebPush_EarlyBird"
    assert W.choose(0, at(9), {}) == "WebPush_Dailies"
    assert W.choose(0, at(16), {}) == "WebPush_HappyHour"
    assert W.choose(0, at(18), {}) == "WebPush_Dailies"


def test_two_events_in_one_second(spark):
    """The second one falls through to the next slot, a third one sends nothing."""
    rows = [(0, 1, D + "23:30:00", 1.0, D + "23:30:00", "GHA")] * 4
    df = spark.createDataFrame(rows, "brand_id bigint, player_id bigint, bet_datetime string, balance double, now string, country string")
    sent = W.web_push(df.withColumn("ts", df["now"].cast("timestamp")), K.country_zones(spark))
    assert sorted(r["selector"] for r in sent.collect()) == ["WebPush_Dailies", "WebPush_NightOwl"]
