"""Rule checker against brute force, and its validation."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from playerflow.operators import rules as R

DAY = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
RULE = "array<struct<kind:string,symbol:string,times:int,amount:string,from_ts:timestamp,to_ts:timestamp,sports:array<string>>>"
REQUEST = f"request_id bigint, player_id bigint, accept_uri string, requested_at timestamp, ttl int, ttl_unit string, rules {RULE}"
COMPARE = {
    "more": lambda base, x: x > base, "less": lambda base, x: x < base, "equal": lambda base, x: x == base,
    "moreOrEqual": lambda base, x: x >= base, "lessOrEqual": lambda base, x: x <= base,
}


def _rule(symbol, times=None, amount=None, start=DAY, end=None, kind="deposit"):
    return (kind, symbol, times, None if amount is None else str(amount), start, end, [])


def _request(i, rules, player=1, uri="https://accept.test/x", ttl=10, unit="days"):
    return (i, player, uri, DAY, ttl, unit, rules)


def _requests(spark, rows):
    return spark.createDataFrame(rows, REQUEST)


def _deposits(spark, rows):
    return spark.createDataFrame(rows, "player_id bigint, second bigint, amount double, transaction_id bigint")


def _random_case(seed):
    rng = random.Random(seed)
    deposits = [
        (rng.choice([1, 1, 1, 2, 3]), int(DAY.timestamp()) + rng.randrange(0, 20 * 86400), rng.choice([float(rng.randrange(1, 12)), rng.randrange(1, 12) + rng.choice([0.01, 0.014, 0.005])]), i) for i in range(150)
    ]
    requests = []
    for i in range(60):
        rules = []
        for _ in range(rng.choice([1, 1, 2])):
            start = DAY + dt.timedelta(seconds=rng.randrange(0, 15 * 86400))
            end = start + dt.timedelta(seconds=rng.choice([0, 30, 4000, 90000, 10 * 86400]))
            times = rng.choice([None, None, 1, 2, 3])
            amount = rng.choice([None, 3, 6, 30]) if times else rng.choice([2, 5, 9, 5.01, 9.014])
            rules.append(_rule(rng.choice(list(COMPARE)), times, amount, start, end))
        requests.append(_request(i, rules, player=rng.choice([1, 2, 3])))
    return requests, deposits


def _brute(requests, deposits, legacy_less=False):
    compare = dict(COMPARE, less=COMPARE["more"]) if legacy_less else COMPARE
    fired = {}
    for rid, player, *_, rules in requests:
        met, paid = 0, []
        for kind, symbol, times, amount, start, end, _ in rules:
            inside = sorted(
                (s, t, a) for p, s, a, t in deposits if p == player and int(start.timestamp()) <= s <= int(end.timestamp())
            )
            if times is not None:
                ok = bool(inside) and compare[symbol](times, len(inside)) and (
                    amount is None or compare[symbol](float(amount), sum(a for *_, a in inside))
                )
            else:
                hits = [a for *_, a in inside if compare[symbol](float(amount), a)]
                ok = bool(hits)
                paid += hits[:1]
            met += ok
        if met == len(rules):
            fired[rid] = paid[0] if paid else None
    return fired


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("legacy_less", [False, True])
def test_evaluate_matches_brute_force(spark, seed, legacy_less):
    requests, deposits = _random_case(seed)
    accepted, rejected = R.normalise(_requests(spark, requests))
    assert rejected.count() == 0
    fired = R.evaluate(accepted, _deposits(spark, deposits), legacy_less)
    assert {r["request_id"]: r["amount"] for r in fired.collect()} == _brute(requests, deposits, legacy_less)


def test_amounts_close_to_each_other(spark):
    start = int(DAY.timestamp())
    deposits = [(1, start + i, a, i) for i, a in enumerate([36.005, 36.01, 36.014, 5.0])]
    rules = [_request(i, [_rule("equal", amount=a, end=DAY + dt.timedelta(days=3))]) for i, a in enumerate([36.01, 36.014, 36.005, 36.0, 5])]
    accepted, _ = R.normalise(_requests(spark, rules))
    fired = {r["request_id"]: r["amount"] for r in R.evaluate(accepted, _deposits(spark, deposits)).collect()}
    assert fired == {0: 36.01, 1: 36.014, 2: 36.005, 4: 5.0}


def test_one_player_with_many_rules_and_deposits(spark):
    rng = random.Random(4)
    start, count = int(DAY.timestamp()), 20_000
    deposits = [(1, start + rng.randrange(30 * 86400), rng.randrange(100, 90_000) / 100, i) for i in range(count)]
    rules = []
    for i in range(1_000):
        begin = DAY + dt.timedelta(seconds=rng.randrange(25 * 86400))
        amount = deposits[rng.randrange(count)][2] if i % 2 else rng.randrange(100, 90_000) / 100
        rules.append(_request(i, [_rule("equal", amount=amount, start=begin, end=begin + dt.timedelta(seconds=rng.randrange(5 * 86400)))]))
    accepted, _ = R.normalise(_requests(spark, rules))
    fired = {r["request_id"]: r["amount"] for r in R.evaluate(accepted, _deposits(spark, deposits)).collect()}
    assert fired == _brute(rules, deposits) and 50 < len(fired) < 1_000


@pytest.mark.parametrize("seconds", [0, 1, 59, 3600, 86399, 86400, 5 * 86400 + 4321])
def test_cover_is_exact_and_small(spark, seconds):
    start = DAY + dt.timedelta(seconds=12345)
    rules = spark.createDataFrame([(1, 0, start, start + dt.timedelta(seconds=seconds))], "request_id int, rule_no int, from_ts timestamp, to_ts timestamp")
    cells = [(r["bucket"], r["grain"]) for r in R.cover(rules).collect()]
    seen = sorted(x for b, g in cells for x in range(b, b + g))
    first = int(start.timestamp())
    assert seen == list(range(first, first + seconds + 1))
    assert len(cells) <= 31 + 2 * (23 + 59 + 59)


def test_validation(spark):
    late = DAY + dt.timedelta(days=40)
    rows = [
        _request(1, [_rule("more", amount=1)]),
        _request(2, [_rule("more", amount=1)], unit="fortnight"),
        _request(3, [_rule("more", amount=1)], uri="not a uri"),
        _request(4, [_rule("more", amount=1, start=late, end=DAY)]),
        _request(5, [_rule("more", amount=1, end=DAY + dt.timedelta(days=32))]),
        _request(6, [_rule("more", amount=1, end=DAY + dt.timedelta(days=30))]),
        _request(7, [_rule("more", amount=1, start=None, end=None)], ttl=2, unit="WEEKS"),
    ]
    accepted, rejected = R.normalise(_requests(spark, rows))
    assert {r["request_id"]: r["reason"] for r in rejected.collect()} == {2: "unit", 3: "uri", 4: "window", 5: "too_long"}
    kept = {r["request_id"]: r for r in accepted.collect()}
    assert set(kept) == {1, 6, 7}
    assert kept[7]["to_ts"] - kept[7]["from_ts"] == dt.timedelta(days=14)


def test_five_wallet_rows(spark):
    rows = [
        (1, "deposit-card", "Complete", "36.0", "2024-01-02T10:00:00+02:00", "a"),
        (1, "withdraw-card", "complete", "36.0", "2024-01-02 10:00:00", "b"),
        (1, "Deposit-card", "complete", "36.0", "2024-01-02T10:00:00.5Z", "c"),
        (1, "deposit-card", "complete", "36.0", "yesterday", "d"),
        (None, "deposit-card", "complete", "36.0", "2024-01-02 10:00:00", "e"),
    ]
    df = spark.createDataFrame(rows, "player_id bigint, transaction_type string, transaction_status string, amount string, dt string, transaction_id string")
    kept = {r["transaction_id"]: r["second"] for r in R.valid_deposits(df).collect()}
    base = int(dt.datetime(2024, 1, 2, 8, tzinfo=dt.timezone.utc).timestamp())
    assert kept == {"a": base, "c": base + 2 * 3600}


def test_wagered_kind_never_fires(spark):
    accepted, _ = R.normalise(_requests(spark, [_request(1, [_rule("more", amount=1, end=DAY + dt.timedelta(days=5), kind="wagered")])]))
    deposits = _deposits(spark, [(1, int(DAY.timestamp()) + 5, 100.0, 1)])
    assert R.evaluate(accepted, deposits).count() == 0


def test_expired(spark):
    rows = [_request(1, [], ttl=1, unit="hour"), _request(2, [], ttl=1, unit="year")]
    frame = _requests(spark, rows).unionByName(_requests(spark, [_request(3, [])]).withColumn("requested_at", F.lit(None).cast("timestamp")))
    gone = R.expired(frame, F.lit("2024-02-01").cast("timestamp"))
    assert {r["request_id"] for r in gone.collect()} == {1, 3}
    assert {r["request_id"] for r in R.retire(frame, gone).collect()} == {2}


def test_cover_has_no_overlaps(spark):
    """Windows inside one bucket of each grain, and across its borders, as whole seconds, each exactly once."""
    rng = random.Random(7)
    windows = []
    for length in (0, 1, 59, 60, 61, 3599, 3600, 3601, 86399, 86400, 86401, 200000):
        for start in (0, 1, 59, 60, 3599, 3600, 86399, rng.randrange(86400), rng.randrange(86400)):
            windows.append((start, start + length))
    at = lambda s: DAY + dt.timedelta(seconds=s)
    rules = spark.createDataFrame([(i, at(a), at(b)) for i, (a, b) in enumerate(windows)], "i int, from_ts timestamp, to_ts timestamp")
    found = {}
    for r in R.cover(rules).collect():
        found.setdefault(r["i"], []).append((r["bucket"] - int(DAY.timestamp()), r["grain"]))
    for i, (a, b) in enumerate(windows):
        end = a
        for bucket, grain in sorted(found[i]):
            assert bucket == end, (a, b)
            end += grain
        assert end == b + 1, (a, b)


def test_only_named_amounts_have_cells_of_their_own(spark):
    deposits = spark.createDataFrame([(1, 5, 10.0), (1, 5, 20.0), (1, 65, 10.0), (2, 5, 10.0)], "player_id bigint, second bigint, amount double")
    named = spark.createDataFrame([(1, "10.0"), (2, "99.0")], "player_id bigint, level string")
    rows = [(r["player_id"], r["grain"], r["level"], r["n"]) for r in R.rollups(deposits, R.PLAYER, named).collect()]
    assert {(g, n) for p, g, level, n in rows if level == "10.0"} == {(86400, 2), (3600, 2), (60, 1), (1, 1)}
    assert {p for p, _, level, _ in rows if level != R.ANY_LEVEL} == {1}
    assert sorted(n for p, g, level, n in rows if g == 86400 and level == R.ANY_LEVEL) == [1, 3]
    assert {r["level"] for r in R.rollups(deposits, R.PLAYER).collect()} == {R.ANY_LEVEL}


def test_rules_and_buckets_are_never_broadcast(spark):
    """A window becomes many buckets, which no size estimate tells: nothing of the rules goes through the driver."""
    requests, deposits = _random_case(3)
    asked, paid = _requests(spark, requests), _deposits(spark, deposits)
    accepted, _ = R.normalise(asked)
    fired = R.evaluate(accepted, paid)
    bets = paid.withColumn("sport_id", F.lit("1"))
    for made in (R.summarise(R.with_threshold(accepted), paid), fired, R.wagered(accepted, bets), R.retire(asked, fired)):
        assert "Broadcast" not in made._jdf.queryExecution().executedPlan().toString()


def test_days_without_deposits_are_not_covered(spark):
    """A month's window has buckets on the days with deposits only, and its parts of a day keep their ends."""
    rules = R.with_threshold(R.normalise(_requests(spark, [_request(1, [_rule("more", 1, start=DAY + dt.timedelta(hours=5), end=DAY + dt.timedelta(days=25))])]))[0])
    second = int(DAY.timestamp()) + 3 * 86400 + 70
    rolled = R.rollups(_deposits(spark, [(1, second, 5.0, 1), (1, second + 40, 6.0, 2), (1, int(DAY.timestamp()), 7.0, 3)]), R.PLAYER)
    days = R._on_days(rules, rolled, R.PLAYER).select("from_ts", "to_ts").collect()
    seconds = sorted((int(d["from_ts"].timestamp()) - int(DAY.timestamp()), int(d["to_ts"].timestamp()) - int(DAY.timestamp())) for d in days)
    assert seconds == [(5 * 3600, 86399), (3 * 86400, 4 * 86400 - 1)]
    assert [(r["n"], float(r["total"])) for r in R.window_totals(rules, rolled, R.PLAYER).collect()] == [(2, 11.0)]


def test_a_window_without_an_end_takes_the_rest_of_its_first_day(spark):
    start = int(DAY.timestamp())
    rolled = R.rollups(_deposits(spark, [(1, start + 100, 5.0, 1), (1, start + 9000, 6.0, 2), (1, start + 90_000, 7.0, 3)]), R.PLAYER)
    rules = spark.createDataFrame([(1, 0, 1, DAY + dt.timedelta(seconds=200), None)], "request_id bigint, rule_no int, player_id bigint, from_ts timestamp, to_ts timestamp")
    assert [r["n"] for r in R.window_totals(rules, rolled, R.PLAYER).collect()] == [1]
    assert R.cover(rules).join(rolled, [*R.PLAYER, "grain", "bucket"]).agg(F.sum("n")).first()[0] == 1
