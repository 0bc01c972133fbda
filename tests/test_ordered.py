"""Keyed processing in event-time order: any spread over micro-batches, late rows, timers, several topics."""

import datetime as dt
import json
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from playerflow.plans import streams as ST
from playerflow.session import run_dir
from playerflow.sources import tables as T
from playerflow.streaming import jobs, ordered
from playerflow.streaming.sources import union_watermarked
from playerflow.streaming.state import BatchOutput
from tests.compare import difference, spark_rows

US = 1_000_000
DAY = 86_400 * US


def _dated(path, at):
    for name in os.listdir(path):
        if name.startswith("part-") and os.path.getmtime(f"{path}/{name}") > 1_700_000_000:
            os.utime(f"{path}/{name}", (at, at))


@pytest.fixture(scope="module")
def shuffled_dir(spark, sf_dir, tmp_path_factory):
    """Events in four files, each with rows of all times."""
    base = tmp_path_factory.mktemp("shuffled")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    for i in range(4):
        part = events.filter(F.pmod(F.xxhash64("event_id"), F.lit(4)) == i)
        part.orderBy(F.xxhash64("ts")).coalesce(1).write.mode("append").parquet(f"{base}/events.parquet")
        _dated(f"{base}/events.parquet", 1_600_000_000 + 100 * i)
    return str(base)


@pytest.mark.parametrize("name", ["keyed_process", "stream_hold_until_profile", "state_retention", "ordering_late_data", "recheck_live"])
def test_four_shuffled_batches_equal_one(spark, sf_dir, shuffled_dir, name):
    """With a delay beyond the spread nothing is late, and the order of arrival does not show."""
    got = getattr(ST, name)(spark, shuffled_dir, files_per_trigger=1, delay="4000 days")
    want = contract.queries()[name](spark, sf_dir).select(*got.columns)
    assert want.count() > 0 and difference(spark_rows(got), spark_rows(want)) is None


def test_late_rows_are_told_and_not_merged(spark, shuffled_dir):
    """Without delay the rows behind the watermark come out late; the others are numbered without them."""
    rows = ST.ordering_late_data(spark, shuffled_dir, files_per_trigger=1).collect()
    late = {r["seq"] for r in rows if r["late"]}
    assert len(rows) == len({r["seq"] for r in rows}) == T.events(spark, shuffled_dir).count()
    assert 0 < len(late) < len(rows) and all(r["n"] is None for r in rows if r["late"])
    times = {r["seq"]: (r["ts"], r["seq"], r["brand_id"], r["player_id"]) for r in T.events(spark, shuffled_dir).collect()}
    players = {}
    for r in rows:
        if not r["late"]:
            players.setdefault(times[r["seq"]][2:], []).append((times[r["seq"]], r["n"], r["previous"]))
    for found in players.values():
        found.sort()
        assert [n for _, n, _ in found] == list(range(1, len(found) + 1))
        assert [p for _, _, p in found] == [None, *(t[1] for t, _, _ in found[:-1])]


def test_the_slowest_topic_decides_the_watermark(spark, tmp_path):
    """A topic that is ahead makes no row of a slow topic late."""
    def topic(name, batches):
        for i, rows in enumerate(batches):
            frame = spark.createDataFrame([(1, s, dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)) for s, h in rows], "player_id bigint, seq bigint, ts timestamp")
            frame.coalesce(1).write.mode("append").parquet(str(tmp_path / name))
            _dated(tmp_path / name, 1_600_000_000 + 100 * i)
        return spark.readStream.schema("player_id bigint, seq bigint, ts timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name))

    parts = {"fast": topic("fast", [[(1, 1), (2, 50)], [(3, 90)], [(4, 100)]]), "slow": topic("slow", [[(11, 2)], [(12, 20)], [(13, 60)]])}
    jobs.stream_session(spark)
    base = run_dir(spark, "two-topics")
    output = BatchOutput(spark, f"{base}/rows")
    close = spark.createDataFrame([(-1, -1, dt.datetime(2999, 1, 1))], "player_id bigint, seq bigint, ts timestamp")
    build = lambda end: ordered.in_order(union_watermarked({t: (p.unionByName(end), "0 seconds") for t, p in parts.items()}), ["player_id"], ordered.Dispatched(), "topic string, n bigint", ["topic"], delay=None)
    jobs.run_closed(build, close, f"{base}/close", output.write, f"{base}/checkpoint")
    rows = sorted(output.read("player_id bigint, us bigint, seq bigint, late boolean, topic string, n bigint").collect(), key=lambda r: r["us"])
    assert [(r["seq"], r["n"], r["late"]) for r in rows] == [(s, i + 1, False) for i, s in enumerate([1, 11, 12, 2, 13, 3, 4])]
    assert {r["topic"] for r in rows if r["seq"] > 10} == {"slow"}


@pytest.mark.parametrize("field", ["reg_us", "bet_us", "result_us"])
def test_retention_clears_on_each_condition(field):
    fold = ordered.BetRetention()
    state, out = fold.step(None, 0, 1, {field: 0})
    assert out == [] and fold.wake(state) == 2 * DAY + 1
    state, out = fold.step(state, DAY, 2, {"bet_us": DAY})
    assert out == [] and len(state["bets"]) == (2 if field == "bet_us" else 1)
    assert fold.tick(state, 2 * DAY) == (state, [])
    kept = len(state["bets"])
    state, out = fold.tick(state, 2 * DAY + 1)
    assert out == [{"kept": kept}] and state["bets"] == [] and fold.wake(state) is None
    state, out = fold.step(state, 3 * DAY, 3, {"bet_us": 3 * DAY})
    assert state["bets"] == [] and out == []


def _request(expires, *rules, expected=None):
    return {"request": {"accept_uri": "u", "expires_us": expires, "expected": expected or len(rules), "rules": list(rules)}}


def _deposit(second, amount):
    return {"deposit": {"second": second, "amount": amount, "cents": round(amount * 100)}}


def test_live_requests_fire_once_expire_and_leave_no_state():
    fold = ordered.LiveRequests(history_days=1)
    single = {"symbol": "more", "threshold": 10.0, "from_s": 0, "to_s": 1000}
    twice = {"symbol": "moreOrEqual", "times": 2, "threshold": 15.0, "from_s": 50, "to_s": 1000}
    few = {"symbol": "less", "times": 3, "from_s": 0, "to_s": 1000}
    state, out = fold.step(None, 10 * US, 1, _deposit(10, 12.0))
    assert out == []
    state, out = fold.step(state, 20 * US, 2, _request(500 * US, single))
    assert [(o["request_id"], o["expired"]) for o in out] == [(2, False)]  # the deposit came before the request
    state, out = fold.step(state, 30 * US, 3, _request(500 * US, single, twice))
    state, out2 = fold.step(state, 40 * US, 4, _request(45 * US, twice))
    state, out3 = fold.step(state, 41 * US, 5, _request(500 * US, few, expected=2))  # a rule of another kind
    assert out == out2 == out3 == [] and fold.wake(state) == 45 * US + 1
    state, out = fold.tick(state, 45 * US + 1)
    assert [(o["request_id"], o["expired"]) for o in out] == [(4, True)]
    state, out = fold.step(state, 60 * US, 6, _deposit(60, 5.0))
    assert out == []
    state, out = fold.step(state, 70 * US, 7, _deposit(70, 10.0))
    assert [(o["request_id"], o["expired"]) for o in out] == [(3, False)]
    state, out = fold.tick(state, 500 * US + 1)
    assert [(o["request_id"], o["expired"]) for o in out] == [(5, True)] and not state["requests"]
    moment = fold.wake(state)
    assert moment == (70 + 86_400 + 1) * US and fold.tick(state, moment) == (None, [])


def test_state_is_plain_data():
    """What a fold keeps goes through JSON unchanged."""
    for fold, row in ((ordered.Changes(["a"]), {"a": "é"}), (ordered.HoldUntilProfile(), {"is_profile": False}), (ordered.Numbered(), {}), (ordered.BetRetention(), {"bet_us": 5}), (ordered.LiveRequests(), _deposit(1, 2.5))):
        state, _ = fold.step(None, US, 1, row)
        assert json.loads(json.dumps(state)) == state


def test_a_failed_export_is_repeated_with_what_came_in_meanwhile(spark, tmp_path):
    """The mark moves with the writer's commit only; outside the hours and for a moment that is exported nothing happens."""
    at = lambda day, hour=5: dt.datetime(2024, 1, day, hour)
    rows = spark.createDataFrame([(i, at(i)) for i in range(1, 9)], "player_id bigint, ts timestamp_ntz")
    snapshot = lambda known: rows.filter(known).withColumn("updated_ts", F.col("ts"))
    export = jobs.ScheduledExport(spark, str(tmp_path / "out"))
    failing = lambda known: snapshot(known).withColumn("x", F.when(F.col("player_id") == 4, F.raise_error(F.lit("lost"))))
    assert export.mark() is None and not export.run(at(2, 3), snapshot) and not export.run(at(2, 12), snapshot)
    assert export.run(at(2), snapshot) and not export.run(at(2), snapshot)
    mark = export.mark()
    with pytest.raises(Exception, match="lost"):
        export.run(at(5), failing)
    assert export.mark() == mark
    assert export.run(at(6), snapshot)
    done = [os.path.dirname(p) for p in map(str, (tmp_path / "out").glob("until=*/_SUCCESS"))]
    got = sorted((p[-10:], r["player_id"]) for p in done for r in spark.read.json(p).collect())
    assert [i for _, i in got] == [1, 2, 3, 4, 5, 6] and len({p for p, _ in got}) == 2


def test_old_bets_are_forgotten():
    """A side that comes after the bound finds no partner; without a bound it does."""
    day = ordered.BothSides(["a", "b"]).step
    state, out = day(None, 0, 1, {"a": {"x": 1}})
    assert out == [] and day(state, 9 * DAY, 2, {"b": {"y": 2}})[1] == [{"a": {"x": 1}, "b": {"y": 2}}]
    bounded = ordered.BothSides(["a", "b"], days=2)
    assert bounded.wake(state) == 2 * DAY + 1 and bounded.tick(state, 2 * DAY + 1) == (None, [])
    assert ordered.BothSides(["a"]).wake({"us": 0}) is None
    watched = ordered.WatchedBets(days=2)
    state, placed = watched.step(None, 0, 0, {"sport": {"championship_id": "3"}, "is_wager": False})
    state, result = watched.step(state, DAY, 2, {"settlement": {"wager_at": "2024-01-02T00:00:00.000Z", "lost": True}, "is_wager": True})
    assert [m["kind"] for m in placed + result] == ["placed", "result"] and result[0]["bet_won_lost"] == "lost" and result[0]["result_date"] == "2024-01-02"
    assert watched.step(state, DAY, 3, {"settlement": {"wager_at": "2024-01-03T00:00:00.000Z", "lost": False}, "is_wager": True})[1] == []
    assert watched.wake(state) == 3 * DAY + 1 and watched.tick(state, 3 * DAY + 1) == (None, [])


class _Store:
    """List and value states and the timers of one bucket, which count their calls."""

    def __init__(self):
        self.calls, self.lists, self.values, self.timers, self.now = 0, {}, {}, set(), 0

    def _state(self, kind, name):
        store = self

        class Called:
            def __getattr__(self, method):
                def call(value=None):
                    store.calls += 1
                    held = store.lists.setdefault(name, []) if kind == "list" else None
                    if method == "get":
                        return iter(list(held)) if kind == "list" else store.values.get(name)
                    if method == "exists":
                        return name in store.values
                    if method == "clear":
                        store.lists.pop(name, None), store.values.pop(name, None)
                    elif method == "appendValue":
                        held.append(value)
                    elif method == "put":
                        held[:] = value
                    else:
                        store.values[name] = value
                return call

        return Called()

    def getListState(self, name, schema):
        return self._state("list", name)

    def getValueState(self, name, schema):
        return self._state("value", name)

    def registerTimer(self, ms):
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.timers.discard(ms)

    def getCurrentWatermarkInMs(self):
        return self.now


def _bucket(fold):
    store, bucket = _Store(), ordered.InOrder(fold, ["key", "us", "seq", "late", "out"])
    bucket.init(store)
    return store, bucket


def _frame(rows):
    return pd.DataFrame([(k, us, seq, json.dumps(row)) for k, us, seq, row in rows], columns=["key", "us", "seq", "row"])


def test_keys_share_the_calls_to_the_store():
    """Hundreds of keys take a handful of calls, and each is folded in its own order."""
    store, bucket = _bucket(ordered.Numbered())
    rows = [(f"k{i % 500}", (1000 - i) * US, i, {}) for i in range(1000)]
    assert sum(map(len, bucket.handleInputRows((0,), iter([_frame(rows[:700]), _frame(rows[700:])]), store))) == 0
    assert store.timers == {1001}
    store.now = 2_000_000
    told = pd.concat(bucket.handleExpiredTimer((0,), store, None))
    assert store.calls < 12 and len(told) == 1000 and len(store.lists["state"]) == 500 and "waiting" not in store.lists
    found = {(r.key, r.seq): json.loads(r.out) for r in told.itertuples()}
    assert all(found[f"k{i}", i] == {"n": 2, "previous": i + 500} and found[f"k{i}", i + 500] == {"n": 1, "previous": None} for i in range(500))


def test_a_bucket_wakes_for_its_earliest_key():
    """A key that is due does not touch another one's waiting rows or moment; late rows are told at once."""
    store, bucket = _bucket(ordered.BothSides(["a", "b"], days=1))
    list(bucket.handleInputRows((0,), iter([_frame([("x", 0, 1, {"a": 1}), ("y", 5 * DAY, 2, {"a": 2})])]), store))
    store.timers, store.now = set(), 1000
    list(bucket.handleExpiredTimer((0,), store, None))
    assert [name for name, *_ in store.lists["state"]] == ["x"] and store.timers == {DAY // 1000 + 1}
    late = pd.concat(bucket.handleInputRows((0,), iter([_frame([("x", 5, 3, {"b": 1}), ("x", 2 * DAY, 4, {"b": 1})])]), store))
    assert late[["key", "seq", "late"]].values.tolist() == [["x", 3, True]]
    store.timers, store.now = set(), 6 * DAY // 1000
    told = pd.concat(bucket.handleExpiredTimer((0,), store, None))
    assert len(told) == 0 and [(name, json.loads(state)["us"]) for name, state, _ in store.lists["state"]] == [("y", 5 * DAY)]
