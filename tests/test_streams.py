"""Streams over several micro-batches end where the batch operators do."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from playerflow.plans import streams as ST
from playerflow.streaming import jobs
from playerflow.streaming.state import BatchOutput, BatchState
from tests.compare import difference, spark_rows


@pytest.fixture(scope="module")
def split_dir(spark, sf_dir, tmp_path_factory):
    """Events in three files by time, wagers and sports bets in three by id."""
    base = tmp_path_factory.mktemp("split")
    import os
    import time

    for table, order, cuts in (
        ("events", "ts", ["2024-01-10", "2024-01-20"]), ("orders", "o_orderdate", ["1997-01-01", "1999-01-01"]), ("lineitem", "l_shipdate", ["1997-01-01", "1999-01-01"])
    ):
        df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
        cuts = [F.lit(c).cast("timestamp_ntz") for c in cuts]
        parts = [df.filter(F.col(order) < cuts[0]), df.filter((F.col(order) >= cuts[0]) & (F.col(order) < cuts[1])), df.filter(F.col(order) >= cuts[1])]
        for i, part in enumerate(parts):
            part.sort(order).coalesce(1).write.mode("append").parquet(f"{base}/{table}.parquet")
            # File age orders the micro-batches, so the three parts must not share a time.
            for name in os.listdir(f"{base}/{table}.parquet"):
                path = f"{base}/{table}.parquet/{name}"
                if name.startswith("part-") and os.path.getmtime(path) > time.time() - 3600:
                    os.utime(path, (1_600_000_000 + i * 100,) * 2)
    return str(base)


def _same(left, right):
    return difference(spark_rows(left), spark_rows(right)) is None


def test_profile_changes(spark, split_dir):
    profiles, messages = ST.stream_profile_changes(spark, split_dir, files_per_trigger=1)
    got, want = messages.collect(), contract.queries()["profile_changes"](spark, split_dir).collect()
    assert sorted(r["seq"] for r in got) == sorted(r["seq"] for r in want)
    times = {r["seq"]: r["ts"] for r in ST.T.events(spark, split_dir).collect()}
    assert all(r["event_ts"] == times[r["seq"]] for r in got)
    assert _same(profiles, _final_state(spark, split_dir))


def _final_state(spark, sf):
    from playerflow.operators import profiles as P
    from playerflow.operators.timeline import latest_values
    from playerflow.plans.profile import OUTWARD
    from playerflow.sources import tables as T

    return latest_values(T.events(spark, sf), P.KEY, P.ORDER, {c: F.col(c) for c in OUTWARD})


@pytest.mark.parametrize(
    "stream,batch",
    [
        (ST.keyed_process, "profile_changes"),
        (ST.stream_bet_accumulate_join, "bet_accumulate_join"),
        (ST.stream_hold_until_profile, "hold_until_profile"),
        (ST.stream_delta_snapshot, "stream_delta_snapshot"),
        (ST.stream_bet_join, "stream_bet_join"),
    ],
)
def test_three_batches_equal_one(spark, split_dir, stream, batch):
    got = stream(spark, split_dir, files_per_trigger=1)
    want = contract.queries()[batch](spark, split_dir).select(*got.columns)
    assert _same(got, want)


def test_web_push_stream_equals_batch(spark, split_dir):
    from playerflow.operators import lookups as K
    from playerflow.operators import webpush as W
    from playerflow.sources import tables as T

    rows = T.events(spark, split_dir, "wagering").withColumn("country", F.expr(ST.PLAYER_COUNTRY))
    want = W.web_push(rows, K.country_zones(spark))
    got = ST.stream_web_push(spark, split_dir, files_per_trigger=1)
    assert want.count() > 0 and _same(got, want)


def test_recheck_fires_what_a_replay_of_prefixes_fires(spark, split_dir):
    """A request fires in the first batch whose history satisfies it, and only once."""
    got = [tuple(r) for r in ST.recheck_all(spark, split_dir, files_per_trigger=1).collect()]
    assert len(got) == len(set(got))
    from playerflow.plans import rules as PR

    accepted, _ = PR.R.normalise(PR._requests(spark, split_dir))
    deposits = PR._deposits(spark, split_dir)
    cuts = ["2024-01-10", "2024-01-20", "2025-01-01"]
    want = set()
    for cut in cuts:
        seen = deposits.filter(F.col("ts") < F.lit(cut).cast("timestamp_ntz"))
        fired = PR.R.evaluate(accepted, seen).select("request_id", "player_id", "accept_uri")
        want |= {tuple(r) for r in fired.collect()}
    # Only players with a deposit in the batch are looked at, which is when a count can change.
    assert set(got) == want


def test_repeats_are_delivered_once(spark, tmp_path):
    """After a rerun of a batch, after very many batches, and for a message without a time."""
    schema = "dedup_id string, event_ts timestamp"
    frame = lambda *rows: spark.createDataFrame([(i, day and dt.datetime.fromisoformat(day)) for i, day in rows], schema)
    ledger, output = BatchOutput(spark, str(tmp_path / "ledger")), BatchOutput(spark, str(tmp_path / "sent"))
    step = jobs.deliver(ledger, output)
    a, b, c, d, none = ("a", "2024-01-01"), ("b", "2024-01-02"), ("c", "2024-01-02"), ("d", "2024-01-03"), ("n", None)
    step(frame(a, b, a), 0)
    step(frame(a, c, none), 1)
    step(frame(a, c, none), 1)
    step(frame(d), 2)
    step(frame(a, b, c, none), 5_000)
    assert sorted(r["dedup_id"] for r in output.read(schema).collect()) == ["a", "b", "c", "d", "n"]


def test_state_compaction_keeps_the_latest(spark, tmp_path):
    schema = spark.createDataFrame([(1, 1)], "k int, v int").schema
    state = BatchState(spark, str(tmp_path / "state"), ["k"], schema, compact_every=2)
    for batch in range(5):
        state.write(spark.createDataFrame([(1, batch), (10 + batch, batch)], schema), batch)
    got = {r["k"]: r["v"] for r in state.current().collect()}
    assert got == {1: 4, 10: 0, 11: 1, 12: 2, 13: 3, 14: 4}
    assert {r["k"]: r["v"] for r in state.before(2).collect()} == {1: 1, 10: 0, 11: 1}
