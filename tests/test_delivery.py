"""Delivery that fails, hangs or is cut off; changelogs with removals; scans in parts."""

import asyncio
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQueryException

import __spark_entry__ as contract
from playerflow.plans import streams as ST
from playerflow.session import run_dir
from playerflow.sources import delivery as D
from playerflow.sources import outbox as O
from playerflow.sources import tables as T
from playerflow.streaming import jobs
from playerflow.streaming.state import BatchOutput
from tests.compare import difference, duck_rows, spark_rows


def _partner():
    """By number: 0 answers, 1 answers late but in time, 2 fails, 3 hangs, 4 answers the second time."""
    tried, flying = set(), [0]

    async def send(row):
        flying[0] += 1
        try:
            assert flying[0] <= 10
            kind = row["seq"] % 5
            if kind == 1:
                await asyncio.sleep(0.02)
            elif kind == 2:
                raise ConnectionError
            elif kind == 3:
                await asyncio.sleep(3600)
            elif kind == 4 and row["seq"] not in tried:
                tried.add(row["seq"])
                raise OSError
        finally:
            flying[0] -= 1

    return send


def test_every_message_ends_delivered_or_dead(spark):
    messages = spark.range(200).select(F.col("id").alias("seq"), F.concat(F.lit("m"), "id").alias("dedup_id")).repartition(2)
    outcome = D.deliver_each(messages, _partner, in_flight=10, timeout_s=2.0, attempts=2, pause_s=0.001)
    rows = outcome.collect()
    assert len({r["dedup_id"] for r in rows}) == len(rows) == 200
    told = {int(r["dedup_id"][1:]): (r["delivered"], r["attempts"], r["error"]) for r in rows}
    want = [(True, 1, None), (True, 1, None), (False, 2, "ConnectionError"), (False, 2, "TimeoutError"), (True, 2, "OSError")]
    assert told == {i: want[i % 5] for i in range(200)}
    assert sorted(r["seq"] for r in D.dead_letters(messages, outcome).collect()) == [i for i in range(200) if i % 5 in (2, 3)]
    assert D.deliver_each(messages.limit(0), _partner).count() == 0


def test_stopped_between_write_and_commit(spark, sf_dir):
    """A batch that was written and not committed is run again, and nothing goes out twice."""
    base = run_dir(spark, "cut-off")
    logins = ST.event_stream(spark, sf_dir).filter(F.col("topic") == "logins").withColumn("selector", F.lit("player_login"))
    messages = O.outbox(logins.drop("channel"), ("dt",))
    output = BatchOutput(spark, f"{base}/sent")
    deliver = jobs.deliver(BatchOutput(spark, f"{base}/ledger"), output)

    def cut_off(batch, batch_id):
        deliver(batch, batch_id)
        raise RuntimeError("cut off")

    with pytest.raises(StreamingQueryException):
        jobs.finish(jobs.run(messages, cut_off, f"{base}/checkpoint"))
    jobs.finish(jobs.run(messages, deliver, f"{base}/checkpoint"))
    sent = output.read(messages.schema).select("seq", "dedup_id")
    assert difference(spark_rows(sent), spark_rows(contract.queries()["outbox_sink"](spark, sf_dir))) is None


@pytest.mark.parametrize("name", ["changelog_deletes", "changelog_feed"])
def test_changelog_over_several_batches(spark, sf_dir, duck, tmp_path, name):
    """Inserts, updates, removals and new inserts of a player spread over four batches."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.repartition(4, F.xxhash64("event_id")).write.parquet(f"{tmp_path}/events.parquet")
    got = getattr(ST, name)(spark, str(tmp_path), files_per_trigger=1, delay="4000 days")
    rows = spark_rows(got)
    assert difference(rows, duck_rows(duck, contract.oracle_sql()[name])) is None
    if name == "changelog_feed":
        assert {r["op"] for r in got.collect()} == {"insert", "update", "delete"}


def test_parts_meet_each_row_once(spark):
    """A third of the rows have one key, others none."""
    keys = spark.range(9_000).select(F.when(F.col("id") % 3 == 0, 500).when(F.col("id") % 100 != 1, F.col("id")).alias("k"))
    predicates = T.split_predicates("k", T.split_points(keys, "k", 9))
    counts = [keys.filter(p).count() for p in predicates]
    assert sum(counts) == 9_000 and "k IS NULL" in predicates and "k = 500" in predicates
    assert max(n for n, p in zip(counts, predicates) if p != "k = 500") <= 1_500
    hits = sum((F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates), F.lit(0))
    assert keys.filter(hits != 1).count() == 0


def test_literals_and_empty_tables(spark):
    assert T.split_predicates("d", [dt.date(2024, 1, 2)]) == ["d < DATE '2024-01-02'", "d >= DATE '2024-01-02'", "d IS NULL"]
    assert T.split_predicates("t", [dt.datetime(2024, 1, 2, 3, 4, 5)])[0] == "t < TIMESTAMP '2024-01-02 03:04:05'"
    assert T.split_predicates("m", [Decimal("1.50")])[0] == "m < 1.50"
    none = spark.createDataFrame([], "k bigint")
    assert T.split_predicates("k", T.split_points(none, "k", 4)) == ["k IS NOT NULL", "k IS NULL"]


def test_reader_gets_the_parts(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(DataFrameReader, "jdbc", lambda self, *a, **k: seen.update(k, args=a))
    T.read_jdbc_query(spark, "jdbc:none", "SELECT 1", ["k < 1", "k >= 1", "k IS NULL"], fetchsize="1000")
    assert seen == {"args": ("jdbc:none", "(SELECT 1) part"), "predicates": ["k < 1", "k >= 1", "k IS NULL"], "properties": {"fetchsize": "1000"}}
