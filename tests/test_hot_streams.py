"""One player with 40 000 rows in a micro-batch, in random order: streams equal the batch operators."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from playerflow.operators import lookups as K
from playerflow.operators import webpush as W
from playerflow.plans import streams as ST
from playerflow.sources import tables as T
from tests.compare import difference, spark_rows

ROWS = 40_000


def _write(spark, path, event_type, scale=1):
    events = spark.read.parquet("/root/testdata/sf0.1/events.parquet").filter(F.col("event_id") < ROWS)
    hot = events.withColumn("user_id", F.lit(1).cast("long")).withColumn("event_type", event_type).withColumn("value", F.col("value") * scale)
    hot.orderBy(F.xxhash64("event_id")).coalesce(1).write.parquet(f"{path}/events.parquet")
    return str(path)


@pytest.fixture(scope="module")
def hot_dir(spark, tmp_path_factory):
    """The first profile row lies in the middle."""
    early = (F.col("event_type") == "signup") & (F.col("event_id") < ROWS // 2)
    return _write(spark, tmp_path_factory.mktemp("hot"), F.when(early, "purchase").otherwise(F.col("event_type")))


@pytest.fixture(scope="module")
def wager_dir(spark, tmp_path_factory):
    """Wagers only, all with a low balance."""
    return _write(spark, tmp_path_factory.mktemp("wagers"), F.lit("click"), 0.01)


def _same(left, right):
    assert right.count() > 0
    assert difference(spark_rows(left), spark_rows(right.select(*left.columns))) is None


def test_keyed_process(spark, hot_dir):
    _same(ST.keyed_process(spark, hot_dir), contract.queries()["profile_changes"](spark, hot_dir))


def test_hold_until_profile(spark, hot_dir):
    _same(ST.stream_hold_until_profile(spark, hot_dir), contract.queries()["hold_until_profile"](spark, hot_dir))


def test_web_push(spark, wager_dir):
    rows = T.events(spark, wager_dir, "wagering").withColumn("country", F.expr(ST.PLAYER_COUNTRY))
    _same(ST.stream_web_push(spark, wager_dir), W.web_push(rows, K.country_zones(spark), "bet_datetime"))
