"""Running values are the same however a key is split into blocks."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from playerflow.operators.timeline import (
    HOT_ROWS_CONF, _OVERFULL, Count, Last, Total, _tag_blocks, first_rows, hot_keys, last_rows, latest_values, running, running_plain,
)

START = dt.datetime(2024, 1, 1)


def _rows(seed, times="spread", n=400):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # One key holds a third of all rows, the rest spread over twenty.
        key = 0 if rng.random() < 0.34 else rng.randrange(1, 21)
        ts = START + dt.timedelta(seconds=rng.randrange(0, 5000))
        if times == "same" or (times == "burst" and rng.random() < 0.9):
            ts = START
        elif times == "burst":
            ts = START + dt.timedelta(days=rng.randrange(0, 3000))
        rows.append((key, ts, i, rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "", "b"])))
    return rows


def _frame(spark, rows):
    return spark.createDataFrame(rows, "key int, ts timestamp, seq bigint, a int, b string")


def _specs():
    a, b, n = Last(F.col("a")), Last(F.struct(F.col("b").alias("v"))), Count(F.col("a") == 2)
    return {"la": a, "lb": b, "n": n, "s": Total(F.col("a").cast("bigint"))}, {"pa": a, "pb": b, "pn": n}


@pytest.fixture
def tiny_limit(spark):
    spark.conf.set(HOT_ROWS_CONF, "5")
    yield
    spark.conf.unset(HOT_ROWS_CONF)


@pytest.mark.parametrize("seed,times", [(1, "spread"), (2, "spread"), (3, "same"), (4, "burst")])
def test_split_equals_single_window(spark, tiny_limit, seed, times):
    df = _frame(spark, _rows(seed, times))
    after, before = _specs()
    columns = ["key", "seq", *after, *before]
    split = running(df, ["key"], ["ts", "seq"], after, before).select(*columns)
    plain = running_plain(df, ["key"], ["ts", "seq"], after, before).select(*columns)
    assert sorted(map(tuple, split.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_hot_key_is_split(spark, tiny_limit):
    df = _frame(spark, _rows(4))
    hot = {r["key"]: r["__blocks"] for r in hot_keys(df, ["key"], ["ts", "seq"]).collect()}
    assert hot[0] == -(-df.filter("key = 0").count() // 5)


def test_burst_is_cut_again(spark, tiny_limit):
    """Nine tenths of the hot key's rows share one time; no block may keep them all."""
    df = _frame(spark, _rows(4, "burst"))
    tagged, levels = _tag_blocks(df, ["key"], ["ts", "seq"], hot_keys(df, ["key"], ["ts", "seq"]))
    assert len(levels) > 1
    assert max(r["count"] for r in tagged.groupBy("key", *levels).count().collect()) <= 5 * _OVERFULL


def test_nothing_hot_by_default(spark):
    assert hot_keys(_frame(spark, _rows(5)), ["key"], ["ts", "seq"]) is None


def test_null_keys_are_dropped(spark):
    df = _frame(spark, [(None, START, 1, 1, "a"), (1, START, 2, 1, "a")])
    assert running(df, ["key"], ["ts", "seq"], {"x": Last(F.col("a"))}).count() == 1


def test_first_last_and_latest(spark):
    rows = _rows(6)
    df = _frame(spark, rows)
    first = {r["key"]: r["seq"] for r in first_rows(df, ["key"], ["ts", "seq"]).collect()}
    last = {r["key"]: r["seq"] for r in last_rows(df, ["key"], ["ts", "seq"]).collect()}
    state = {r["key"]: r["a"] for r in latest_values(df, ["key"], ["ts", "seq"], {"a": F.col("a")}).collect()}
    for key in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))
        assert first[key] == mine[0][2] and last[key] == mine[-1][2]
        assert state[key] == next((r[3] for r in reversed(mine) if r[3] is not None), None)


def test_hot_list_can_be_shared(spark, tiny_limit):
    df = _frame(spark, _rows(7))
    hot = hot_keys(df, ["key"], ["ts", "seq"])
    one = running(df, ["key"], ["ts", "seq"], {"x": Last(F.col("a"))}, hot=hot)
    two = running(df, ["key"], ["ts", "seq"], {"x": Last(F.col("a"))}, hot=None)
    pick = lambda rows: sorted((r["seq"], r["x"]) for r in rows.collect())
    assert pick(one) == pick(two)


def test_three_order_columns(spark, tiny_limit):
    """Rows of one time are cut along the second order column, never along a later one."""
    rng = random.Random(8)
    rows = [(1, START, rng.randrange(0, 40), i, rng.choice([None, 1, 2])) for i in range(200)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "key int, ts timestamp, rank int, seq bigint, a int")
    order = ["ts", "rank", "seq"]
    split = running(df, ["key"], order, {"x": Last(F.col("a"))}, {"p": Last(F.col("a"))})
    plain = running_plain(df, ["key"], order, {"x": Last(F.col("a"))}, {"p": Last(F.col("a"))})
    pick = lambda rows: sorted((r["seq"], r["x"], r["p"]) for r in rows.collect())
    assert pick(split) == pick(plain)


def test_text_order_column_is_allowed(spark, tiny_limit):
    df = _frame(spark, _rows(9, "same")).withColumn("name", F.col("seq").cast("string"))
    split = running(df, ["key"], ["ts", "name"], {"x": Last(F.col("a"))})
    plain = running_plain(df, ["key"], ["ts", "name"], {"x": Last(F.col("a"))})
    pick = lambda rows: sorted((r["seq"], r["x"]) for r in rows.collect())
    assert pick(split) == pick(plain)
