"""Column helpers."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from playerflow.functions import flags, ids, text, times


def _one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} string" for n in values))
    return row.select(column.alias("x")).collect()[0]["x"]


@pytest.mark.parametrize(
    "raw,expected",
    [
        ("2024-03-04T05:06:07.123", dt.datetime(2024, 3, 4, 5, 6, 7, 123000)),
        ("2024-03-04 05:06:07.12", dt.datetime(2024, 3, 4, 5, 6, 7, 120000)),
        ("2024-03-04T05:06:07.1", dt.datetime(2024, 3, 4, 5, 6, 7, 100000)),
        ("2024-03-04 05:06:07.123456Z", dt.datetime(2024, 3, 4, 5, 6, 7, 123456)),
        ("2024-03-04T05:06:07", dt.datetime(2024, 3, 4)),
        ("2024-03-04", dt.datetime(2024, 3, 4)),
        ("nonsense", None),
        (None, None),
    ],
)
def test_parse_by_length(spark, raw, expected):
    assert _one(spark, times.parse_by_length(F.col("v")), v=raw) == expected


@pytest.mark.parametrize(
    "raw,expected",
    [
        ("2024-03-04 05:06:07", dt.datetime(2024, 3, 4, 5, 6, 7)),
        ("2024-03-04T05:06:07.9+02:00", dt.datetime(2024, 3, 4, 3, 6, 7)),
        ("2024-03-04T05:06:07Z", dt.datetime(2024, 3, 4, 5, 6, 7)),
        ("2024-03-04T05:06:07", None),
        ("2024-03-04", None),
        ("x", None),
    ],
)
def test_parse_whole_second(spark, raw, expected):
    assert _one(spark, times.parse_whole_second(F.col("v")), v=raw) == expected


def test_parse_day_first(spark):
    assert _one(spark, times.parse_day_first(F.col("v")), v="31/12/1999") == "1999-12-31"


@pytest.mark.parametrize("raw,expected", [("true", True), ("1", True), ("TRUE", False), ("yes", False), ("0", False), (None, False)])
def test_to_bool(spark, raw, expected):
    assert _one(spark, flags.to_bool(F.col("v")), v=raw) is expected


def test_wide_words(spark):
    assert _one(spark, flags.to_bool(F.col("v"), flags.TRUE_WORDS_WIDE, ignore_case=True), v="YES") is True


@pytest.mark.parametrize("raw,expected", [("2029-09-12Tddd", "2029-09-12"), ("2099-09-09R", "2099-09-09"), ("short", "short"), (None, None)])
def test_date10(spark, raw, expected):
    assert _one(spark, text.date10(F.col("v")), v=raw) == expected


@pytest.mark.parametrize("name", ["player#bet", "", "x" * 50])
def test_name_uuid(spark, name):
    import hashlib

    expected = str(uuid.UUID(bytes=hashlib.md5(name.encode()).digest(), version=3))
    assert _one(spark, ids.name_uuid(F.col("v")), v=name) == expected


def test_selector_prefix(spark):
    column = text.prefixed_selector(F.col("v"), F.col("b"), ["7"])
    assert _one(spark, column, v="big_win", b="7") == "DEV_big_win"
    assert _one(spark, column, v="big_win", b="8") == "big_win"


def test_recency_reaches_the_scan(spark, sf_dir):
    """The earliest recent day is a constant that the scan filters by."""
    import contextlib
    import io

    from playerflow.operators import lifetime
    from playerflow.sources import tables

    for frame, column in ((tables.wallet(spark, sf_dir), "transaction_datetime"), (tables.bets(spark, sf_dir), "bet_datetime")):
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            lifetime.recent(frame, F.col(column), "2024-01-31", 30).explain("formatted")
        pushed = next(line for line in text.getvalue().splitlines() if "PushedFilters" in line)
        assert "GreaterThanOrEqual" in pushed, pushed
