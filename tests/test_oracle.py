"""Every query with a SQL counterpart gives the same rows as DuckDB."""

import pytest

import __spark_entry__ as contract
from tests.compare import difference, duck_rows, spark_rows

ORACLES = contract.oracle_sql()


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(name, spark, sf_dir, duck):
    rows = spark_rows(contract.queries()[name](spark, sf_dir))
    if name in ORACLES:
        assert difference(rows, duck_rows(duck, ORACLES[name])) is None


def test_entry(spark):
    assert contract.entry(spark).columns == ["player_id", "last_deposit_date"]


def test_names_agree():
    assert set(ORACLES) <= set(contract.queries())
