"""Compare a Spark result with the same query in DuckDB, order-insensitively."""

from __future__ import annotations

import datetime as dt
import decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value


def spark_rows(df):
    names = sorted(df.columns)
    return names, [tuple(_plain(r[n]) for n in names) for r in df.collect()]


def duck_rows(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], [tuple(_plain(r[i]) for i in order) for r in cursor.fetchall()]


def difference(left, right) -> str | None:
    """None when both sides hold the same rows, else a short description."""
    (left_names, left_rows), (right_names, right_rows) = left, right
    if left_names != right_names:
        return f"columns {left_names} != {right_names}"
    key = lambda row: tuple((v is None, type(v).__name__, str(v)) for v in row)
    a, b = sorted(left_rows, key=key), sorted(right_rows, key=key)
    if a == b and [tuple(map(type, r)) for r in a] == [tuple(map(type, r)) for r in b]:
        return None
    only_a = [r for r in a if r not in set(b)][:3]
    only_b = [r for r in b if r not in set(a)][:3]
    return f"{len(a)} rows vs {len(b)}; spark only {only_a}; sql only {only_b}; columns {left_names}"
