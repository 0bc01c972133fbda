"""Run queries against DuckDB: ``python tests/check.py [--hot N] [sf_dir] [name ...]``.

``--hot N`` lowers the hot-key limit, so that the block-wise path is taken.
"""

from __future__ import annotations

import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
from playerflow.session import local_session  # noqa: E402
from tests.compare import connect, difference, duck_rows, spark_rows  # noqa: E402


def main(argv):
    hot = argv[1] if argv[:1] == ["--hot"] else None
    argv = argv[2:] if hot else argv
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session()
    if hot:
        spark.conf.set("spark.playerflow.hotKeyRows", hot)
    con = connect(sf_dir)
    queries, oracles = contract.queries(), contract.oracle_sql()
    names = argv[1:] or list(queries)
    failed = 0
    for name in names:
        start = time.time()
        try:
            left = spark_rows(queries[name](spark, sf_dir))
            took = time.time() - start
            if name not in oracles:
                print(f"rows  {name} {len(left[1])} {took:.1f}s", flush=True)
                continue
            problem = difference(left, duck_rows(con, oracles[name]))
        except Exception as error:  # report and go on with the next query
            problem, took = f"{type(error).__name__}: {str(error)[:1500]}", time.time() - start
        failed += problem is not None
        print(f"{'FAIL ' if problem else 'ok   '} {name} {len(left[1]) if not problem else ''} {took:.1f}s {problem or ''}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
