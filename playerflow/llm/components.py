"""Connected components of a link table, by alternating stars.

Each round first contracts the links inside every task with a union-find, then
hangs neighbours on the smallest member they know of (large star, small star).
Rounds are written to the shared folder, so lineage stays short and a lost
executor repeats one round at most. Only two sums reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playerflow.session import written

_LINK = "a long, b long"


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a task as stars around the smallest members; as many rows as members at most."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    rows = [(x, root(x)) for x in list(parent) if root(x) != x]
    for i in range(0, len(rows), 50_000):
        part = rows[i : i + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.int64()), pa.array([r[1] for r in part], pa.int64())], names=["a", "b"])


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
    return both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a != b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Links point from the larger to the smaller member."""
    low = links.groupBy("a").agg(F.min("b").alias("low"))
    joined = links.join(low, "a")
    return joined.select(F.col("b").alias("a"), F.col("low").alias("b")).unionAll(low.select("a", F.col("low").alias("b"))).where("a != b").distinct()


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """member, root (the smallest member reachable) for all members but the roots; links has long columns a and b."""
    ordered = links.select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b")).where("a != b")
    now, before = written(ordered.mapInArrow(_contract, _LINK), name), None
    while True:
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if seen["n"] == 0 or (seen["n"], seen["s"]) == before:
            return now.select(F.col("a").alias("member"), F.col("b").alias("root"))
        before = (seen["n"], seen["s"])
        now = written(_small_star(_large_star(now)), name)
