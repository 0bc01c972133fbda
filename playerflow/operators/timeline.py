"""Running values over a key's ordered history, safe for hot keys.

Keyed state ("read state, merge event, compare, maybe emit") is a running
value over the rows of one key in arrival order.  A plain
``Window.partitionBy(key)`` computes it, but puts every row of a key into one
task.  Here a key that holds too many rows is cut into consecutive time
blocks:

1. row count and order range per key, in a job of its own (partial sums before
   the shuffle), from which only the keys above the limit come back;
2. such a key gets ``ceil(rows / limit)`` blocks of equal time span, every other
   key keeps a single block; a block that still holds far too many rows (a burst,
   or rows of one time, which are cut along the tie-breaker) is cut again;
3. one summary row per (hot key, block), again partially aggregated, and a
   window over those few rows gives what each block inherits;
4. the row window runs per (key, block) and falls back to the inherited value.

Where no key is hot, which is the usual case, steps 2 to 4 reduce to the plain
window with its single shuffle and sort.

The hot list has at most ``rows / limit`` keys. It is a written table, so that
every use of it agrees, and is broadcast only after a check of its size.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playerflow.session import written

# Hot keys in a broadcast; a longer list is joined by shuffling.
BROADCAST_KEYS = 1_000_000
HOT_ROWS_CONF = "spark.playerflow.hotKeyRows"
HOT_ROWS_DEFAULT = 2_000_000

DETECT = "detect"

# Equal spans never fill equally; only a block this many times too full is cut again.
_OVERFULL = 4

_PREFIX = "__carry_"


@dataclass(frozen=True)
class Last:
    """Latest non-null value of ``expr``. Wrap it in a struct to keep nulls."""

    expr: Column

    def over(self, window):
        return F.last(self.expr, ignorenulls=True).over(window)

    def summary(self, order: Column) -> Column:
        return F.max_by(self.expr, F.when(self.expr.isNotNull(), order))

    def carried(self, name: str, window):
        return F.last(F.col(name), ignorenulls=True).over(window)

    def combine(self, local: Column, inherited: Column) -> Column:
        return F.coalesce(local, inherited)

    def default(self, value: Column) -> Column:
        return value


@dataclass(frozen=True)
class Total:
    """Running sum. Use integers or decimals, so that the split is exact."""

    expr: Column

    def over(self, window):
        return F.sum(self.expr).over(window)

    def summary(self, order: Column) -> Column:
        return F.sum(self.expr)

    def carried(self, name: str, window):
        return F.sum(F.col(name)).over(window)

    def combine(self, local: Column, inherited: Column) -> Column:
        return F.coalesce(local + inherited, local, inherited)

    def default(self, value: Column) -> Column:
        return F.coalesce(value, F.lit(0))


def Count(condition: Column) -> Total:
    """Running number of rows that satisfy ``condition``."""
    return Total(F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("bigint"))


def hot_rows(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(HOT_ROWS_CONF, str(HOT_ROWS_DEFAULT)))


def _position(name: str, dtype: str) -> Column:
    """Order column as a double, used only to place rows into blocks; null for text."""
    if dtype.startswith("timestamp"):
        return F.unix_micros(F.col(name).cast("timestamp")).cast("double")
    if dtype == "date":
        return F.unix_date(name).cast("double")
    if dtype in ("tinyint", "smallint", "int", "bigint", "float", "double") or dtype.startswith("decimal"):
        return F.col(name).cast("double")
    return F.lit(None).cast("double")


def _positions(df: DataFrame, order: Sequence[str]) -> tuple[Column, Column]:
    """Positions of the leading order column and of the one that breaks its ties."""
    dtypes = dict(df.dtypes)
    breaker = order[min(1, len(order) - 1)]
    return _position(order[0], dtypes[order[0]]), _position(breaker, dtypes[breaker])


def hot_keys(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], limit: int | None = None, overfull: int = 1
) -> DataFrame | None:
    """Keys with too many rows for one task, with their order range and block count; None without any.

    Runs one job that reads the key and order columns only. Where it finds any
    key, the list is written once, so that every use of it agrees.
    """
    keys = list(keys)
    limit = limit or hot_rows(df)
    first, last = _positions(df, order)
    ranges = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"),
        F.min(first).alias("__lo"),
        F.max(first).alias("__hi"),
        F.min(last).alias("__seq_lo"),
        F.max(last).alias("__seq_hi"),
    )
    many = ranges.filter(F.col("__n") > limit * overfull).withColumn("__blocks", F.ceil(F.col("__n") / F.lit(limit)))
    if not many.take(1):
        return None
    found = written(many, "hot-keys")
    return F.broadcast(found) if found.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS else found


def _tag_blocks(df: DataFrame, keys, order, hot: DataFrame) -> tuple[DataFrame, list[str]]:
    """Rows with their nested block columns; rows of ordinary keys are in block 0 throughout."""
    first, last = _positions(df, order)
    along_time = (first - F.col("__lo")) / (F.col("__hi") - F.col("__lo"))
    along_seq = (last - F.col("__seq_lo")) / (F.col("__seq_hi") - F.col("__seq_lo"))
    span = F.when(F.col("__hi") > F.col("__lo"), along_time).when(F.col("__seq_hi") > F.col("__seq_lo"), along_seq)
    block = F.least(F.floor(span * F.col("__blocks")), F.col("__blocks") - 1)
    stats = ("__n", "__lo", "__hi", "__seq_lo", "__seq_hi", "__blocks")

    tagged, levels, is_hot = df, [], F.col("__n").isNotNull()
    while hot is not None:
        name = f"__block{len(levels)}"
        placed = tagged.join(hot, [*keys, *levels], "left")
        if not levels:
            placed = placed.withColumn("__is_hot", is_hot)
        tagged = placed.withColumn(name, F.coalesce(F.when(is_hot, block), F.lit(0)).cast("bigint")).drop(*stats)
        levels.append(name)
        hot = hot_keys(tagged.filter("__is_hot"), [*keys, *levels], order, hot_rows(df), _OVERFULL)
        if hot is not None:
            divisible = hot.filter((F.col("__hi") > F.col("__lo")) | (F.col("__seq_hi") > F.col("__seq_lo")))
            hot = divisible if divisible.take(1) else None
    return tagged, levels


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    after: dict | None = None,
    before: dict | None = None,
    hot: DataFrame | None | str = DETECT,
) -> DataFrame:
    """Add running values per key.

    ``after`` values include the current row (state after the event),
    ``before`` values end at the previous row (state before it). Rows with a
    null key are dropped, as every keyed job needs its key. Jobs that run
    several operators over the same rows may take :func:`hot_keys` once and pass it.
    """
    after, before = dict(after or {}), dict(before or {})
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    if isinstance(hot, str):
        hot = hot_keys(df, keys, order)
    if hot is None:
        return running_plain(df, keys, order, after, before)
    tagged, levels = _tag_blocks(df, keys, order, hot)
    rows = Window.partitionBy(*keys, *levels).orderBy(*order)
    upto = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prior = rows.rowsBetween(Window.unboundedPreceding, -1)

    specs = {**{n: (a, upto) for n, a in after.items()}, **{n: (a, prior) for n, a in before.items()}}
    local = tagged.select("*", *[agg.over(frame).alias(f"__local_{n}") for n, (agg, frame) in specs.items()])

    # Two names may ask for the same aggregate (state before and after a row).
    distinct: dict[int, str] = {}
    names = {n: distinct.setdefault(id(agg), n) for n, (agg, _) in specs.items()}
    aggs = {names[n]: agg for n, (agg, _) in specs.items()}

    summary = (
        tagged.filter("__is_hot")
        .groupBy(*keys, *levels)
        .agg(*[agg.summary(F.struct(*order)).alias(f"__sum_{n}") for n, agg in aggs.items()])
    )
    earlier = Window.partitionBy(*keys).orderBy(*levels).rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(
        *keys, *levels, *[agg.carried(f"__sum_{n}", earlier).alias(_PREFIX + n) for n, agg in aggs.items()]
    )
    merged = local.join(carry, [*keys, *levels], "left")
    values = {
        n: agg.default(agg.combine(F.col(f"__local_{n}"), F.col(_PREFIX + names[n])))
        for n, (agg, _) in specs.items()
    }
    kept = [F.col(c) for c in df.columns if c not in values]
    return merged.select(*kept, *[v.alias(n) for n, v in values.items()])


def running_plain(df: DataFrame, keys, order, after=None, before=None) -> DataFrame:
    """Single-window form, for inputs whose keys are all small."""
    after, before = dict(after or {}), dict(before or {})
    rows = Window.partitionBy(*keys).orderBy(*order)
    upto = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prior = rows.rowsBetween(Window.unboundedPreceding, -1)
    values = {n: a.default(a.over(upto)) for n, a in after.items()}
    values.update({n: a.default(a.over(prior)) for n, a in before.items()})
    kept = [F.col(c) for c in df.columns if c not in values]
    return df.select(*kept, *[v.alias(n) for n, v in values.items()])


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """First row per key as an aggregate, so it combines before the shuffle."""
    return _extreme(df, keys, order, columns, F.min)


def last_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Last row per key as an aggregate, so it combines before the shuffle."""
    return _extreme(df, keys, order, columns, F.max)


def _extreme(df, keys, order, columns, pick) -> DataFrame:
    names = [c for c in (columns or df.columns) if c not in keys]
    lead = [c for c in order]
    rest = [c for c in names if c not in lead]
    picked = pick(F.struct(*lead, *rest)).alias("__row")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col(f"__row.{c}").alias(c) for c in names])


def latest_values(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, Column]) -> DataFrame:
    """Final state per key: latest non-null value of each expression.

    The same result as the last row of :func:`running`, without any window.
    """
    at = F.struct(*order)
    return df.groupBy(*keys).agg(*[Last(expr).summary(at).alias(name) for name, expr in values.items()])
