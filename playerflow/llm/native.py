"""Column helpers: names for intermediate values, spans of matches, running sums."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Space and the control characters 9 to 13.
BLANK = r"\x20\x09-\x0D"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def blank_words(text: Column) -> Column:
    """The words between blanks."""
    return F.filter(F.split(text, f"[{BLANK}]+"), lambda w: w != "")


def _doubled(values: Column, step: int) -> Column:
    return let(values, lambda x: F.when(F.size(x) > step, F.transform(x, lambda v, i: F.when(i >= step, v + F.get(x, i - step)).otherwise(v))).otherwise(x))


def running_sum(values: Column, longest: int = 1 << 26) -> Column:
    """Each element plus all before it, by doubling steps: n log n for n elements, and only as many steps as n needs."""
    step = 1
    while step < longest:
        values, step = _doubled(values, step), step * 2
    return values


def match_spans(text: Column, pattern: str) -> Column:
    """All matches of a pattern, as array<struct<start, end, value>>; code points, end exclusive.

    Matches and the gaps between them alternate, so the sums of their lengths
    are the positions.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return let(hits, lambda h: F.when(F.size(h) > 0, _placed(h, F.split(text, pattern, -1))).otherwise(_placed_type()))


def _placed(hits: Column, gaps: Column) -> Column:
    ends = let(gaps, lambda g: running_sum(F.transform(hits, lambda v, i: F.length(F.get(g, i)) + F.length(v))))
    return let(ends, lambda e: F.transform(hits, lambda v, i: F.struct((F.get(e, i) - F.length(v)).alias("start"), F.get(e, i).alias("end"), v.alias("value"))))


def _placed_type() -> Column:
    return F.array().cast("array<struct<start:int,end:int,value:string>>")


def covered(positions: Column, width: int) -> Column:
    """How many places the spans [p, p + width) cover; positions sorted."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-width).cast("long").alias("last"))
    return F.aggregate(
        positions, start,
        lambda a, p: F.struct((a["n"] + F.least(F.lit(width).cast("long"), p.cast("long") - a["last"])).alias("n"), p.cast("long").alias("last")),
        lambda a: a["n"],
    )


def repeated_positions(keys: Column) -> Column:
    """Sorted positions (from 0) of the keys that occur twice or more in an array of longs."""
    pairs = F.sort_array(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
    again = let(pairs, lambda s: F.filter(s, lambda x, j: (F.get(s, j + 1)["k"] == x["k"]) | (F.get(s, j - 1)["k"] == x["k"])))
    return F.when(F.size(F.array_distinct(keys)) < F.size(keys), F.sort_array(F.transform(again, lambda x: x["i"]))).otherwise(F.array().cast("array<int>"))
