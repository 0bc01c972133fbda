"""String helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date10(value: Column) -> Column:
    """First ten characters of a datetime text; shorter text is kept."""
    return F.substring(value, 1, 10)


def blank_to_null(value: Column) -> Column:
    return F.when(F.trim(value) != "", value)


def starts_with_ci(value: Column, prefix: str) -> Column:
    return F.coalesce(F.lower(value).startswith(prefix.lower()), F.lit(False))


def contains_any_ci(value: Column, needles) -> Column:
    found = F.lit(False)
    for needle in needles:
        found = found | F.lower(value).contains(needle.lower())
    return F.coalesce(found, F.lit(False))


def pipe_join(values: Column) -> Column:
    return F.array_join(values, "|")


def prefixed_selector(selector: Column, brand: Column, brands, prefix: str = "DEV_") -> Column:
    """Selector with a prefix for the listed brands."""
    return F.when(brand.isin(list(brands)), F.concat(F.lit(prefix), selector)).otherwise(selector)
