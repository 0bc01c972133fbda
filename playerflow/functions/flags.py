"""Boolean text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TRUE_WORDS = ("true", "1")
TRUE_WORDS_WIDE = ("true", "1", "yes")


def to_bool(value: Column, words=TRUE_WORDS, ignore_case: bool = False) -> Column:
    """True for the given words, else False (also for null)."""
    text = F.lower(value) if ignore_case else value
    return F.coalesce(text.isin(list(words)), F.lit(False))


def to_flag(value: Column) -> Column:
    """``1`` for true, ``0`` otherwise."""
    return F.when(value, F.lit("1")).otherwise(F.lit("0"))


def consent_text(value: Column) -> Column:
    """``1``/``0`` to ``true``/``false``; anything else is absent."""
    return F.when(value == "1", "true").when(value == "0", "false")


def true_to_digit(value: Column) -> Column:
    """``1`` for true in any case, else ``0``; blank and absent text is kept."""
    return F.when(value.isNull() | (F.trim(value) == ""), value).otherwise(to_flag(F.lower(value) == "true"))
