"""Deterministic ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def name_uuid(name: Column) -> Column:
    """Name-based (MD5, version 3) UUID of a text."""
    digest = F.md5(name.cast("string"))
    # The variant digit keeps its two low bits and gets ``10`` in front.
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("3"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )


def dedup_id(*parts: Column) -> Column:
    """Repeatable message id, so that a replay can be recognised downstream."""
    return F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256)
