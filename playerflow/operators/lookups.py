"""Dimension lookups and message routing.

Dimensions are joined without a broadcast hint: Spark broadcasts the ones
below ``spark.sql.autoBroadcastJoinThreshold`` and merges the rest. Fixed
configuration of a few entries is written as an expression instead.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def describe(df: DataFrame, dim: DataFrame, key: str, dim_key: str, text: str, out: str) -> DataFrame:
    """Left lookup by id; a missing description is blank."""
    side = dim.select(F.col(dim_key).alias("__id"), F.col(text).alias("__text"))
    return df.join(side, df[key] == F.col("__id"), "left").select(
        *[df[c] for c in df.columns], F.coalesce("__text", F.lit("")).alias(out)
    )


def referential(df: DataFrame, dim: DataFrame, id_column: str, out: str) -> DataFrame:
    """Lookup on ``(brand_id, id)``: unknown id is blank, absent id stays null.

    ``dim`` has the columns ``brand_id``, ``id`` and ``text``.
    """
    side = dim.select(F.col("brand_id").alias("__brand"), F.col("id").alias("__id"), F.col("text").alias("__text"))
    joined = df.join(side, (df["brand_id"] == F.col("__brand")) & (df[id_column] == F.col("__id")), "left")
    text = F.when(df[id_column].isNotNull(), F.coalesce("__text", F.lit("")))
    return joined.select(*[df[c] for c in df.columns], text.alias(out))


def _local(spark: SparkSession, rows: list, columns: list[str]) -> DataFrame:
    """A few hundred rows as a local relation, whose known size lets Spark broadcast it."""
    return spark.createDataFrame(pd.DataFrame(rows, columns=columns))


def iso_countries(spark: SparkSession) -> DataFrame:
    """Two- and three-letter country codes with English names, taken from the Java locale data."""
    locale = spark._jvm.java.util.Locale
    rows = []
    for code in locale.getISOCountries():
        country = locale("", code)
        name = country.getDisplayCountry(locale.ENGLISH)
        rows += [(code, name), (country.getISO3Country(), name)]
    return _local(spark, rows, ["code", "country"])


def country_zones(spark: SparkSession) -> DataFrame:
    """First canonical time zone per country code, taken from the ICU data that Spark ships."""
    jvm = spark._jvm
    locale = jvm.java.util.Locale
    zones = jvm.com.ibm.icu.util.TimeZone
    kind = jvm.java.lang.Class.forName("com.ibm.icu.util.TimeZone$SystemTimeZoneType")
    canonical = jvm.java.lang.Enum.valueOf(kind, "CANONICAL_LOCATION")
    rows = []
    for code in locale.getISOCountries():
        ids = zones.getAvailableIDs(canonical, code, None).iterator()
        if ids.hasNext():
            zone = ids.next()
            rows += [(code, zone), (locale("", code).getISO3Country(), zone)]
    return _local(spark, rows, ["code", "zone"])


def country_name(df: DataFrame, names: DataFrame, code: str, out: str) -> DataFrame:
    """Country name by code; an unknown code is kept."""
    side = names.select(F.col("code").alias("__code"), F.col("country").alias("__country"))
    return df.join(side, df[code] == F.col("__code"), "left").select(
        *[df[c] for c in df.columns], F.coalesce("__country", df[code]).alias(out)
    )


# Brand spellings and the brand whose name is set by id.
BRAND_ALIASES = {"boomerangcasino": "boomerang", "mrpachocasino": "mrpacho", "betman": "betmen", "noabet": "naobet"}
BRAND_OVERRIDES = {"217": "ingobet"}


def canonical_brand(name: Column, brand_id: Column, aliases: Mapping = BRAND_ALIASES, overrides: Mapping = BRAND_OVERRIDES) -> Column:
    """Alias on the lower-cased name, then override by id, else the name itself."""
    by_name = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    by_id = F.create_map(*[F.lit(x) for pair in overrides.items() for x in pair])
    return F.coalesce(by_name[F.lower(name)], by_id[brand_id.cast("string")], name)


def route_by_brand(df: DataFrame, routes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Messages with their destination, and those of brands without one."""
    joined = df.join(routes.select(F.col("brand_id").alias("__brand"), "destination"), df["brand_id"] == F.col("__brand"), "left").drop("__brand")
    return joined.filter(F.col("destination").isNotNull()), joined.filter(F.col("destination").isNull())


def brand_group(brand: Column, groups: Sequence[tuple[str, Iterable]]) -> Column:
    """First group that lists the brand; ``nothandled`` otherwise."""
    chain = None
    for name, brands in groups:
        met = brand.isin(list(brands))
        chain = F.when(met, name) if chain is None else chain.when(met, name)
    return chain.otherwise("nothandled")


def route_by_jurisdiction(
    licence: Column, country: Column, operator: Column, country_id: Column | None = None, ids: Mapping[str, object] | None = None
) -> Column:
    """Ordered: Brazil, licence IOM, United Kingdom, Netherlands with operator MGM, default.

    Countries match by text, or by id where ``ids`` names the ids of BR, UK and NL.
    """
    ids = ids or {}

    def lies_in(name, words):
        met = F.upper(country).isin(*words)
        return met | (country_id == F.lit(ids[name])) if name in ids else met

    return (
        F.when(lies_in("BR", ("BR",)), "BR")
        .when(F.upper(licence) == "IOM", "LICENCE")
        .when(lies_in("UK", ("UK", "GB")), "UK")
        .when(lies_in("NL", ("NL",)) & (F.upper(operator) == "MGM"), "OPERATOR_NL")
        .otherwise("DEFAULT")
    )


def include_exclude(df: DataFrame, own: DataFrame, include: bool) -> DataFrame:
    """Rows of the brands a pipeline owns, or of all others."""
    return df.join(own.select("brand_id").distinct(), "brand_id", "left_semi" if include else "left_anti")


def list_dimension(df: DataFrame, key: str, order: Sequence[str], text: str) -> DataFrame:
    """Latest row per id, sorted by description."""
    from playerflow.operators.timeline import last_rows

    return last_rows(df, [key], order).orderBy(text, key)
