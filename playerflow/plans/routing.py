"""Queries for lookups, routing and the message envelope."""

from __future__ import annotations

from pyspark.sql import functions as F

from playerflow.functions.ids import name_uuid
from playerflow.functions.text import prefixed_selector
from playerflow.operators import lookups as K
from playerflow.plans.registry import query
from playerflow.sources import outbox as O
from playerflow.sources import tables as T

EV = f"WITH {T.EVENTS_CTE}"
PL = f"WITH {T.PLAYERS_CTE}"


@query(
    "referential_lookup",
    f"""{EV} SELECT seq, player_id, CASE WHEN country_id IS NOT NULL THEN coalesce(n_name, '') END AS country
    FROM ev LEFT JOIN nation ON n_regionkey = brand_id AND n_nationkey = country_id WHERE topic = 'players'""",
)
def referential_lookup(spark, sf):
    dim = T.read_table(spark, sf, "nation").selectExpr("CAST(n_regionkey AS BIGINT) AS brand_id", "n_nationkey AS id", "n_name AS text")
    return K.referential(T.events(spark, sf, "players"), dim, "country_id", "country").select("seq", "player_id", "country")


CODES = "CASE country_id % 4 WHEN 0 THEN 'FR' WHEN 1 THEN 'GBR' WHEN 2 THEN 'JP' ELSE 'XX' END"


@query(
    "iso_country_name",
    f"{PL} SELECT player_id, CASE country_id % 4 WHEN 0 THEN 'France' WHEN 1 THEN 'United Kingdom' WHEN 2 THEN 'Japan' ELSE 'XX' END AS country FROM players",
)
def iso_country_name(spark, sf):
    coded = T.players(spark, sf).withColumn("code", F.expr(CODES))
    return K.country_name(coded, K.iso_countries(spark), "code", "country").select("player_id", "country")


NAMES = "CASE country_id % 6 WHEN 0 THEN 'BoomerangCasino' WHEN 1 THEN 'betman' WHEN 2 THEN 'NoaBet' WHEN 3 THEN 'mrpachocasino' WHEN 4 THEN 'Other' END"


@query(
    "canonical_brand_name",
    f"""{PL} SELECT player_id, CASE country_id % 6 WHEN 0 THEN 'boomerang' WHEN 1 THEN 'betmen' WHEN 2 THEN 'naobet' WHEN 3 THEN 'mrpacho'
      ELSE CASE WHEN brand_id = 2 THEN 'ingobet' WHEN country_id % 6 = 4 THEN 'Other' END END AS brand_name FROM players""",
)
def canonical_brand_name(spark, sf):
    brand = F.when(F.col("brand_id") == 2, "217").otherwise(F.col("brand_id").cast("string"))
    return T.players(spark, sf).select("player_id", K.canonical_brand(F.expr(NAMES), brand).alias("brand_name"))


def _routes(spark, sf):
    return T.read_table(spark, sf, "region").filter(F.col("r_regionkey") < 3).selectExpr(
        "CAST(r_regionkey AS BIGINT) AS brand_id", "'queue_' || lower(r_name) AS destination"
    )


@query(
    "route_by_brand",
    f"{PL} SELECT player_id, 'queue_' || lower(r_name) AS destination FROM players JOIN region ON r_regionkey = brand_id WHERE r_regionkey < 3",
)
def route_by_brand(spark, sf):
    return K.route_by_brand(T.players(spark, sf), _routes(spark, sf))[0].select("player_id", "destination")


@query("unrouted", f"{PL} SELECT player_id, brand_id FROM players WHERE brand_id >= 3")
def unrouted(spark, sf):
    return K.route_by_brand(T.players(spark, sf), _routes(spark, sf))[1].select("player_id", "brand_id")


GROUPS = (("alpha", (0, 1)), ("beta", (1, 2)), ("gamma", (3,)))


@query(
    "brand_group",
    f"{PL} SELECT player_id, CASE WHEN brand_id IN (0, 1) THEN 'alpha' WHEN brand_id = 2 THEN 'beta' WHEN brand_id = 3 THEN 'gamma' ELSE 'nothandled' END AS brand_group FROM players",
)
def brand_group(spark, sf):
    return T.players(spark, sf).select("player_id", K.brand_group(F.col("brand_id"), GROUPS).alias("brand_group"))


LICENCE = "CASE WHEN player_wid % 7 = 0 THEN 'iom' WHEN player_wid % 7 = 1 THEN 'mga' END"
COUNTRY = "CASE country_id % 5 WHEN 0 THEN 'br' WHEN 1 THEN 'Gb' WHEN 2 THEN 'NL' WHEN 3 THEN 'uk' END"
OPERATOR = "CASE WHEN player_wid % 3 = 0 THEN 'mgm' ELSE 'own' END"


@query(
    "route_by_jurisdiction",
    f"""{PL}, j AS (SELECT player_id, upper({LICENCE}) AS l, upper({COUNTRY}) AS c, upper({OPERATOR}) AS o, country_id AS id FROM players)
    SELECT player_id, CASE WHEN c = 'BR' OR id = 24 THEN 'BR' WHEN l = 'IOM' THEN 'LICENCE' WHEN c IN ('UK', 'GB') THEN 'UK'
      WHEN c = 'NL' AND o = 'MGM' THEN 'OPERATOR_NL' ELSE 'DEFAULT' END AS route FROM j""",
)
def route_by_jurisdiction(spark, sf):
    route = K.route_by_jurisdiction(F.expr(LICENCE), F.expr(COUNTRY), F.expr(OPERATOR), F.col("country_id"), {"BR": 24})
    return T.players(spark, sf).select("player_id", route.alias("route"))


@query("selector_prefix", f"{PL} SELECT player_id, CASE WHEN brand_id IN (2, 4) THEN 'DEV_big_win' ELSE 'big_win' END AS selector FROM players")
def selector_prefix(spark, sf):
    return T.players(spark, sf).select("player_id", prefixed_selector(F.lit("big_win"), F.col("brand_id"), (2, 4)).alias("selector"))


@query(
    "envelope",
    f"""{EV} SELECT seq, '{{"type":"GENERIC_USER","contactId":"' || CAST(player_id AS STRING) || '","mappingSelector":"player_updated","properties":{{'
      || CASE WHEN email IS NOT NULL THEN '"email":"' || email || '"' || CASE WHEN language IS NOT NULL THEN ',' ELSE '' END ELSE '' END
      || CASE WHEN language IS NOT NULL THEN '"language":"' || language || '"' ELSE '' END || '}}}}' AS body,
      sha256(CAST(brand_id AS STRING) || '|' || CAST(player_id AS STRING) || '|player_updated|' || CAST(seq AS STRING)) AS dedup_id
    FROM ev WHERE topic = 'players'""",
)
def envelope(spark, sf):
    messages = O.outbox(
        T.events(spark, sf, "players").drop("channel").withColumn("selector", F.lit("player_updated")), properties=("email", "language")
    )
    return messages.select("seq", O.body().alias("body"), "dedup_id")


@query("include_brand_set", f"{PL} SELECT player_id, brand_id FROM players WHERE brand_id IN (SELECT r_regionkey FROM region WHERE r_name < 'B')")
def include_brand_set(spark, sf):
    return K.include_exclude(T.players(spark, sf), _own(spark, sf), True).select("player_id", "brand_id")


@query("exclude_brand_set", f"{PL} SELECT player_id, brand_id FROM players WHERE brand_id NOT IN (SELECT r_regionkey FROM region WHERE r_name < 'B')")
def exclude_brand_set(spark, sf):
    return K.include_exclude(T.players(spark, sf), _own(spark, sf), False).select("player_id", "brand_id")


@query(
    "include_exclude_brand_sets",
    f"{PL} SELECT player_id, CASE WHEN brand_id IN (SELECT r_regionkey FROM region WHERE r_name < 'B') THEN 'own' ELSE 'other' END AS pipeline FROM players",
)
def include_exclude_brand_sets(spark, sf):
    """Every player belongs to exactly one of the two pipelines."""
    part = lambda include, name: K.include_exclude(T.players(spark, sf), _own(spark, sf), include).select(
        "player_id", F.lit(name).alias("pipeline")
    )
    return part(True, "own").unionByName(part(False, "other"))


def _own(spark, sf):
    return T.read_table(spark, sf, "region").filter(F.col("r_name") < "B").selectExpr("CAST(r_regionkey AS BIGINT) AS brand_id")


@query("ids", f"""{EV}, u AS (SELECT seq, md5(CAST(player_id AS STRING) || '#' || CAST(seq AS STRING)) AS h FROM ev)
    SELECT seq, substring(h, 1, 8) || '-' || substring(h, 9, 4) || '-3' || substring(h, 14, 3) || '-' || translate(substring(h, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab')
      || substring(h, 18, 3) || '-' || substring(h, 21, 12) AS id FROM u""")
def ids(spark, sf):
    name = F.concat_ws("#", F.col("player_id").cast("string"), F.col("seq").cast("string"))
    return T.events(spark, sf).select("seq", name_uuid(name).alias("id"))


@query(
    "list_dimension",
    "SELECT n_regionkey, max(n_nationkey) AS n_nationkey, arg_max(n_name, n_nationkey) AS n_name FROM nation GROUP BY 1",
)
def list_dimension(spark, sf):
    return K.list_dimension(T.read_table(spark, sf, "nation"), "n_regionkey", ["n_nationkey"], "n_name")


@query("sort", "SELECT n_nationkey, n_name FROM nation ORDER BY n_name, n_nationkey")
def sort(spark, sf):
    return T.read_table(spark, sf, "nation", ["n_nationkey", "n_name"]).orderBy("n_name", "n_nationkey")


@query(
    "rekey",
    f"""{EV} SELECT CAST(brand_id AS STRING) || '-' || CAST(player_id AS STRING) AS key, '{{"seq":' || CAST(seq AS STRING) || ',"dt":"' || dt || '"}}' AS value
    FROM ev""",
)
def rekey(spark, sf):
    return O.keyed_json(T.events(spark, sf), ("brand_id", "player_id"), ("seq", "dt"))
