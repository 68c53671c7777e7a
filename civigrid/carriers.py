"""Municipal inputs made of the general test tables, with the same arithmetic in Spark and in SQL.

A vocabulary is indexed by a key modulo its length; ``pick`` gives the column and ``pick_sql`` the SQL for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civigrid.operators.staging import dealt

CITIES = ["Tucson", "Phoenix city", "Cañon City", "O'Fallon", "Winston-Salem", "St. Paul", "Carson City city", "  Mesa town ", "Springfield Village", "Boise"]
STATES = ["AZ", "Arizona", " co ", "New York", "CA", "Zz"]
LSADS = ["25", "43", "57", "CITY", "53", " town "]
TITLES = ["Council Districts", "Ward Boundaries", "Tucson_Wards", "Tree Equity by Ward", None, "Census Block Groups", "Aldermanic Districts", "Municipal Districts 2022", "Zoning-Parcels", "City Council Wards", "Golf"]
SERVICES = ["Wards", "Council_Districts", "Boundaries", None, "Election", "COT_wards", "Property Owners"]
LAYERS = ["Ward", "Council District", "wards_2022", None, "District Boundary", "Transit Routes", "Park districts", "City Council", "Housing per Ward"]
DESCRIPTIONS = [None, "Political boundary of the city", "Crime and project data", "Adopted council districts", "affordable housing households"]
GEOMETRIES = ["esriGeometryPolygon", "polygon", "esriGeometryPolygon", "esriGeometryPoint", None, "esriGeometryPolygon", "polygon"]
SERVERS = ["FeatureServer", "MapServer", "FeatureServer"]
HOSTS = ["services1.example.com", "gis.tucsonaz.gov", "maps.example.org", "Data.Example.com"]
SOURCES = ["arcgis", "arcgis", "arcgis", "arcgis", "municipal"]
FIELDS = [
    [("OBJECTID", None), ("WARD", "Ward"), ("NAME", "Ward Name")],
    [("OBJECTID", None), ("DISTRICT", None), ("REP_NAME", "Representative")],
    [("FID", None), ("COUNCIL_DISTRICT", "Council District"), ("LABEL", None)],
    [("WARDNUM", "Number"), ("Name", None)],
    [("APN", "Parcel"), ("OWNER", None)],
    [],
    [("OBJECTID", None), ("WARD", "Ward"), ("NAME", "Ward Name"), ("POP", "Population")],
    [("ID", "district id"), ("DistrictName", "name")],
]
FIELD_SETS = len(FIELDS)


def quoted(x: object) -> str:
    return "NULL" if x is None else "'" + str(x).replace("'", "''") + "'"


def pick(vocabulary: list, key: Column) -> Column:
    return F.get(F.array(*(F.lit(x).cast("string") for x in vocabulary)), F.pmod(key, F.lit(len(vocabulary))).cast("int"))


def pick_sql(vocabulary: list, key: str) -> str:
    return f"([{', '.join(map(quoted, vocabulary))}])[(({key}) % {len(vocabulary)}) + 1]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A gazetteer's rows, one for each supplier."""
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        F.lpad(k.cast("string"), 7, "0").alias("GEOID"),
        pick(CITIES, k).alias(" name "),
        pick(["AZ", "co", "NY"], k).alias("usps"),
        pick(LSADS, k).alias("LSAD"),
        F.when(k % 4 == 0, "").when(k % 4 == 1, "  ").otherwise((F.lit(30) + F.pmod(k, F.lit(7)) * 0.5).cast("string")).alias("INTPTLAT"),
        F.when(k % 3 == 0, "0x10").otherwise((-(F.lit(100) + F.pmod(k, F.lit(9)))).cast("string")).alias("INTPTLONG"),
        k.alias("ord"),
    )


GAZETTEER_SQL = f"""gazetteer AS (SELECT lpad(s_suppkey::VARCHAR, 7, '0') AS geoid, {pick_sql(CITIES, 's_suppkey')} AS name, {pick_sql(['AZ', 'co', 'NY'], 's_suppkey')} AS usps, {pick_sql(LSADS, 's_suppkey')} AS lsad,
  CASE s_suppkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 0.0 ELSE 30 + (s_suppkey % 7) * 0.5 END AS latitude, CASE WHEN s_suppkey % 3 = 0 THEN 16 ELSE -(100 + s_suppkey % 9) END AS longitude, s_suppkey AS ord FROM supplier)"""


def place_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places with accents, suffixes, and states by code or name."""
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(F.lpad(k.cast("string"), 7, "0").alias("place_fips"), pick(CITIES, k).alias("city"), pick(STATES, k).alias("state"), k.alias("ord"))


PLACES_SQL = f"places AS (SELECT lpad(s_suppkey::VARCHAR, 7, '0') AS place_fips, {pick_sql(CITIES, 's_suppkey')} AS city, {pick_sql(STATES, 's_suppkey')} AS state, s_suppkey AS ord FROM supplier)"


def fields_column(key: Column) -> Column:
    sets = [F.array(*(F.struct(F.lit(n).cast("string").alias("name"), F.lit(a).cast("string").alias("alias")) for n, a in s)).cast("array<struct<name:string,alias:string>>") for s in FIELDS]
    return F.get(F.array(*sets), F.pmod(key, F.lit(FIELD_SETS)).cast("int"))


def layer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inspected layers, one for each part, 20 for a place; without detected fields. Places are dealt over tasks while a row is still narrow."""
    k = F.col("p_partkey")
    place, nth = F.floor(k / 20), F.pmod(k, F.lit(20))
    return dealt(table(spark, sf_dir, "part").select("p_partkey", F.lpad(place.cast("string"), 7, "0").alias("place_fips")), "place_fips").select(
        "place_fips",
        k.alias("ord"),
        F.concat(F.lit("City "), place.cast("string")).alias("city"),
        F.lit("AZ").alias("state"),
        F.concat(F.lit("https://"), pick(HOSTS, F.floor(k / 3)), F.lit("/arcgis/rest/services/S"), F.pmod(F.floor(nth / 2), F.lit(13)).cast("string"), F.lit("/"), pick(SERVERS, F.floor(k / 5)), F.lit("/"), F.pmod(place, F.lit(4)).cast("string")).alias("url"),
        pick(SOURCES, F.floor(k / 7)).alias("source"),
        pick(TITLES, place + nth).alias("title"),
        pick(["Wards map", None, "Council open data"], k).alias("candidate_title"),
        pick(SERVICES, place + F.floor(nth / 3)).alias("service_name"),
        pick(LAYERS, place + F.floor(nth / 2)).alias("layer_name"),
        pick(DESCRIPTIONS, F.floor(k / 11)).alias("description"),
        pick(GEOMETRIES, 3 * place + nth).alias("geometry_type"),
        pick(SERVERS, F.floor(k / 5)).alias("service_type"),
        fields_column(place + F.floor(nth / 2)).alias("fields"),
        F.pmod(place + F.floor(nth / 2), F.lit(FIELD_SETS)).alias("field_set"),
        (k % 3 == 0).alias("supports_query"),
        (k % 5 == 0).alias("supports_geojson"),
        F.when(k % 7 != 0, k % 2 == 0).alias("supports_pagination"),
        (k % 17 == 0).alias("requires_review"),
    ).withColumn("candidate_url", F.col("url"))


LAYERS_SQL = f"""layers AS (SELECT lpad((p_partkey // 20)::VARCHAR, 7, '0') AS place_fips, p_partkey AS ord, 'City ' || (p_partkey // 20)::VARCHAR AS city, 'AZ' AS state,
  'https://' || {pick_sql(HOSTS, 'p_partkey // 3')} || '/arcgis/rest/services/S' || (((p_partkey % 20) // 2) % 13)::VARCHAR || '/' || {pick_sql(SERVERS, 'p_partkey // 5')} || '/' || ((p_partkey // 20) % 4)::VARCHAR AS url,
  {pick_sql(SOURCES, 'p_partkey // 7')} AS source, {pick_sql(TITLES, 'p_partkey // 20 + p_partkey % 20')} AS title, {pick_sql(["Wards map", None, "Council open data"], 'p_partkey')} AS candidate_title, {pick_sql(SERVICES, 'p_partkey // 20 + (p_partkey % 20) // 3')} AS service_name, {pick_sql(LAYERS, 'p_partkey // 20 + (p_partkey % 20) // 2')} AS layer_name,
  {pick_sql(DESCRIPTIONS, 'p_partkey // 11')} AS description, {pick_sql(GEOMETRIES, '3 * (p_partkey // 20) + p_partkey % 20')} AS geometry_type, {pick_sql(SERVERS, 'p_partkey // 5')} AS service_type, (p_partkey // 20 + (p_partkey % 20) // 2) % {FIELD_SETS} AS field_set,
  p_partkey % 3 = 0 AS supports_query, p_partkey % 5 = 0 AS supports_geojson, CASE WHEN p_partkey % 7 <> 0 THEN p_partkey % 2 = 0 END AS supports_pagination, p_partkey % 17 = 0 AS requires_review FROM part)"""

FIELDS_SQL = "field_rows(field_set, pos, name, alias) AS (VALUES " + ", ".join(f"({s}, {i}, {quoted(n)}, {quoted(a)})" for s, fs in enumerate(FIELDS) for i, (n, a) in enumerate(fs)) + ")"


def normal_sql(x: str) -> str:
    """Lower case, underscores and hyphens as spaces, white space collapsed."""
    return f"trim(regexp_replace(regexp_replace(lower(coalesce({x}, '')), '[_-]+', ' ', 'g'), '\\s+', ' ', 'g'))"


def title_sql(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(regexp_replace(lower(coalesce({x}, '')), '[_-]+', ' ', 'g'), '[^\\p{{L}}\\p{{N}}\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"


def key_sql(x: str) -> str:
    return f"regexp_replace(lower(coalesce({x}, '')), '[^a-z0-9]', '', 'g')"


def any_sql(text: str, terms: list[str]) -> str:
    return "(" + " OR ".join(f"contains({text}, {quoted(t)})" for t in terms) + ")"


def points_sql(rules: list[tuple[str, float]]) -> str:
    return "(" + " + ".join(f"CASE WHEN {c} THEN {float(w)!r} ELSE 0.0 END" for c, w in rules) + ")::DOUBLE"


def urls_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Real addresses, with made variations of case, slashes and service paths."""
    k = F.col("page_id")
    tail = pick(["", "/", "//", "/arcgis/rest/services/Wards/FeatureServer/0", "/X/MapServer", "/a/featureserver/12", "/FeatureServer/0?x=1"], k)
    base = F.regexp_replace("url", r"[?#].*$", "")
    return table(spark, sf_dir, "pages").select(k.alias("id"), F.when(k % 2 == 0, F.col("url")).otherwise(F.concat(base, tail)).alias("url"))


URLS_SQL = f"""urls AS (SELECT page_id AS id, CASE WHEN page_id % 2 = 0 THEN url ELSE regexp_replace(url, '[?#].*$', '') || {pick_sql(["", "/", "//", "/arcgis/rest/services/Wards/FeatureServer/0", "/X/MapServer", "/a/featureserver/12", "/FeatureServer/0?x=1"], 'page_id')} END AS url FROM pages)"""
