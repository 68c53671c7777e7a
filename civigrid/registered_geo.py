"""Further queries: validation, registry searches, metadata, discovery totals, GeoJSON, point look-ups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civigrid import carriers as C
from civigrid.functions import text as T

from civigrid.operators import geojson as J
from civigrid.operators import registry as R
from civigrid.operators import validation as V
from civigrid.operators.staging import dealt, new_path
from civigrid.registered import CHOSEN, PLACE_TYPE_SQL, REGISTRY_NAME_SQL, bars, query, state_sql
from civigrid.registered import QUERIES as _OTHERS
from civigrid.registered import SQL as _OTHER_SQL

_before = set(_OTHERS)

# A registry of the nations on a grid of five columns; every third polygon has a hole, every fourth is a multipolygon of two squares.

KINDS = ["ward", "council-district", "city-council-district"]


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey")
    return C.table(spark, sf_dir, "nation").select(
        k.cast("long").alias("pos"),
        F.lpad(k.cast("string"), 7, "0").alias("placeFips"),
        C.pick(C.CITIES, k).alias("city"),
        C.pick(C.STATES, k).alias("state"),
        C.pick(KINDS, k).alias("boundaryType"),
        F.concat(F.lit("f"), k.cast("string")).alias("generatedFile"),
        F.struct(F.lit("arcgis").alias("sourceType"), F.concat(F.lit("https://example.com/"), F.col("n_name")).alias("url"), F.struct(F.lit("WARD").alias("district"), F.when(k % 2 == 0, "NAME").alias("name")).alias("fieldMapping")).alias("source"),
    )


ENTRIES_SQL = f"entries AS (SELECT n_nationkey::BIGINT AS pos, lpad(n_nationkey::VARCHAR, 7, '0') AS \"placeFips\", {C.pick_sql(C.CITIES, 'n_nationkey')} AS city, {C.pick_sql(C.STATES, 'n_nationkey')} AS state, {C.pick_sql(KINDS, 'n_nationkey')} AS \"boundaryType\", n_nationkey AS k, n_name FROM nation)"


def square(x: str, y: str, size: str) -> str:
    return f"[[{x}, {y}], [{x} + {size}, {y}], [{x} + {size}, {y} + {size}], [{x}, {y} + {size}], [{x}, {y}]]"


def collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feature collection for each nation, as JSON text made by arithmetic."""
    k = F.col("n_nationkey")
    x, y = (-120 + F.pmod(k, F.lit(5)) * 4), (30 + F.floor(k / 5) * 4)

    def ring(dx: float, dy: float, n: float):
        corners = [(0, 0), (n, 0), (n, n), (0, n), (0, 0)]
        return F.concat(F.lit("["), F.concat_ws(",", *(F.concat(F.lit("["), (x + dx + a).cast("string"), F.lit(","), (y + dy + b).cast("string"), F.lit("]")) for a, b in corners)), F.lit("]"))

    polygon = F.when(k % 3 == 0, F.concat(F.lit('{"type":"Polygon","coordinates":['), ring(0, 0, 3), F.lit(","), ring(1, 1, 1), F.lit("]}"))).when(k % 4 == 1, F.concat(F.lit('{"type":"MultiPolygon","coordinates":[['), ring(0, 0, 1), F.lit("],["), ring(2, 2, 1), F.lit("]]}"))).otherwise(F.concat(F.lit('{"type":"Polygon","coordinates":['), ring(0, 0, 3), F.lit("]}")))
    point = F.lit('{"type":"Point","coordinates":[0,0]}')
    properties = F.concat(F.lit('{"WARD":'), F.when(k % 2 == 0, F.concat(F.lit('"  W'), k.cast("string"), F.lit(' "'))).otherwise(k.cast("string")), F.lit(',"NAME":"'), F.col("n_name"), F.lit('"'), F.when(k % 5 == 0, F.concat(F.lit(',"id":"own-'), k.cast("string"), F.lit('"'))).otherwise(F.lit("")), F.lit("}"))
    text = F.concat(F.lit('{"type":"FeatureCollection","features":[{"type":"Feature","properties":{},"geometry":'), point, F.lit('},{"type":"Feature"'), F.when(k % 7 == 0, F.concat(F.lit(',"id":'), k.cast("string"))).otherwise(F.lit("")), F.lit(',"properties":'), properties, F.lit(',"geometry":'), polygon, F.lit("}]}"))
    return C.table(spark, sf_dir, "nation").select(F.lpad(k.cast("string"), 7, "0").alias("place_fips"), C.pick(KINDS, k).alias("boundary_type"), text.alias("value"))


def boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    from civigrid.sources.documents import exploded, feature_collections

    return exploded(feature_collections(collections(spark, sf_dir)))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points on a quarter-degree grid, so many lie on edges and vertices; some out of range."""
    k = F.col("event_id")
    lon = F.when(k % 97 == 0, F.lit(999.0)).otherwise(-121 + F.pmod(k, F.lit(88)) * 0.25)
    lat = F.when(k % 89 == 0, F.lit(-91.0)).otherwise(29 + F.pmod(F.floor(k / 88), F.lit(88)) * 0.25)
    return C.table(spark, sf_dir, "events").select(k.alias("point_id"), lat.cast("double").alias("lat"), lon.cast("double").alias("lon"))


POINTS_SQL = "points AS (SELECT event_id AS point_id, CASE WHEN event_id % 89 = 0 THEN -91.0 ELSE 29 + ((event_id // 88) % 88) * 0.25 END::DOUBLE AS lat, CASE WHEN event_id % 97 = 0 THEN 999.0 ELSE -121 + (event_id % 88) * 0.25 END::DOUBLE AS lon FROM events)"
# In closed form: squares with borders; a hole's inside is outside, but its border is inside.
WITHIN = """lon BETWEEN x AND x + 3 AND lat BETWEEN y AND y + 3 AND CASE WHEN k % 3 = 0 THEN NOT (lon > x + 1 AND lon < x + 2 AND lat > y + 1 AND lat < y + 2)
 WHEN k % 4 = 1 THEN (lon <= x + 1 AND lat <= y + 1) OR (lon >= x + 2 AND lat >= y + 2) ELSE true END"""
FEATURE_SQL = """CASE WHEN k % 2 = 0 THEN 'W' || k::VARCHAR ELSE k::VARCHAR END AS district, CASE WHEN k % 2 = 0 THEN n_name ELSE k::VARCHAR END AS name"""


@query(f"""WITH {ENTRIES_SQL}, {POINTS_SQL}, f AS (SELECT *, -120 + (k % 5) * 4 AS x, 30 + (k // 5) * 4 AS y, {FEATURE_SQL} FROM entries),
h AS (SELECT point_id, arg_min(struct_pack(id := CASE WHEN k % 5 = 0 THEN 'own-' || k::VARCHAR ELSE "placeFips" || '-' || "boundaryType" || '-' || district END, d := district, n := name, p := "placeFips"), pos) AS hit FROM points JOIN f ON {WITHIN} WHERE lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180 GROUP BY point_id)
SELECT point_id, hit IS NOT NULL AS found, hit.id AS id, hit.d AS district, hit.n AS name, hit.p AS place_fips FROM points LEFT JOIN h USING (point_id)""")
def q_point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from civigrid.plans.lookup import lookup

    return lookup(points(spark, sf_dir), entries(spark, sf_dir), boundaries(spark, sf_dir)).select("point_id", "found", "id", "district", "name", "place_fips")


@query(f"""WITH {ENTRIES_SQL}, {POINTS_SQL}, f AS (SELECT *, -120 + (k % 5) * 4 AS x, 30 + (k // 5) * 4 AS y, {FEATURE_SQL} FROM entries WHERE {state_sql('state')} = 'AZ' AND "boundaryType" = 'ward'),
h AS (SELECT point_id, arg_min(district, pos) AS district FROM points JOIN f ON {WITHIN} WHERE lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180 GROUP BY point_id)
SELECT point_id, district IS NOT NULL AS found, district FROM points LEFT JOIN h USING (point_id)""")
def q_point_lookup_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    from civigrid.plans.lookup import lookup

    return lookup(points(spark, sf_dir), entries(spark, sf_dir), boundaries(spark, sf_dir), state="Arizona", boundary_type="ward").select("point_id", "found", "district")


@query(f"WITH {ENTRIES_SQL} SELECT pos, \"placeFips\", city FROM entries WHERE {REGISTRY_NAME_SQL.format('city')} = 'winston salem' AND {state_sql('state')} = 'CA'")
def q_registry_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.matching(entries(spark, sf_dir), city="WINSTON-salem", state="California").select("pos", "placeFips", "city")


@query(f"WITH {ENTRIES_SQL} SELECT pos, \"placeFips\", \"boundaryType\" FROM entries WHERE \"boundaryType\" = 'council-district' ORDER BY pos LIMIT 1")
def q_registry_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.first_matching(entries(spark, sf_dir), boundary_type="council-district").select("pos", "placeFips", "boundaryType")


def broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generated entries of the customers, each seventh or so with another fault."""
    k = F.col("c_custkey")

    def bad(n: int, value, good):
        return F.when(k % 31 == n, F.lit(value)).otherwise(good)

    source = F.struct(bad(4, "ftp://x", F.lit("https://example.com/a")).alias("url"), bad(5, "ImageServer", F.lit("MapServer")).alias("serviceType"), bad(6, "  ", F.lit("T")).alias("title"), F.when(k % 31 != 7, True).alias("official"))
    fields = F.struct(bad(9, "", F.lit("WARD")).alias("district"), F.lit("NAME").alias("name"))
    meta = F.struct(bad(11, "never", F.lit("2026-01-02T03:04:05.678Z")).alias("generatedAt"), F.when(k % 31 != 12, False).alias("requiresReview"))
    return C.table(spark, sf_dir, "customer").select(k.alias("pos"), F.when(k % 31 == 0, "12").otherwise(F.lpad(k.cast("string"), 7, "0")).alias("placeFips"), bad(1, " ", F.lit("Tucson")).alias("city"), bad(2, "Az", F.lit("AZ")).alias("state"), bad(3, "county", F.lit("ward")).alias("districtType"), F.when(k % 31 != 8, source).alias("source"), F.when(k % 31 != 10, fields).alias("fields"), F.when(k % 31 != 13, meta).alias("metadata"))


# The same rows in SQL, and the rules over their values, in their order.
BROKEN_SQL = """broken AS (SELECT c_custkey AS pos, CASE WHEN k = 0 THEN '12' ELSE lpad(c_custkey::VARCHAR, 7, '0') END AS fips, CASE WHEN k = 1 THEN ' ' ELSE 'Tucson' END AS city, CASE WHEN k = 2 THEN 'Az' ELSE 'AZ' END AS state, CASE WHEN k = 3 THEN 'county' ELSE 'ward' END AS kind,
 k <> 8 AS has_source, CASE WHEN k = 4 THEN 'ftp://x' ELSE 'https://example.com/a' END AS url, CASE WHEN k = 5 THEN 'ImageServer' ELSE 'MapServer' END AS service, CASE WHEN k = 6 THEN '  ' ELSE 'T' END AS title, CASE WHEN k <> 7 THEN true END AS official,
 k <> 10 AS has_fields, CASE WHEN k = 9 THEN '' ELSE 'WARD' END AS district, k <> 13 AS has_metadata, CASE WHEN k = 11 THEN 'never' ELSE '2026-01-02T03:04:05.678Z' END AS made, CASE WHEN k <> 12 THEN false END AS review FROM (SELECT c_custkey, c_custkey % 31 AS k FROM customer)),
judged AS (SELECT pos, CASE WHEN NOT regexp_full_match(fips, '[0-9]{7}') THEN 'placeFips must be a 7-digit Census place GEOID.' WHEN trim(city) = '' THEN 'city is required.' WHEN NOT regexp_full_match(state, '[A-Z]{2}') THEN 'state must be a two-letter abbreviation.'
 WHEN kind NOT IN ('ward', 'council-district', 'aldermanic-district', 'municipal-district') THEN 'invalid districtType: ' || kind WHEN NOT has_source THEN 'source is required.' WHEN NOT regexp_matches(url, '^https?://') THEN 'source.url must be a valid HTTP or HTTPS URL.'
 WHEN service NOT IN ('FeatureServer', 'MapServer') THEN 'source.serviceType must be FeatureServer or MapServer.' WHEN trim(title) = '' THEN 'source.title is required.' WHEN official IS NULL THEN 'source.official must be a boolean.' WHEN NOT has_fields THEN 'fields is required.'
 WHEN trim(district) = '' THEN 'fields.district is required.' WHEN NOT has_metadata THEN 'metadata is required.' WHEN try_cast(made AS TIMESTAMPTZ) IS NULL THEN 'metadata.generatedAt must be a valid date.' WHEN review IS NULL THEN 'metadata.requiresReview must be a boolean.' END AS error FROM broken)"""


@query(f"WITH {BROKEN_SQL} SELECT pos, 'Entry ' || (pos + 1)::VARCHAR || ': ' || error AS error FROM judged")
def q_registry_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.generated_entries(broken(spark, sf_dir)).select("pos", "error")


@query(f"WITH {BROKEN_SQL} SELECT count(*) FILTER (error IS NULL) AS valid, count(error) AS invalid FROM judged")
def q_registry_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.totals(V.generated_entries(broken(spark, sf_dir)))


@query(f"""WITH {ENTRIES_SQL}, v AS (SELECT pos, state, "placeFips" AS fips, CASE WHEN k % 6 <> 1 THEN city END AS city, "boundaryType" AS kind, CASE WHEN k % 6 <> 4 THEN 'f' || k::VARCHAR END AS file, k % 6 <> 2 AS has_source, CASE WHEN k % 6 <> 3 THEN 'WARD' END AS district FROM entries)
SELECT pos, CASE WHEN fips IS NULL THEN 'Invalid registry entry: missing placeFips.' WHEN city IS NULL THEN 'Invalid registry entry: missing city.' WHEN state IS NULL THEN 'Invalid registry entry: missing state.' WHEN kind IS NULL THEN 'Invalid registry entry: missing boundaryType.' WHEN file IS NULL THEN 'Invalid registry entry: missing generatedFile.'
 WHEN NOT has_source THEN 'Invalid registry source: expected an object.' WHEN district IS NULL THEN 'Invalid registry source: missing fieldMapping.district.' END AS error, {state_sql('state')} AS state FROM v""")
def q_registry_package_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("pos") % 6
    rows = entries(spark, sf_dir)
    mapping = F.when(k == 3, F.struct(F.lit(None).cast("string").alias("district"), F.lit("x").alias("name"))).otherwise(F.col("source.fieldMapping"))
    rows = rows.withColumns({"city": F.when(k != 1, F.col("city")), "generatedFile": F.when(k != 4, F.col("generatedFile")), "source": F.when(k != 2, F.col("source").withField("fieldMapping", mapping))})
    return V.package_entries(rows).select("pos", "error", "state")


@query(f"""WITH {C.PLACES_SQL}, v AS (SELECT place_fips, state, CASE WHEN ord % 5 <> 2 THEN city END AS city, CASE ord % 5 WHEN 1 THEN 'other' WHEN 3 THEN 'incorporated-place' END AS kind FROM places)
SELECT place_fips AS \"placeFips\", CASE WHEN city IS NULL THEN 'Invalid Census place: missing city.' WHEN kind NOT IN ('incorporated-place', 'census-designated-place') THEN 'Invalid Census place ' || place_fips || ': invalid placeType.' END AS error, {state_sql('state')} AS state FROM v""")
def q_places_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("ord") % 5
    rows = C.place_rows(spark, sf_dir).select(F.col("place_fips").alias("placeFips"), F.when(k != 2, F.col("city")).alias("city"), "state", F.when(k == 1, "other").when(k == 3, "incorporated-place").alias("placeType"))
    return V.place_rows(rows).select("placeFips", "error", "state")


@query(f"""WITH {ENTRIES_SQL} SELECT "placeFips" AS collection, 1 AS feature_pos, CASE WHEN k % 7 = 0 THEN k::VARCHAR WHEN k % 2 = 0 THEN 'W' || k::VARCHAR ELSE k::VARCHAR END AS id, CASE WHEN k % 2 = 0 THEN 'W' || k::VARCHAR ELSE k::VARCHAR END AS district, n_name AS name, CASE WHEN k % 3 <> 0 AND k % 4 = 1 THEN 'MultiPolygon' ELSE 'Polygon' END AS geometry_type FROM entries""")
def q_geojson_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    shapes = boundaries(spark, sf_dir).where(F.col("geometry_type").isin(*J.POLYGONS)).withColumnRenamed("place_fips", "collection")
    return J.normalised(shapes, "Tucson", "AZ", "0477000", "ward", key=["collection"]).select("collection", "feature_pos", "id", "district", "name", "geometry_type")


# Property names of features, by the collection's number; the second feature has the next number's names too.
PROPERTY_SETS = [["WARD", "NAME"], ["OBJECTID", "Council_District", "Label"], ["FID", "WardBoundaryNo", "council-name"], ["APN", "owner"], ["DistrictName", "Ward No", "Description", "district_name"], ["name", "my_ward_x", "his_district"], []]


def named_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two features for each customer's collection, with properties of several names."""
    k = F.col("c_custkey")
    bodies = F.array(*(F.lit("{" + ",".join(f'"{n}":{i}' for i, n in enumerate(names)) + "}") for names in PROPERTY_SETS))
    at = F.pmod(k + F.col("feature_pos"), F.lit(len(PROPERTY_SETS))).cast("int")
    return C.table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("place_fips"), k, F.explode(F.array(F.lit(0), F.lit(1))).alias("feature_pos")).select("place_fips", "feature_pos", F.parse_json(F.get(bodies, at)).alias("properties"), F.get(bodies, at).alias("properties_text"))


def ranks_sql(names: list[str]) -> str:
    return f"list_position({list(dict.fromkeys(n.replace('_', '') for n in names))}, key)"


@query(f"""WITH names(set_no, i, name) AS (VALUES {", ".join(f"({s}, {i}, '{n}')" for s, names in enumerate(PROPERTY_SETS) for i, n in enumerate(names))}),
p AS (SELECT c_custkey, name, {C.key_sql('name')} AS key, feature_pos * 100 + i AS place FROM customer, (VALUES (0), (1)) f(feature_pos) JOIN names ON set_no = (c_custkey + feature_pos) % {len(PROPERTY_SETS)}),
o AS (SELECT c_custkey, name, key, min(place) AS place, {ranks_sql(J.DISTRICT_NAMES)} AS d, {ranks_sql(J.NAME_NAMES)} AS n FROM p GROUP BY c_custkey, name, key)
SELECT c_custkey::VARCHAR AS place_fips, coalesce(arg_min(name, d * 1000 + place) FILTER (d > 0), arg_min(name, place) FILTER (key LIKE '%district%' OR key LIKE '%ward%')) AS district_property, arg_min(name, n * 1000 + place) FILTER (n > 0) AS name_property FROM o GROUP BY c_custkey""")
def q_property_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.detected_fields(named_features(spark, sf_dir), ["place_fips"])


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, length(props) AS n, CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 3 = 1 THEN 'Layer ' || event_id::VARCHAR ELSE 'x' END AS name FROM events")
def q_json_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    from civigrid.sources.recorded import metadata

    k = F.col("event_id")
    body = F.when(k % 3 == 0, F.lit("not json")).when(k % 3 == 1, F.concat(F.lit('{"name":"Layer '), k.cast("string"), F.lit('","fields":[]}'))).otherwise(F.lit('{"name":"x","extra":1}'))
    rows = C.table(spark, sf_dir, "events").select(k.cast("string").alias("url"), body.alias("body"), "props", "event_id")
    parsed = metadata(rows.select("url", "body")).select(F.col("url").cast("long").alias("event_id"), "name")
    return rows.select("event_id", F.get_json_object("props", "$.k").alias("k"), F.length("props").alias("n")).join(parsed, "event_id")


#: Messages of what broke off the processing of some places.
CAUSES = ["fetch failed", "Unexpected token < in JSON"]


def recorded_run(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """A discovery run over all suppliers as places, with answers made from their keys.

    Each place makes six searches; every fifth place has no answer to any, of the others' a quarter of the searches have
    none, and some answers lack the service's address. Of every eleven places one failed.
    """
    from civigrid.plans.discovery import discovered, search_texts

    k = F.col("s_suppkey")
    places = C.table(spark, sf_dir, "supplier").select(F.lpad(k.cast("string"), 7, "0").alias("place_fips"), F.concat(F.lit("City"), k.cast("string")).alias("city"), F.lit("AZ").alias("state"))
    n = F.col("place_fips").cast("long")
    failures = places.where(n % 11 == 3).select("place_fips", C.pick(CAUSES, n).alias("error"))
    asked = search_texts(places).where((n % 5 != 0) & ((n + F.col("query_no")) % 4 != 0))
    base = F.concat(F.lit("https://gis.tucsonaz.gov/rest/services/P"), n.cast("string"), F.lit("/FeatureServer"))

    def hit(title: str, url: Column) -> Column:
        return F.struct(F.lit(title).alias("title"), url.alias("url"))

    answers = F.array(hit("Wards", F.concat(base, F.lit("/0/"))), hit("Same", F.concat(base, F.lit("/x/../0?f=html"))), hit("Service", F.when(n % 7 != 1, base)), hit("No address", F.lit("")))
    hits = asked.select("query", F.posexplode(answers).alias("pos", "h")).select("query", "pos", "h.title", "h.url")
    fields = '"fields":[{"name":"WARD","alias":"Ward"},{"name":"NAME","alias":"Ward Name"}]'
    layer = F.concat(F.lit('{"name":"'), F.when(n % 3 == 0, "Parks").otherwise("Ward Boundary"), F.lit('","geometryType":"esriGeometryPolygon","capabilities":"Query","supportedQueryFormats":"JSON, geoJSON",' + fields + "}"))
    bodies = places.select(F.explode(F.array(F.struct(F.concat(base, F.lit("/0")).alias("url"), layer.alias("body")), F.struct(base.alias("url"), F.lit('{"name":"City service","layers":[{"id":1,"name":"Roads"},{"id":0,"name":"Wards"}]}').alias("body")))).alias("m")).select("m.*")
    return discovered(places, hits, bodies, failures)


#: Candidates of the places that were processed: ``v`` is 0 for the layer's address, 2 for the service's.
RUN_SQL = f"""p AS (SELECT s_suppkey AS k, s_suppkey % 11 = 3 AS failed, CASE WHEN s_suppkey % 11 = 3 THEN {C.pick_sql(CAUSES, 's_suppkey')} END AS error FROM supplier),
s AS (SELECT k, q FROM p, range(6) r(q) WHERE NOT failed AND k % 5 <> 0 AND (k + q) % 4 <> 0),
c AS (SELECT k, v, min(q) * 1000 + v AS ord, k % 3 = 0 AS rejected FROM s, (VALUES (0), (2)) u(v) WHERE v = 0 OR k % 7 <> 1 GROUP BY k, v)"""


@query(f"""WITH {RUN_SQL}, g AS (SELECT DISTINCT k FROM c WHERE NOT rejected)
SELECT count(*) AS municipalities, (SELECT count(*) FROM c) AS candidates, (SELECT count(*) FROM c) AS inspected, (SELECT count(*) FROM c WHERE NOT rejected) AS valid, (SELECT count(*) FROM c WHERE rejected) AS rejected, (SELECT count(*) FROM g) AS groups,
 (SELECT count(*) FROM g) AS canonical, count(*) FILTER (NOT failed AND k NOT IN (SELECT k FROM g)) AS no_canonical, count(*) FILTER (failed) AS failed FROM p""")
def q_discovery_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    from civigrid.plans.discovery import summary

    return summary(recorded_run(spark, sf_dir)["results"])


@query(f"""WITH {RUN_SQL} SELECT lpad(p.k::VARCHAR, 7, '0') AS place_fips, count(c.k) AS n_candidates, count(*) FILTER (NOT rejected) AS n_valid, count(DISTINCT CASE WHEN NOT rejected THEN c.k END) AS n_chosen, any_value(error) AS error FROM p LEFT JOIN c USING (k) GROUP BY p.k""")
def q_discovery_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recorded_run(spark, sf_dir)["results"].select("place_fips", "n_candidates", "n_valid", "n_chosen", "error")


@query(f"""WITH {RUN_SQL} SELECT lpad(k::VARCHAR, 7, '0') AS place_fips, ord::BIGINT AS ord, 'https://gis.tucsonaz.gov/rest/services/P' || k::VARCHAR || '/FeatureServer/0' AS url, CASE WHEN v = 0 THEN 'P' || k::VARCHAR ELSE 'City service' END AS service_name, CASE WHEN rejected THEN 'Parks' ELSE 'Ward Boundary' END AS layer_name, 'WARD|NAME' AS district_fields, 'NAME' AS name_fields, rejected FROM c""")
def q_inspect(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = recorded_run(spark, sf_dir)["inspected"]
    return found.select("place_fips", "ord", "url", "service_name", "layer_name", bars("district_fields").alias("district_fields"), bars("name_fields").alias("name_fields"), "rejected")


def recorded_answers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All suppliers as places, and recorded answers (url, status, body) to the requests that a run over them makes.

    Every fifth place has no answer to any search. Of the others' searches a quarter is answered by what is no JSON, and
    of every 17 places one has a search with status 500. Of every 13 places one has a hit whose address is a number, of
    every 19 one has a hit with a malformed address, of every 23 one has a layer whose name is a number.
    """
    from civigrid.plans.crawl import ENDPOINT
    from civigrid.plans.discovery import search_texts
    from civigrid.sources.recorded import USUAL_HITS
    from civigrid.sources.requests import search_address

    k = F.col("s_suppkey")
    places = C.table(spark, sf_dir, "supplier").select(F.lpad(k.cast("string"), 7, "0").alias("place_fips"), F.concat(F.lit("City"), k.cast("string")).alias("city"), F.lit("AZ").alias("state"))
    n = F.col("place_fips").cast("long")
    base = F.concat(F.lit("https://gis.tucsonaz.gov/rest/services/P"), n.cast("string"), F.lit("/FeatureServer"))

    def hit(title: str, url: Column) -> Column:
        return F.concat(F.lit(f'{{"title":"{title}","url":'), url, F.lit("}"))

    def text(url: Column) -> Column:
        return F.concat(F.lit('"'), url, F.lit('"'))

    odd = F.concat_ws(",", F.when(n % 13 == 4, F.lit('{"url":17}')), F.when(n % 19 == 6, F.lit('{"url":"https://[bad/FeatureServer/0"}')), F.lit('{"title":"No address"}'))
    hits = F.concat_ws(",", hit("Wards", text(F.concat(base, F.lit("/0/")))), hit("Same", text(F.concat(base, F.lit("/x/../0?f=html")))), F.when(n % 7 != 1, hit("Service", text(base))), odd)
    asked = search_texts(places).where(n % 5 != 0)
    body = F.when((n + F.col("query_no")) % 4 == 0, F.lit("<html>")).otherwise(F.concat(F.lit('{"results":['), hits, F.lit("]}")))
    searches = asked.select(search_address(F.col("query"), ENDPOINT, USUAL_HITS).alias("url"), F.when((n % 17 == 5) & (F.col("query_no") == 1), 500).otherwise(200).alias("status"), body.alias("body"))
    fields = '"fields":[{"name":"WARD","alias":"Ward"},{"name":"NAME","alias":"Ward Name"}]'
    name = F.when(n % 23 == 7, F.lit("7")).when(n % 3 == 0, F.lit('"Parks"')).otherwise(F.lit('"Ward Boundary"'))
    layer = F.concat(F.lit('{"name":'), name, F.lit(',"geometryType":"esriGeometryPolygon","capabilities":"Query","supportedQueryFormats":"JSON, geoJSON",' + fields + "}"))
    service = F.lit('{"name":"City service","layers":[{"id":1,"name":"Roads"},{"id":0,"name":"Wards"}]}')
    metadata = places.select(F.explode(F.array(F.struct(F.concat(base, F.lit("/0?f=json")).alias("url"), F.lit(200).alias("status"), layer.alias("body")), F.struct(F.concat(base, F.lit("?f=json")).alias("url"), F.lit(200).alias("status"), service.alias("body")))).alias("m")).select("m.*")
    return places, searches.union(metadata)


def crawl(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    from civigrid.plans.crawl import crawled
    from civigrid.sources.requests import recorded

    places, answers = recorded_answers(spark, sf_dir)
    return crawled(places, recorded(answers))


#: Candidates of a run over recorded answers: ``v`` is 0 for the layer's address, 2 for the service's, 3 for a malformed one.
CRAWL_SQL = """p AS (SELECT s_suppkey AS k, s_suppkey % 13 = 4 AND s_suppkey % 5 <> 0 AS failed FROM supplier),
s AS (SELECT k, q, failed FROM p, range(6) r(q) WHERE k % 5 <> 0 AND (k + q) % 4 <> 0 AND NOT (k % 17 = 5 AND q = 1)),
c AS (SELECT DISTINCT k, v, failed, k % 23 = 7 AND v < 3 AS odd, k % 3 = 0 OR v = 3 AS rejected FROM s, (VALUES (0), (2), (3)) u(v) WHERE v = 0 OR (v = 2 AND k % 7 <> 1) OR (v = 3 AND k % 19 = 6))"""


@query(f"""WITH {CRAWL_SQL} SELECT lpad(p.k::VARCHAR, 7, '0') AS place_fips, count(c.k) AS n_candidates, count(*) FILTER (NOT odd) AS n_inspected, count(*) FILTER (NOT odd AND NOT rejected) AS n_valid, count(*) FILTER (NOT odd AND rejected) AS n_rejected,
 count(DISTINCT CASE WHEN NOT odd AND NOT rejected THEN c.k END) AS n_groups, count(DISTINCT CASE WHEN NOT odd AND NOT rejected THEN c.k END) AS n_chosen, CASE WHEN p.failed THEN 'url.trim is not a function' END AS error
FROM p LEFT JOIN c ON c.k = p.k AND NOT c.failed GROUP BY p.k, p.failed""")
def q_discovery_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crawl(spark, sf_dir)["results"].select("place_fips", "n_candidates", "n_inspected", "n_valid", "n_rejected", "n_groups", "n_chosen", "error")


@query(f"""WITH {CRAWL_SQL}, t(q, t) AS (VALUES (0, 'council districts'), (1, 'city council'), (2, 'wards'), (3, 'ward boundaries'), (4, 'council district boundaries'), (5, 'municipal districts')),
r AS (SELECT 'https://www.arcgis.com/sharing/rest/search?q=%22City' || k::VARCHAR || '%22+AZ+' || replace(t, ' ', '+') || '&num=50&start=1&f=json' AS url, CASE WHEN k % 5 = 0 THEN 'no recorded answer' WHEN k % 17 = 5 AND q = 1 THEN 'status 500' END AS error FROM p, t
UNION SELECT CASE WHEN v = 3 THEN 'https://[bad/FeatureServer/0?f=json' ELSE 'https://gis.tucsonaz.gov/rest/services/P' || k::VARCHAR || CASE v WHEN 0 THEN '/FeatureServer/0?f=json' ELSE '/FeatureServer?f=json' END END, CASE WHEN v = 3 THEN 'no recorded answer' END FROM c)
SELECT url, error FROM r""")
def q_discovery_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    from civigrid.plans.crawl import gathered
    from civigrid.sources.requests import recorded

    places, answers = recorded_answers(spark, sf_dir)
    return gathered(places, recorded(answers))["requests"].select("url", "error")


# Addresses with what a URL parser makes of them, as keys of a look-up and of a layer.
ADDRESSES = [
    ("HTTPS://Ex.com:443/a/../b/", "https://ex.com/b", "https://ex.com/b"),
    ("http://ex.com/a b/C", "http://ex.com/a%20b/c", "http://ex.com/a%20b/C"),
    ("http://münchen.de/Straße", "http://xn--mnchen-3ya.de/stra%c3%9fe", "http://xn--mnchen-3ya.de/Stra%C3%9Fe"),
    ("https://ex.com?x=1#y", "https://ex.com", "https://ex.com"),
    ("http://ex.com/./x/%2e%2E/y?q#f", "http://ex.com/y", "http://ex.com/y"),
    ("  https://ex.com/A// ", "https://ex.com/a", "https://ex.com/A/"),
    ("http:\\\\ex.com\\a", "http://ex.com/a", "http://ex.com/a"),
    ("ftp://u:p@ex.com:21/x", "ftp://u:p@ex.com/x", "ftp://u:p@ex.com/x"),
    ("http://ex.com:8080/a/..", "http://ex.com:8080", "http://ex.com:8080"),
    ("http://ex.com:99999/A", "http://ex.com:99999/a", "http ex com 99999 a"),
    ("http://EX%41.com/", "http://exa.com", "http://exa.com"),
    ("https://[::1]:443/x", "https://[::1]/x", "https://[::1]/x"),
    ("http:ex.com/x", "http://ex.com/x", "http://ex.com/x"),
    ("http://ex.com/../..", "http://ex.com", "http://ex.com"),
    ("http://a b/X", "http://a b/x", "http a b x"),
    ("No Address", "no address", "no address"),
    ("http://faß.de/a", "http://xn--fa-hia.de/a", "http://xn--fa-hia.de/a"),
    ("http://☕.example/", "http://xn--53h.example", "http://xn--53h.example"),
    ("http://127.1/X", "http://127.0.0.1/x", "http://127.0.0.1/X"),
    ("http://0x7f.0.0.1", "http://127.0.0.1", "http://127.0.0.1"),
    ("http://[::0:1]/", "http://[::1]", "http://[::1]"),
    ("http://[1:0:0:2:0:0:0:3]", "http://[1:0:0:2::3]", "http://[1:0:0:2::3]"),
    ("http://a:b@c@ex.com/", "http://a:b%40c@ex.com", "http://a:b%40c@ex.com"),
    ("http://xn--/a", "http://xn--/a", "http xn a"),
    ("http://256.1/a", "http://256.1/a", "http 256 1 a"),
    ("https://日本.jp/地図", "https://xn--wgv71a.jp/%e5%9c%b0%e5%9b%b3", "https://xn--wgv71a.jp/%E5%9C%B0%E5%9B%B3"),
]


@query(f"SELECT p_partkey AS id, {', '.join(f'{C.pick_sql([x[i] for x in ADDRESSES], "p_partkey")} AS {name}' for i, name in ((1, 'lookup_key'), (2, 'layer_key')))} FROM part")
def q_url_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    from civigrid.functions import urls as U

    rows = dealt(C.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), C.pick([x[0] for x in ADDRESSES], F.col("p_partkey")).alias("url")))
    return rows.select("id", U.lookup_key(F.col("url")).alias("lookup_key"), U.layer_key(F.col("url")).alias("layer_key"))


# Texts and whether a date parser takes them for a date.
DATES = [("2026-01-02T03:04:05.678Z", True), ("2026-01-02", True), ("2026-01", True), ("2026", True), ("2026-02-30", True), ("2026-13-01", False), ("2026-01-32", False), ("2026-01-02 03:04:05", True), ("2026-01-02T25:00Z", False), ("2026-01-02T03:04:05+02:00", True), ("Jan 2, 2026", True), ("2 January 2026 10:00 GMT", True), ("Fri, 02 Jan 2026 03:04:05 GMT", True), ("1/2/2026", True), ("2026/1/2", True), ("never", False), ("", False), (None, False), ("2026-01-02T24:00:00Z", True)]
DATES += [("2026-1-2", True), ("Jan 2026", True), ("12/25/1995 10:00 PM", True), ("12/25/1995 13:00 PM", False), ("Tue Mar 01 2022 00:00:00 GMT+0100 (CET)", True), ("2026-01-02T03:04:05z", True), ("1", True), ("13", False), ("32", True), ("12.25.1995", True), ("Dec 25, 1995 13:30 PST", True)]
DATES += [("2026 hello", False), ("hello 2026", True), ("hello2026", False), ("2026-01-02T3:04", False), ("1 2 3 4", False), ("1/2/3 10:00 GMT-12345", False), ("Dec 25, 1995)", False), ("2026-01-02 24:01", False), ("12:30:15 1/2/2026", True)]


@query(f"SELECT p_partkey AS id, {C.pick_sql([str(ok).lower() for _, ok in DATES], 'p_partkey')}::BOOLEAN AS is_date FROM part")
def q_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), T.is_date(C.pick([x for x, _ in DATES], F.col("p_partkey"))).alias("is_date"))


# Written and read again, with their order.

PLACES_COLUMNS = ["placeFips", "city", "state", "placeName", "placeType", "latitude", "longitude"]


@query(f"""WITH {C.GAZETTEER_SQL}, p AS (SELECT geoid, trim(regexp_replace(trim(name), '(?i)\\s+(city|town|village|borough|municipality|township)$', '')) AS city, upper(usps) AS state, trim(name) AS name, {PLACE_TYPE_SQL} AS kind, latitude::DOUBLE AS latitude, longitude::DOUBLE AS longitude, ord FROM gazetteer WHERE {PLACE_TYPE_SQL} = 'incorporated-place')
SELECT row_number() OVER (ORDER BY state, lower(strip_accents(city)), ord) - 1 AS ord, geoid AS "placeFips", city, state, name AS "placeName", kind AS "placeType", latitude, longitude FROM p""")
def q_places_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    from civigrid.operators import places as P
    from civigrid.sources.gazetteer import read_places, write_places

    path = new_path(spark, "places")
    write_places(P.places(C.gazetteer(spark, sf_dir)), path, "gazetteer", 2025)
    return read_places(spark, path).select(F.col("ord").cast("long").alias("ord"), *PLACES_COLUMNS)


@query(f"""WITH RECURSIVE {CHOSEN}, e AS (SELECT place_fips, 'City ' || (ord // 20)::VARCHAR AS city, district_type, url FROM chosen)
SELECT row_number() OVER (ORDER BY 'AZ', lower(city), place_fips) - 1 AS pos, place_fips AS "placeFips", city, district_type AS "districtType", url FROM e""")
def q_registry_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    from civigrid.operators import selection as L
    from civigrid.registered import members
    from civigrid.sources.documents import read_generated, write_registry

    path = new_path(spark, "registry")
    places = C.layer_rows(spark, sf_dir).select("place_fips", "city", "state").distinct()
    write_registry(R.built(places, L.place_sources(L.group_sources(members(spark, sf_dir))), "2026-01-01T00:00:00.000Z"), path)
    return read_generated(spark, path).select(F.col("pos").cast("long").alias("pos"), "placeFips", "city", "districtType", F.col("source.url").alias("url"))


@query("SELECT p_partkey AS id, CASE WHEN p_partkey * 997 < 1024 THEN (p_partkey * 997)::VARCHAR || ' B' WHEN p_partkey * 997 < 1048576 THEN printf('%.1f KB', floor(p_partkey * 997 / 1024.0 * 10 + 0.5) / 10) ELSE printf('%.1f MB', floor(p_partkey * 997 / 1048576.0 * 10 + 0.5) / 10) END AS size FROM part")
def q_format_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), T.byte_size(F.col("p_partkey") * 997).alias("size"))


QUERIES: dict[str, Callable] = {k: v for k, v in _OTHERS.items() if k not in _before}
SQL: dict[str, str] = {k: v for k, v in _OTHER_SQL.items() if k not in _before}

