"""The queries over the library's own operators and their SQL, by name.

Inputs are made of the general tables (``carriers``); outputs are flat, arrays joined with commas or bars.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civigrid import carriers as C
from civigrid.functions import text as T
from civigrid.functions import urls as U
from civigrid.operators import classify as K
from civigrid.operators import fields as D
from civigrid.operators import places as P
from civigrid.operators import registry as R
from civigrid.operators import scoring as S
from civigrid.operators import selection as L
from civigrid.operators import similarity as M
from civigrid.operators.staging import dealt, staged

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def bars(c: str | Column) -> Column:
    return F.array_join(c, "|")


def bars_sql(items: list[str]) -> str:
    return f"array_to_string(list_filter([{', '.join(items)}], lambda x: x IS NOT NULL), '|')"


# Places.

PLACE_TYPE_SQL = f"CASE WHEN upper(trim(lsad)) IN ({', '.join(map(C.quoted, P.INCORPORATED))}) THEN 'incorporated-place' ELSE 'census-designated-place' END"
CENSUS_SQL = r"trim(regexp_replace(replace(regexp_replace(lower(strip_accents({})), '[.''’]', '', 'g'), '-', ' '), '\s+', ' ', 'g'))"
REGISTRY_NAME_SQL = r"trim(regexp_replace(regexp_replace(replace(regexp_replace(lower(strip_accents({})), '[''’]', '', 'g'), '-', ' '), '[^\p{{L}}\p{{N}}\s]', ' ', 'g'), '\s+', ' ', 'g'))"
STATE_SQL = "coalesce((MAP {{{}}})[upper(trim({}))], upper(trim({})))"


def state_sql(x: str) -> str:
    return STATE_SQL.format(", ".join(f"{C.quoted(n)}: {C.quoted(c)}" for c, n in T.STATES.items()), x, x)


@query(f"WITH {C.GAZETTEER_SQL} SELECT geoid AS place_fips, trim(regexp_replace(trim(name), '(?i)\\s+(city|town|village|borough|municipality|township)$', '')) AS city, upper(usps) AS state, trim(name) AS place_name, {PLACE_TYPE_SQL} AS place_type, latitude::DOUBLE AS latitude, longitude::DOUBLE AS longitude FROM gazetteer WHERE {PLACE_TYPE_SQL} = 'incorporated-place'")
def q_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.sorted_places(P.places(C.gazetteer(spark, sf_dir))).select("place_fips", "city", "state", "place_name", "place_type", "latitude", "longitude")


@query(f"WITH {C.PLACES_SQL} SELECT place_fips, city, state FROM places WHERE {CENSUS_SQL.format('city')} = 'canon city' AND {state_sql('state')} = 'AZ' ORDER BY ord LIMIT 1")
def q_place_city_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.first(P.with_city_state(C.place_rows(spark, sf_dir), "CANON city", "arizona")).select("place_fips", "city", "state")


@query(f"WITH {C.PLACES_SQL} SELECT place_fips, city, state, {CENSUS_SQL.format('city')} AS key FROM places WHERE {CENSUS_SQL.format('city')} = 'st paul'")
def q_place_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.with_name(C.place_rows(spark, sf_dir), "st paul").select("place_fips", "city", "state", T.census_key(F.col("city")).alias("key"))


@query(f"WITH {C.PLACES_SQL} SELECT place_fips, city, state FROM places WHERE place_fips = '0000007'")
def q_place_fips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.first(P.with_fips(C.place_rows(spark, sf_dir), "0000007")).select("place_fips", "city", "state")


@query(f"WITH {C.PLACES_SQL} SELECT place_fips, city, {state_sql('state')} AS code FROM places WHERE {state_sql('state')} = 'NY'")
def q_place_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.in_state(C.place_rows(spark, sf_dir), "New York").select("place_fips", "city", T.state_code(F.col("state")).alias("code"))


@query(f"WITH {C.PLACES_SQL} SELECT place_fips, city, state FROM places WHERE lower(trim(city)) = 'mesa town' AND upper(state) = 'ARIZONA'")
def q_places_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.chosen(C.place_rows(spark, sf_dir), city=" MESA town", state="arizona").select("place_fips", "city", "state")


@query(f"WITH {C.PLACES_SQL} SELECT place_fips, {REGISTRY_NAME_SQL.format('city')} AS key, {state_sql('state')} AS code FROM places")
def q_normalize_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.place_rows(spark, sf_dir).select("place_fips", T.place_key(F.col("city")).alias("key"), T.state_code(F.col("state")).alias("code"))


# Text and addresses.

@query(f"SELECT doc_id, {C.normal_sql('text')} AS words, {C.title_sql('text')} AS title, {C.key_sql('text')} AS key FROM documents")
def q_normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("text")
    return C.table(spark, sf_dir, "documents").select("doc_id", T.words_text(c).alias("words"), T.title_text(c).alias("title"), T.field_key(c).alias("key"))


NO_TAIL = "regexp_replace(regexp_replace(url, '[?#].*$', ''), '^([A-Za-z]+://[^/?#]+)$', '\\1/')"
HOST_LOW = f"lower(regexp_extract({NO_TAIL}, '^([A-Za-z]+://[^/]+)', 1)) || regexp_extract({NO_TAIL}, '^[A-Za-z]+://[^/]+(.*)$', 1)"


@query(f"WITH {C.URLS_SQL} SELECT id, lower(regexp_replace({HOST_LOW}, '/+$', '')) AS lookup_key, regexp_replace({HOST_LOW}, '/$', '') AS layer_key, regexp_replace(trim(url), '/+$', '') AS request_key FROM urls")
def q_url_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    return C.urls_of(spark, sf_dir).select("id", U.lookup_key(u).alias("lookup_key"), U.layer_key(u).alias("layer_key"), U.request_key(u).alias("request_key"))


@query(f"""WITH {C.URLS_SQL}, r AS (SELECT id, url, CASE WHEN regexp_matches(url, '(?i)/(FeatureServer|MapServer)/[0-9]+$') THEN regexp_replace(url, '/[0-9]+$', '') ELSE url END AS root FROM urls)
SELECT id, CASE lower(regexp_extract(url, '(?i)/(FeatureServer|MapServer)(?:/|$)', 1)) WHEN 'featureserver' THEN 'FeatureServer' WHEN 'mapserver' THEN 'MapServer' ELSE 'unknown' END AS service_type,
 regexp_matches(url, '(?i)/(FeatureServer|MapServer)/[0-9]+$') AS is_layer, root, nullif(regexp_extract(root, '(?i)/([^/]+)/(?:FeatureServer|MapServer)$', 1), '') AS service_name,
 CASE WHEN regexp_matches(url, '(?i)/(FeatureServer|MapServer)/[0-9]+$') THEN 'Layer ' || regexp_extract(url, '/([0-9]+)$', 1) END AS layer_name, url || CASE WHEN contains(url, '?') THEN '&f=json' ELSE '?f=json' END AS metadata_url, regexp_matches(url, '(?i)^https?://[^/?#\\s]+') AS is_http FROM r""")
def q_service_url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    return C.urls_of(spark, sf_dir).select("id", U.service_type(u).alias("service_type"), U.is_layer(u).alias("is_layer"), U.service_root(u).alias("root"), U.service_name(u).alias("service_name"), U.layer_name(u).alias("layer_name"), U.metadata_url(u).alias("metadata_url"), U.is_http(u).alias("is_http"))


@query(f"""WITH {C.PLACES_SQL} SELECT place_fips, query_no::INT AS query_no, '"' || city || '" ' || state || ' ' || ([{', '.join(map(C.quoted, ["council districts", "city council", "wards", "ward boundaries", "council district boundaries", "municipal districts"]))}])[query_no + 1] AS query FROM places, range(6) t(query_no)""")
def q_query_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from civigrid.plans.discovery import search_texts

    return search_texts(C.place_rows(spark, sf_dir)).select("place_fips", "query_no", "query")


@query(f"""WITH {C.URLS_SQL}, h AS (SELECT lpad((id % 20)::VARCHAR, 7, '0') AS place_fips, id AS ord, url, 'search query: ' || (id % 6)::VARCHAR AS reason, lower(regexp_replace({HOST_LOW}, '/+$', '')) AS key FROM urls),
d AS (SELECT place_fips, key, reason, min(ord) AS first FROM h GROUP BY ALL)
SELECT place_fips, min(first) AS ord, arg_min(u, first) AS url, array_to_string(list(reason ORDER BY first), '|') AS reasons FROM (SELECT d.*, h.url AS u FROM d JOIN h ON h.ord = d.first AND h.place_fips = d.place_fips) GROUP BY place_fips, key""")
def q_url_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from civigrid.plans.discovery import distinct_urls

    hits = C.urls_of(spark, sf_dir).select(F.lpad((F.col("id") % 20).cast("string"), 7, "0").alias("place_fips"), F.col("id").alias("ord"), "url", F.array(F.concat(F.lit("search query: "), (F.col("id") % 6).cast("string"))).alias("candidate_reasons"))
    return distinct_urls(hits).select("place_fips", "ord", "url", bars("candidate_reasons").alias("reasons"))


# Fields and layers of a service.

NAME, ALIAS = C.normal_sql("name"), C.normal_sql("alias")
DISTRICT_POINTS = C.points_sql([(C.any_sql(NAME, D.WARD_TERMS), 60), (C.any_sql(NAME, D.COUNCIL_FIELDS), 70), (C.any_sql(NAME, D.DISTRICT_TERMS), 50), (C.any_sql(ALIAS, D.DISTRICT_ALIASES), 30)])
NAME_POINTS = C.points_sql([(C.any_sql(NAME, D.NAME_FIELDS), 70), (C.any_sql(ALIAS, D.NAME_ALIASES), 60), (f"ends_with({NAME}, 'name')", 30), (f"({ALIAS} = 'name' OR ends_with({ALIAS}, ' name'))", 20)])
DETECTED = f"""{C.FIELDS_SQL}, field_points AS (SELECT field_set, pos, name, alias, {DISTRICT_POINTS} AS ds, {NAME_POINTS} AS ns FROM field_rows),
detected AS (SELECT field_set, coalesce(list(name ORDER BY ds DESC, pos) FILTER (ds > 0), []) AS district_fields, coalesce(list(name ORDER BY ns DESC, pos) FILTER (ns > 0), []) AS name_fields, list(name ORDER BY pos) AS names, list(alias ORDER BY pos) FILTER (alias IS NOT NULL) AS aliases FROM field_points GROUP BY field_set)"""


@query(f"WITH {C.LAYERS_SQL}, {DETECTED} SELECT ord, coalesce(array_to_string(district_fields, '|'), '') AS district_fields, coalesce(array_to_string(name_fields, '|'), '') AS name_fields, district_fields[1] AS district_field, name_fields[1] AS name_field FROM layers LEFT JOIN detected USING (field_set)")
def q_field_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.detected(C.layer_rows(spark, sf_dir)).select("ord", bars("district_fields").alias("district_fields"), bars("name_fields").alias("name_fields"), "district_field", "name_field")


LAYER_NAME = C.normal_sql("layer_name")
LAYER_POINTS = C.points_sql([(C.any_sql(LAYER_NAME, D.WARD_TERMS), 50), (C.any_sql(LAYER_NAME, D.LAYER_COUNCIL), 60), (C.any_sql(LAYER_NAME, D.DISTRICT_TERMS), 35), (C.any_sql(LAYER_NAME, D.LAYER_BOUNDARY), 30), (C.any_sql(LAYER_NAME, D.LAYER_OTHER), -50)])


@query(f"WITH {C.LAYERS_SQL} SELECT place_fips, ord, layer_name AS name, points AS layer_score FROM (SELECT *, {LAYER_POINTS} AS points, row_number() OVER (PARTITION BY place_fips ORDER BY {LAYER_POINTS} DESC, ord) AS n FROM layers) WHERE n = 1")
def q_layer_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.layer_rows(spark, sf_dir).select("place_fips", "ord", F.col("layer_name").alias("name"), F.col("ord").alias("pos"))
    return D.best_layers(rows, ["place_fips"]).select("place_fips", "ord", "name", "layer_score")


@query("""SELECT p_partkey AS id, CASE WHEN p_partkey % 4 = 0 THEN p_partkey % 8 = 0 ELSE contains(lower(CASE p_partkey % 3 WHEN 0 THEN 'Map,Query,Data' WHEN 1 THEN 'Map' ELSE '' END), 'query') END AS supports_query,
list_contains(list_transform(string_split(CASE p_partkey % 5 WHEN 0 THEN 'JSON, geoJSON, PBF' WHEN 1 THEN 'JSON' ELSE '' END, ','), lambda x: lower(trim(x))), 'geojson') AS supports_geojson, CASE WHEN p_partkey % 6 = 0 THEN true WHEN p_partkey % 6 = 1 THEN false END AS supports_pagination,
CASE WHEN p_partkey % 9 = 0 THEN NULL WHEN p_partkey % 9 = 1 THEN 'polygon' WHEN p_partkey % 9 = 2 THEN 'esriGeometryPoint' ELSE 'unknown' END AS geometry_type FROM part""")
def q_capabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    rows = C.table(spark, sf_dir, "part").select(
        k.alias("id"),
        F.when(k % 4 == 0, k % 8 == 0).alias("supportsQuery"),
        C.pick(["Map,Query,Data", "Map", None], k).alias("capabilities"),
        C.pick(["JSON, geoJSON, PBF", "JSON", None, "", "x"], k).alias("supportedQueryFormats"),
        F.when(k % 6 == 0, True).alias("supportsPagination"),
        F.struct(F.when(k % 6 == 1, False).alias("supportsPagination")).alias("advancedQueryCapabilities"),
        C.pick([None, " Polygon", "ESRIGEOMETRYPOINT", "x", "x", "x", "x", "x", "x"], k).alias("g"),
    )
    return D.capabilities(rows).select("id", "supports_query", "supports_geojson", "supports_pagination", U.geometry_type(F.col("g")).alias("geometry_type"))


# Classification.

def one_of(text: str, patterns: dict[str, str]) -> str:
    return f"regexp_matches({text}, '(?i)\\b(?:{'|'.join(patterns.values())})\\b')"


def labels_sql(text: str, patterns: dict[str, str]) -> str:
    return bars_sql([f"CASE WHEN {one_of(text, {k: p})} THEN {C.quoted(k)} END" for k, p in patterns.items()])


def texts_sql(parts: list[str]) -> str:
    return f"array_to_string(list_filter([{', '.join(parts)}], lambda x: x <> ''), ' ')"


IDENTITY = [C.normal_sql(c) for c in ("title", "service_name", "layer_name")]
FIELD_TEXT = f"array_to_string(list_filter(list_transform(list_concat(coalesce(names, []), coalesce(aliases, [])), lambda f: {C.normal_sql('f')}), lambda x: x <> ''), ' ')"
OFFICIAL = "(source = 'municipal' OR " + " OR ".join(f"contains(lower(url), {C.quoted(h)})" for h in K.OFFICIAL_HOSTS) + ")"
POLYGON = "coalesce(geometry_type IN ('esriGeometryPolygon', 'polygon'), false)"
POLITICAL_FIELD = f"len(list_filter(coalesce(district_fields, []), lambda f: regexp_matches({C.normal_sql('f')}, '\\b(ward|district|council)\\b|\\balderman'))) > 0"
CLASSIFIED = f"""{C.LAYERS_SQL}, {DETECTED},
t AS (SELECT l.*, coalesce(district_fields, []) AS district_fields, coalesce(name_fields, []) AS name_fields, coalesce(names, []) AS names, district_fields[1] AS district_field, name_fields[1] AS name_field,
  {texts_sql([*IDENTITY, C.normal_sql('description'), FIELD_TEXT])} AS a, {texts_sql(IDENTITY)} AS i, {OFFICIAL} AS official_source, {POLYGON} AS is_polygon, {POLITICAL_FIELD} AS pf FROM layers l LEFT JOIN detected USING (field_set)),
m AS (SELECT *, {labels_sql('a', K.THEMATIC)} AS thematic, {labels_sql('a', K.CENSUS)} AS census, {labels_sql('a', K.PARCEL)} AS parcel, {labels_sql('a', K.HOUSING)} AS housing, {labels_sql('a', K.POLITICAL)} AS political,
  CASE {' '.join(f"WHEN {one_of('i', p)} THEN {C.quoted(n)}" for n, p in K.FAMILIES)} END AS district_type FROM t),
s AS (SELECT *, {' + '.join(f"CASE WHEN {one_of('i', p)} THEN 5 ELSE 0 END" for _, p in K.FAMILIES)} + CASE WHEN is_polygon THEN 2 ELSE 0 END + CASE WHEN pf THEN 1 ELSE 0 END + CASE WHEN len(name_fields) > 0 THEN 1 ELSE 0 END
  + CASE WHEN official_source THEN 1 ELSE 0 END - CASE WHEN census <> '' THEN 5 ELSE 0 END - CASE WHEN parcel <> '' THEN 5 ELSE 0 END - CASE WHEN housing <> '' THEN 2 ELSE 0 END - CASE WHEN thematic <> '' THEN 2 ELSE 0 END AS political_score FROM m),
b AS (SELECT *, is_polygon AND political_score >= 6 AND (pf OR district_type IS NOT NULL) AS is_political FROM s),
classified AS (SELECT *, thematic <> '' AND NOT is_political AS is_thematic, NOT is_political OR census <> '' OR parcel <> '' AS rejected,
  is_political AND (political_score < 8 OR NOT official_source OR district_field IS NULL OR district_type IS NULL) AS needs_review FROM b)"""


def fresh_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.classified(D.detected(C.layer_rows(spark, sf_dir)))


def layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(fresh_layers(spark, sf_dir))


@query(f"WITH {CLASSIFIED} SELECT ord, thematic, census, parcel, housing, political, official_source, district_type, political_score::INT AS political_score, is_political, is_thematic, rejected, needs_review FROM classified")
def q_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    matched = [bars(f"match_{c}").alias(c) for c in ("thematic", "census", "parcel", "housing", "political")]
    return fresh_layers(spark, sf_dir).select("ord", *matched, "official_source", "district_type", "political_score", "is_political", "is_thematic", "rejected", "needs_review")


@query(f"WITH {CLASSIFIED} SELECT place_fips, sum(CASE WHEN rejected THEN 0 ELSE 1 END)::BIGINT AS valid, sum(CASE WHEN rejected THEN 1 ELSE 0 END)::BIGINT AS rejected FROM classified GROUP BY place_fips")
def q_valid_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, rejected = K.split_rejected(layers(spark, sf_dir))
    both = valid.select("place_fips", F.lit(1).alias("v"), F.lit(0).alias("r")).unionAll(rejected.select("place_fips", F.lit(0).alias("v"), F.lit(1).alias("r")))
    return both.groupBy("place_fips").agg(F.sum("v").alias("valid"), F.sum("r").alias("rejected"))


# Scores.

SOURCE_RULES = [("official_source", 100, "'official municipal source'"), ("is_political", 100, "'appears to represent a political boundary'"), ("is_political", 40, "'boundary layer'"), ("district_type IS NOT NULL", 40, "'identified as ' || district_type"), ("is_polygon", 30, "'polygon geometry'"), ("district_field IS NOT NULL", 25, "'district field: ' || district_field"), ("name_field IS NOT NULL", 10, "'name field: ' || name_field"), ("service_type = 'FeatureServer'", 10, "'FeatureServer'"), ("supports_query", 5, "'supports querying'"), ("supports_geojson", 5, "'supports GeoJSON'"), ("supports_pagination", 2, "'supports pagination'"), ("is_thematic", -100, "'thematic dataset'"), ("geometry_type IS NOT NULL AND NOT is_polygon", -50, "'non-polygon geometry'")]
SOURCE_POINTS = C.points_sql([(c, w) for c, w, _ in SOURCE_RULES])
SOURCE_REASONS = bars_sql([f"CASE WHEN {c} THEN {r} END" for c, _, r in SOURCE_RULES])
RANK_TITLE = "lower(coalesce(title, layer_name, service_name, ''))"
RANK_RULES = [("official_source", 30), ("is_political", 50), ("is_political", 25), ("is_thematic", -50), ("census <> ''", -50), ("is_polygon", 20), ("NOT is_polygon", -30), ("district_type IS NOT NULL", 20), ("district_field IS NOT NULL", 20), ("name_field IS NOT NULL", 10), ("supports_query", 5), ("supports_geojson", 5), ("supports_pagination", 3), ("service_type = 'FeatureServer'", 5), (f"regexp_matches({RANK_TITLE}, '\\b(wards?|council|districts?)\\b')", 15), ("len(list_filter(district_fields, lambda f: regexp_matches(f, '(?i)ward|council|district|alderman'))) > 0", 10)]
SCORED = f"{CLASSIFIED}, scored AS (SELECT *, CASE WHEN rejected THEN '-infinity'::DOUBLE ELSE {SOURCE_POINTS} END AS score, CASE WHEN rejected THEN 'rejected candidate' ELSE {SOURCE_REASONS} END AS reasons, requires_review OR needs_review AS review, {C.points_sql(RANK_RULES)} AS rank_score FROM classified)"


@query(f"WITH {SCORED} SELECT ord, CASE WHEN rejected THEN NULL ELSE score END AS score, reasons FROM scored")
def q_score_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.scored_sources(fresh_layers(spark, sf_dir)).select("ord", F.when(F.col("score") > float("-inf"), F.col("score")).alias("score"), bars("reasons").alias("reasons"))


@query(f"WITH {SCORED} SELECT ord, rank_score AS score FROM scored")
def q_score_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.scored_ranks(fresh_layers(spark, sf_dir)).select("ord", "score")


EARLY_TITLE = C.normal_sql("title")
EARLY = [("ord % 2 = 0", 25), ("ord % 3 = 0", 20), ("ord % 4 < 2", 20), ("ord % 5 = 0", 10), ("service_type = 'FeatureServer'", 10), ("service_type = 'MapServer'", 5), ("source = 'municipal'", 20), (C.any_sql(EARLY_TITLE, ["ward"]), 20), (C.any_sql(EARLY_TITLE, ["council district", "city council"]), 25), (C.any_sql(EARLY_TITLE, ["boundary", "boundaries"]), 15), (C.any_sql(EARLY_TITLE, ["municipal", "city of"]), 5), (f"ord % 11 = 0 OR {C.any_sql(EARLY_TITLE, ['housing', 'section 8'])}", -40), (f"ord % 13 = 0 OR {C.any_sql(EARLY_TITLE, ['census block', 'block group', 'tract', 'census geography', 'census data'])}", -45), ("ord % 7 = 0", -35), (C.any_sql(EARLY_TITLE, ["equity", "index", "priority", "demographic", "population", "income"]), -20), ("ord % 3 <> 0 AND contains(lower(coalesce(geometry_type, '')), 'polygon')", 15)]


@query(f"WITH {C.LAYERS_SQL} SELECT ord, greatest(0.0, least(100.0, {C.points_sql(EARLY)}))::DOUBLE AS score FROM layers")
def q_score_early(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("ord")
    flags = {"is_likely_boundary": k % 2 == 0, "is_polygon_layer": k % 3 == 0, "has_district_field": k % 4 < 2, "has_name_field": k % 5 == 0, "is_feature_server": F.col("service_type") == "FeatureServer", "is_map_server": F.col("service_type") == "MapServer", "is_official": F.col("source") == "municipal", "is_housing": k % 11 == 0, "is_census": k % 13 == 0, "is_thematic": k % 7 == 0}
    return S.scored_early(C.layer_rows(spark, sf_dir).withColumns(flags)).select("ord", "score")


@query(f"WITH {SCORED} SELECT place_fips, ord, n::INT AS place_rank FROM (SELECT *, row_number() OVER (PARTITION BY place_fips ORDER BY score DESC, lower(coalesce(title, candidate_title, '')), ord) AS n FROM scored) WHERE n <= 5")
def q_rank_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.top(fresh_layers(spark, sf_dir), 5).select("place_fips", "ord", "place_rank")


# Similarity and groups.

def keys_sql(names: str) -> str:
    return f"list_sort(list_filter(list_transform({names}, lambda f: {C.key_sql('f')}), lambda x: x <> ''))"


def jaccard_sql(a: str, b: str) -> str:
    return f"(CASE WHEN len({a}) > 0 AND len({b}) > 0 THEN len(list_intersect({a}, {b}))::DOUBLE / len(list_distinct(list_concat({a}, {b}))) ELSE 0.0 END)"


def steps_sql(value: str, steps: list[tuple[float, float]]) -> str:
    return "(CASE " + " ".join(f"WHEN {value} >= {least!r} THEN {points!r}" for least, points in steps) + " ELSE 0.0 END)::DOUBLE"


def source_similarity_sql(a: str, b: str) -> str:
    same = " + ".join(f"CASE WHEN {a}.{k} = {b}.{k} THEN {w!r}::DOUBLE ELSE 0.0::DOUBLE END" for k, w in (("service", 0.25), ("layer", 0.2), ("geometry", 0.15)))
    ratio = {k: jaccard_sql(f"{a}.{k}", f"{b}.{k}") for k in ("districts", "names", "fields")}
    return f"least(1.0::DOUBLE, {same} + {steps_sql(ratio['districts'], [(1.0, 0.25), (0.5, 0.15)])} + {steps_sql(ratio['names'], [(1.0, 0.1), (0.5, 0.05)])} + {steps_sql(ratio['fields'], [(0.8, 0.1)])})"


PRINTS = f"""{SCORED}, eligible AS (SELECT *, row_number() OVER (PARTITION BY place_fips ORDER BY ord) AS n, struct_pack(service := nullif({C.key_sql('service_name')}, ''), layer := nullif({C.key_sql('layer_name')}, ''), geometry := geometry_type,
  districts := {keys_sql('district_fields')}, names := {keys_sql('name_fields')}, fields := {keys_sql('names')}) AS p FROM scored WHERE is_political AND district_type IS NOT NULL AND is_polygon)"""


@query(f"WITH {PRINTS} SELECT ord, p.service AS service, p.layer AS layer, p.geometry AS geometry, array_to_string(p.districts, '|') AS districts, array_to_string(p.names, '|') AS names, array_to_string(p.fields, '|') AS fields FROM eligible")
def q_fingerprint_equiv(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = layers(spark, sf_dir).where(M.eligible()).withColumn("p", M.source_print())
    return p.select("ord", *(F.col(f"p.{c}").alias(c) for c in ("service", "layer", "geometry")), *(bars(F.col(f"p.{c}")).alias(c) for c in ("districts", "names", "fields")))


@query(f"WITH {PRINTS} SELECT a.ord AS x, b.ord AS y, round({source_similarity_sql('a.p', 'b.p')}, 9) AS score FROM eligible a JOIN eligible b ON a.place_fips = b.place_fips AND a.ord > b.ord")
def q_pair_similarity_equiv(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = dealt(layers(spark, sf_dir).where(M.eligible()), "place_fips").select("place_fips", "ord", M.source_print().alias("p"))
    return M.pairs(p).select(F.col("a.ord").alias("x"), F.col("b.ord").alias("y"), F.round(M.source_similarity(F.col("a.p"), F.col("b.p"))["score"], 9).alias("score"))


IDLE = ", ".join(map(C.quoted, M.IDLE_WORDS))


def named_sql(terms: list[str]) -> str:
    keys = sorted({t.replace("_", "") for t in terms})
    return f"coalesce(list({C.key_sql('name')} ORDER BY {C.key_sql('name')}) FILTER ({C.any_sql(C.key_sql('name'), keys)} OR {C.any_sql(C.key_sql('alias'), keys)}), [])"


GEOMETRY_SQL = "CASE geometry_type " + " ".join(f"WHEN {C.quoted(g)} THEN {C.quoted(g.removeprefix('esriGeometry').lower())}" for g in U.GEOMETRIES) + " END"
LAYER_PRINTS = f"""{SCORED}, terms AS (SELECT field_set, {named_sql(M.DISTRICT_TERMS)} AS d, {named_sql(M.NAME_TERMS)} AS nm FROM field_rows GROUP BY field_set),
lp AS (SELECT place_fips, ord, rejected, is_political, struct_pack(url := regexp_replace(lower(regexp_extract(url, '^([a-z]+://[^/]+)', 1)) || regexp_extract(url, '^[a-z]+://[^/]+(.*)$', 1), '/$', ''), type := district_type, geometry := {GEOMETRY_SQL}, service := nullif({C.title_sql('service_name')}, ''), layer := nullif({C.title_sql('layer_name')}, ''),
  words := list_distinct(list_filter(string_split({C.title_sql('coalesce(title, candidate_title)')}, ' '), lambda w: length(w) > 1 AND w NOT IN ({IDLE}))), districts := coalesce(d, []), names := coalesce(nm, []), fields := {keys_sql('names')}) AS p FROM scored LEFT JOIN terms USING (field_set))"""


@query(f"WITH {LAYER_PRINTS} SELECT ord, p.url AS url, p.type AS type, p.geometry AS geometry, p.service AS service, p.layer AS layer, array_to_string(list_sort(p.words), '|') AS words, array_to_string(p.districts, '|') AS districts, array_to_string(p.names, '|') AS names FROM lp")
def q_fingerprint_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = layers(spark, sf_dir).select("ord", M.layer_print().alias("p"))
    return p.select("ord", *(F.col(f"p.{c}").alias(c) for c in ("url", "type", "geometry", "service", "layer")), bars(F.array_sort("p.words")).alias("words"), *(bars(F.col(f"p.{c}")).alias(c) for c in ("districts", "names")))


RATIOS = {k: jaccard_sql(f"a.p.{k}", f"b.p.{k}") for k in ("words", "districts", "fields")}
LAYER_TOTAL = (
    "0.2::DOUBLE + CASE WHEN a.p.geometry IS NULL OR b.p.geometry IS NULL OR a.p.geometry = b.p.geometry THEN 0.15::DOUBLE ELSE 0.0 END + CASE WHEN a.p.service = b.p.service THEN 0.2::DOUBLE ELSE 0.0 END + CASE WHEN a.p.layer = b.p.layer THEN 0.15::DOUBLE ELSE 0.0 END + "
    f"{steps_sql(RATIOS['words'], [(0.75, 0.2), (0.5, 0.15), (0.3, 0.05)])} + (CASE WHEN {RATIOS['districts']} >= 0.75 THEN 0.2 WHEN {RATIOS['districts']} > 0 THEN 0.1 ELSE 0.0 END)::DOUBLE + {steps_sql(RATIOS['fields'], [(0.75, 0.1), (0.5, 0.05)])}"
)
LAYER_PAIRS = f"""{LAYER_PRINTS}, pr AS (SELECT a.place_fips, a.ord AS x, b.ord AS y, coalesce(a.p.url = b.p.url, false) AS same_url, coalesce(a.p.type = b.p.type, false) AS same_type, {LAYER_TOTAL} AS total FROM lp a JOIN lp b ON a.place_fips = b.place_fips AND a.ord > b.ord WHERE a.is_political AND NOT a.rejected AND b.is_political AND NOT b.rejected),
lpairs AS (SELECT place_fips, x, y, same_url OR (same_type AND total >= 0.7) AS equivalent, CASE WHEN same_url THEN 1.0 WHEN same_type THEN least(total, 1.0) ELSE 0.0 END AS confidence FROM pr)"""


@query(f"WITH {LAYER_PAIRS} SELECT x, y, equivalent, round(confidence, 9)::DOUBLE AS confidence FROM lpairs")
def q_pair_similarity_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = dealt(layers(spark, sf_dir).where(M.deduplicable()), "place_fips").select("place_fips", "ord", M.layer_print().alias("p"))
    s = M.pairs(p).select(F.col("a.ord").alias("x"), F.col("b.ord").alias("y"), M.layer_similarity(F.col("a.p"), F.col("b.p")).alias("s"))
    return s.select("x", "y", "s.equivalent", F.round("s.confidence", 9).alias("confidence"))


MEMBERS = f"""{PRINTS}, walk AS (SELECT place_fips, n, [struct_pack(ord := ord, p := p)] AS heads, ord, ord AS group_id FROM eligible WHERE n = 1
UNION ALL SELECT place_fips, n, CASE WHEN hit IS NULL THEN list_append(heads, x) ELSE heads END, x.ord, coalesce(hit.ord, x.ord) FROM (
  SELECT w.place_fips, e.n, w.heads, struct_pack(ord := e.ord, p := e.p) AS x, list_filter(w.heads, lambda h: {source_similarity_sql('e.p', 'h.p')} >= 0.6)[1] AS hit FROM walk w JOIN eligible e ON e.place_fips = w.place_fips AND e.n = w.n + 1)),
members AS (SELECT e.*, w.group_id FROM eligible e JOIN walk w ON e.place_fips = w.place_fips AND e.ord = w.ord)"""


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(M.grouped_sources(layers(spark, sf_dir)))


@query(f"WITH RECURSIVE {MEMBERS} SELECT place_fips, ord, group_id FROM members")
def q_cluster_equiv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return members(spark, sf_dir).select("place_fips", "ord", "group_id")


@query(f"WITH RECURSIVE {MEMBERS} SELECT place_fips, group_id, count(*) AS members, 1.0::DOUBLE AS confidence FROM members GROUP BY place_fips, group_id")
def q_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.groups(members(spark, sf_dir)).select("place_fips", "group_id", "members", "confidence")


DEDUPED = f"""{LAYER_PAIRS}, near AS (SELECT x, list(struct_pack(y := y, c := confidence)) AS ns FROM lpairs WHERE equivalent GROUP BY x),
valid AS (SELECT place_fips, ord, row_number() OVER (PARTITION BY place_fips ORDER BY ord) AS n, coalesce(ns, []) AS ns FROM lp LEFT JOIN near ON x = ord WHERE is_political AND NOT rejected),
walk AS (SELECT place_fips, n, ord, ord AS g, NULL::DOUBLE AS s, NULL::BIGINT AS y, [struct_pack(m := ord, g := ord)] AS homes FROM valid WHERE n = 1
UNION ALL SELECT place_fips, n, ord, coalesce(best.g, ord), -best.c, best.y, list_append(homes, struct_pack(m := ord, g := coalesce(best.g, ord))) FROM (
  SELECT w.place_fips, v.n, v.ord, w.homes, list_min(list_transform(v.ns, lambda q: struct_pack(c := -q.c, g := list_filter(w.homes, lambda h: h.m = q.y)[1].g, y := q.y))) AS best FROM walk w JOIN valid v ON v.place_fips = w.place_fips AND v.n = w.n + 1))"""


@query(f"WITH RECURSIVE {DEDUPED} SELECT place_fips, ord, g AS group_id, round(s, 9) AS member_score FROM walk")
def q_cluster_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.deduplicated_layers(layers(spark, sf_dir)).select("place_fips", "ord", "group_id", F.round("member_score", 9).alias("member_score"))


def hundredths_sql(k: str) -> str:
    """A ratio of two list lengths with two decimals, halves up, in whole numbers."""
    both, either = f"len(list_intersect(a.p.{k}, b.p.{k}))", f"greatest(1, len(list_distinct(list_concat(a.p.{k}, b.p.{k}))))"
    h = f"((200 * {both} + {either}) // (2 * {either}))"
    return f"' (' || ({h} // 100)::VARCHAR || '.' || lpad(({h} % 100)::VARCHAR, 2, '0') || ')'"


def stepped_sql(k: str, steps: list[tuple[float, str]]) -> str:
    return "CASE " + " ".join(f"WHEN {RATIOS[k]} {'>' if least == 0 else '>='} {least!r} THEN {C.quoted(text)} || {hundredths_sql(k)}" for least, text in steps) + " END"


REASONS = [
    "'same political district type'",
    "CASE WHEN a.p.geometry IS NULL OR b.p.geometry IS NULL OR a.p.geometry = b.p.geometry THEN 'same geometry type' END",
    "CASE WHEN a.p.service = b.p.service THEN 'same ArcGIS service' END",
    "CASE WHEN a.p.layer = b.p.layer THEN 'same ArcGIS layer name' END",
    stepped_sql("words", [(0.75, "highly similar layer titles"), (0.5, "similar layer titles"), (0.3, "partially similar layer titles")]),
    stepped_sql("districts", [(0.75, "strong district-field similarity"), (0, "partial district-field similarity")]),
    stepped_sql("fields", [(0.75, "highly similar field structure"), (0.5, "similar field structure")]),
]


@query(f"""WITH RECURSIVE {DEDUPED} SELECT w.place_fips, w.ord, CASE WHEN w.y IS NULL THEN 'initial candidate group' WHEN a.p.url = b.p.url THEN 'same ArcGIS layer URL' ELSE {bars_sql(REASONS)} END AS reasons
FROM walk w JOIN lp a ON a.ord = w.ord LEFT JOIN lp b ON b.ord = w.y""")
def q_dedupe_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.deduplicated_layers(layers(spark, sf_dir)).select("place_fips", "ord", bars("member_reasons").alias("reasons"))


# Choice.

PREFERENCE = "score DESC, review, NOT official_source, service_type <> 'FeatureServer', url COLLATE NOCASE, ord"
SOURCES = f"""{MEMBERS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY place_fips, group_id ORDER BY {PREFERENCE}) AS r FROM members),
alternatives AS (SELECT place_fips, group_id, array_to_string(list(url ORDER BY r) FILTER (r > 1 AND score > '-infinity'::DOUBLE), '|') AS alternatives FROM ranked GROUP BY place_fips, group_id),
sources AS (SELECT place_fips, group_id, ord, url, coalesce(title, layer_name, service_name, 'Municipal district layer') AS title, district_type, service_type, official_source, district_field, name_field, score, review, reasons, coalesce(alternatives, '') AS alternatives
  FROM ranked JOIN alternatives USING (place_fips, group_id) WHERE r = 1 AND score > '-infinity'::DOUBLE AND district_field IS NOT NULL AND district_type IS NOT NULL)"""
CHOSEN = f"{SOURCES}, chosen AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY place_fips ORDER BY {PREFERENCE}) AS place_rank FROM sources) WHERE place_rank = 1)"


@query(f"WITH RECURSIVE {SOURCES} SELECT place_fips, group_id, ord, url, title, district_type, district_field, name_field, score, review AS requires_review, alternatives FROM sources")
def q_canonical_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = L.group_sources(members(spark, sf_dir))
    return found.select("place_fips", "group_id", "ord", "url", "title", "district_type", "district_field", "name_field", "score", "requires_review", bars(F.transform("alternatives", lambda a: a["url"])).alias("alternatives"))


@query(f"WITH RECURSIVE {CHOSEN} SELECT place_fips, ord, url, title, district_type, service_type, score, reasons AS selection_reasons, review AS requires_review FROM chosen")
def q_canonical_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = L.place_sources(L.group_sources(members(spark, sf_dir)))
    return found.select("place_fips", "ord", "url", "title", "district_type", "service_type", "score", bars("selection_reasons").alias("selection_reasons"), "requires_review")


@query(f"WITH RECURSIVE {MEMBERS}, r AS (SELECT *, row_number() OVER w AS r, lead(rank_score) OVER w AS second FROM members WINDOW w AS (PARTITION BY place_fips, group_id ORDER BY rank_score DESC, ord)) SELECT place_fips, group_id, ord, rank_score AS score, rank_score - coalesce(second, 0.0) AS score_gap, rank_score - coalesce(second, 0.0) < 10 AS requires_review FROM r WHERE r = 1 AND district_field IS NOT NULL")
def q_score_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.ranked_sources(members(spark, sf_dir)).select("place_fips", "group_id", "ord", "score", "score_gap", "requires_review")


@query(f"WITH RECURSIVE {CHOSEN} SELECT place_fips AS \"placeFips\", 'City ' || (ord // 20)::VARCHAR AS city, 'AZ' AS state, district_type AS \"districtType\", url, service_type AS \"serviceType\", title, official_source AS official, district_field AS district, name_field AS name, review AS \"requiresReview\" FROM chosen")
def q_registry_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = C.layer_rows(spark, sf_dir).select("place_fips", "city", "state").distinct()
    entries = R.ordered(R.built(places, L.place_sources(L.group_sources(members(spark, sf_dir))), "2026-01-01T00:00:00.000Z"))
    return entries.select("placeFips", "city", "state", "districtType", "source.url", "source.serviceType", "source.title", "source.official", "fields.district", "fields.name", "metadata.requiresReview")


def queries() -> dict[str, Query]:
    from civigrid import registered_geo

    return QUERIES | registered_geo.QUERIES


def oracle_sql() -> dict[str, str]:
    from civigrid import registered_geo

    return SQL | registered_geo.SQL
