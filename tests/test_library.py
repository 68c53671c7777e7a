"""Goldens for the library's operators, and the registered queries against their SQL."""

import json
import os
import zipfile

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from civigrid import cli, registered
from civigrid.functions import text as T
from civigrid.functions import urls as U
from civigrid.operators import geo as G
from civigrid.operators import geojson as J
from civigrid.operators import places as P
from civigrid.operators import registry as R
from civigrid.operators import scoring as S
from civigrid.operators import selection as L
from civigrid.operators import similarity as M
from civigrid.operators.classify import classified
from civigrid.operators.fields import detected, inspected

SF = "/root/testdata/sf0.001"


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    ("f", "given", "wanted"),
    [
        (T.words_text, " City_Council--Wards  ", "city council wards"),
        (T.words_text, None, ""),
        (T.title_text, "Wards (2022): O'Fallon", "wards 2022 o fallon"),
        (T.field_key, "WARD_No.", "wardno"),
        (T.identity_key, "--", None),
        (T.place_key, "Cañon  City/West", "canon city west"),
        (T.census_key, "St. Paul’s-Town", "st pauls town"),
        (T.state_code, " arizona ", "AZ"),
        (T.state_code, "zz", "ZZ"),
        (T.without_place_suffix, "Carson City city", "Carson City"),
        (T.coordinate, " ", 0.0),
        (T.coordinate, "", None),
        (T.coordinate, " +33.5 ", 33.5),
        (T.coordinate, "0x10", 16.0),
        (T.coordinate, "1e999", None),
        (T.coordinate, "NaN", None),
        (U.lookup_key, "HTTPS://Ex.com/A/B//?x=1#y", "https://ex.com/a/b"),
        (U.layer_key, "https://Ex.com/A/B/?x=1", "https://ex.com/A/B"),
        (U.layer_key, "no url/", "no url"),
        (U.request_key, " https://e.com/a?x=1// ", "https://e.com/a?x=1"),
        (U.service_type, "https://e.com/x/featureserver/0", "FeatureServer"),
        (U.is_layer, "https://e.com/x/FeatureServer/0?x=1", False),
        (U.service_name, "https://e.com/Wards/MapServer/3", "Wards"),
        (U.layer_name, "https://e.com/Wards/MapServer/3", "Layer 3"),
        (U.geometry_type, " ESRIGeometryPolygon ", "esriGeometryPolygon"),
        (U.geometry_type, "blob", "unknown"),
        (U.plain_geometry, "esriGeometryPolygon", "polygon"),
    ],
)
def test_scalar_functions(spark, f, given, wanted):
    assert one(spark, given, f) == wanted


def test_fixed_rounds_the_binary_value(spark):
    assert [one(spark, x, lambda c: T.fixed(c, 2), "double") for x in (0.575, 0.125, 1.005)] == ["0.57", "0.13", "1.00"]


@pytest.mark.parametrize(
    ("title", "flags", "wanted"),
    [
        ("City of Tucson Ward Boundaries", {"is_likely_boundary": True, "is_polygon_layer": True, "has_district_field": True, "has_name_field": True, "is_feature_server": True, "is_official": True}, 100.0),
        ("Section 8 Housing per Ward", {"has_district_field": True, "has_name_field": True, "is_feature_server": True, "is_housing": True}, 20.0),
        ("Tucson Equity Priority Index: Ward 3 Census Block Groups", {"is_feature_server": True, "is_census": True}, 0.0),
        ("Phoenix City Council Districts", {"is_likely_boundary": True, "is_polygon_layer": True, "has_district_field": True, "is_feature_server": True}, 100.0),
    ],
)
def test_early_scores(spark, title, flags, wanted):
    names = ["is_likely_boundary", "is_polygon_layer", "has_district_field", "has_name_field", "is_feature_server", "is_map_server", "is_official", "is_housing", "is_census", "is_thematic"]
    row = spark.createDataFrame([(title, None, *(bool(flags.get(n)) for n in names))], "title string, geometry_type string, " + ", ".join(f"{n} boolean" for n in names))
    assert S.scored_early(row).first().score == wanted


def layer(**more):
    base = {"place_fips": "1", "ord": 0, "url": "https://e.com/W/FeatureServer/0", "candidate_url": None, "source": "arcgis", "title": "Wards", "candidate_title": None, "service_name": "W", "layer_name": "Wards", "description": None, "geometry_type": "esriGeometryPolygon", "service_type": "FeatureServer", "fields": [("WARD", None), ("NAME", None)]}
    return base | more


LAYER = "place_fips string, ord long, url string, candidate_url string, source string, title string, candidate_title string, service_name string, layer_name string, description string, geometry_type string, service_type string, fields array<struct<name:string,alias:string>>"


def layers(spark, *rows):
    names = [x.split()[0] for x in LAYER.split(", ")]
    return classified(detected(spark.createDataFrame([tuple(layer(**r)[n] for n in names) for r in rows], LAYER)))


def test_classification(spark):
    found = {r.title: r for r in layers(spark, {}, {"title": "Properties by ward"}, {"title": "Property ward"}, {"title": "Wardless", "layer_name": "x"}, {"title": "Point wards", "geometry_type": "point"}, {"title": "éward map", "layer_name": None}).collect()}
    assert found["Wards"].political_score == 9 and found["Wards"].district_type == "ward" and found["Wards"].needs_review and not found["Wards"].rejected
    assert list(found["Properties by ward"].match_parcel) == ["property"] and found["Properties by ward"].rejected
    assert list(found["Property ward"].match_parcel) == [] and not found["Property ward"].rejected
    assert found["Wardless"].rejected and found["Point wards"].rejected
    assert found["éward map"].district_type == "ward"


def test_field_words(spark):
    rows = {r.title: r for r in layers(spark, {"title": "a", "layer_name": None, "fields": [("WARD_NO", None)]}, {"title": "b", "layer_name": None, "fields": [("WARDNUM", None)]}).collect()}
    assert rows["a"].district_field == "WARD_NO" and rows["b"].district_field == "WARDNUM"
    assert rows["a"].political_score == rows["b"].political_score + 1


def test_inspection(spark):
    urls = ["https://e.com/Phoenix/FeatureServer/0", "https://e.com/Public/MapServer", "https://example.com/data/wards.geojson", "https://e.com/Lost/MapServer/1"]
    meta = [
        (urls[0], json.dumps({"name": "Phoenix City Council Districts", "geometryType": "esriGeometryPolygon", "fields": [{"name": "OBJECTID"}, {"name": "DISTRICT"}, {"name": "REP_NAME"}], "supportedQueryFormats": "JSON, geoJSON, PBF"})),
        (urls[1], json.dumps({"name": "Public", "description": "d", "layers": [{"id": 0, "name": "Parks"}, {"id": 3, "name": "Council Districts"}]})),
        (urls[1] + "/3", json.dumps({"name": "Council_Districts", "geometryType": "esriGeometryPolygon", "fields": [{"name": "DISTRICT"}], "capabilities": "Map,Query"})),
    ]
    rows = {r.k: r for r in inspected(spark.createDataFrame(enumerate(urls), "k int, url string"), spark.createDataFrame(meta, "url string, body string")).collect()}
    assert rows[0].is_service and rows[0].service_type == "FeatureServer" and rows[0].supports_geojson and list(rows[0].district_fields) == ["DISTRICT"] and list(rows[0].name_fields) == ["REP_NAME"]
    assert rows[1].url == urls[1] + "/3" and rows[1].service_name == "Public" and rows[1].description == "d" and rows[1].supports_query and rows[1].is_layer
    assert not rows[2].is_service and rows[2].service_type == "unknown"
    assert rows[3].is_service and rows[3].is_layer and rows[3].title is None


def test_greedy_grouping_depends_on_order(spark):
    rows = [{"ord": 0, "layer_name": "Wards A"}, {"ord": 1, "layer_name": "Wards B", "service_name": "V", "title": "ward"}, {"ord": 2, "layer_name": "Wards A"}]
    found = {r.ord: r for r in M.grouped_sources(layers(spark, *rows)).collect()}
    assert found[0].group_id == 0 and found[2].group_id == 0 and found[2].member_score == 1.0
    assert list(found[0].member_reasons) == ["initial candidate"]


def test_layer_deduplication_takes_the_best_member(spark):
    rows = [{"ord": 0, "url": "https://e.com/a"}, {"ord": 1, "url": "https://e.com/b", "fields": [("COUNCIL", None)], "title": "Other ward names entirely", "layer_name": "x", "service_name": "y"}, {"ord": 2, "url": "https://e.com/b/?q=1"}]
    found = {r.ord: r for r in M.grouped_layers(layers(spark, *rows)).collect()}
    assert found[1].group_id == 1 and found[2].group_id == 0 and found[2].member_score == 1.0  # the earlier of two equally confident members


def test_grouped_layers_against_plain_loops(spark):
    import random

    random.seed(5)
    rows = [{"ord": i, "place_fips": str(i % 2), "url": f"https://e.com/{random.randint(0, 6)}", "title": random.choice(["Wards of Tucson", "Tucson wards map", "Ward lines"]), "service_name": random.choice(["A", "B"]), "layer_name": random.choice(["Wards", "Ward"]), "fields": random.choice([[("WARD", None)], [("WARD", None), ("NAME", None)], [("DISTRICT", None)]])} for i in range(24)]
    given = layers(spark, *rows).cache()
    prints = given.select("place_fips", "ord", M.layer_print().alias("p"))
    similar = {(r.x, r.y): (r.equivalent, r.confidence) for r in M.pairs(prints).select(F.col("a.ord").alias("x"), F.col("b.ord").alias("y"), M.layer_similarity(F.col("a.p"), F.col("b.p")).alias("s")).select("x", "y", "s.equivalent", "s.confidence").collect()}
    groups: dict[str, list[list[int]]] = {"0": [], "1": []}
    for i in range(24):
        best, home = 0.0, None
        for g in groups[str(i % 2)]:
            for m in g:
                ok, c = similar[i, m]
                if ok and c > best:
                    best, home = c, g
        if home is None:
            groups[str(i % 2)].append([i])
        else:
            home.append(i)
    wanted = {i: g[0] for gs in groups.values() for g in gs for i in g}
    assert {r.ord: r.group_id for r in M.grouped_layers(given).collect()} == wanted
    assert len(set(wanted.values())) < 24


def test_point_in_polygon_borders(spark):
    shape = [[[[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0], [0.0, 0.0]], [[1.0, 1.0], [2.0, 1.0], [2.0, 2.0], [1.0, 2.0], [1.0, 1.0]]]]
    f = spark.createDataFrame([(0, 0, shape, "a")], f"entry_pos int, feature_pos int, coordinates {G.MULTI}, name string")
    cases = {(0.5, 0.5): True, (1.5, 1.5): False, (1.0, 1.5): True, (0.0, 2.0): True, (4.0, 4.0): True, (4.0, 2.0): True, (4.1, 2.0): False, (2.0, 200.0): False}
    pts = spark.createDataFrame([(i, lat, lon) for i, (lon, lat) in enumerate(cases)], "point_id int, lat double, lon double")
    got = {r.point_id: r.found for r in G.located(pts, f).collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values())
    with pytest.raises(ValueError, match="Latitude"):
        G.check_point(91, 0)


def test_property_types(spark):
    row = spark.sql("""SELECT parse_json('{"a": 5, "b": " x ", "c": true, "d": {"z": 1}, "e": "", "Ward_No": 2.0}') AS v""")
    got = row.select(*(J.value_text(J.get_property(F.col("v"), F.lit(k))).alias(k) for k in ("a", "b", "c", "d", "e", "wardno"))).first()
    assert tuple(got) == ("5", "x", "true", None, None, "2")


def test_gazetteer_round_trip(spark, tmp_path):
    from civigrid.sources import gazetteer

    text = "usps |GEOID|NAME|LSAD|INTPTLAT|INTPTLONG\r\n\r\naz|0477000|Tucson city|25|32.1| \nAZ|0400001|Nowhere CDP|57|1|2\n"
    with zipfile.ZipFile(tmp_path / "g.zip", "w") as z:
        z.writestr("readme.md", "x")
        z.writestr("G.TXT", text)
    gazetteer.generate_places(spark, str(tmp_path / "g.zip"), str(tmp_path / "out"))
    rows = gazetteer.read_places(spark, str(tmp_path / "out"), validate=False).collect()
    assert [(r.placeFips, r.city, r.state, r.latitude, r.longitude) for r in rows] == [("0477000", "Tucson", "AZ", 32.1, 0.0)]
    assert gazetteer.read_places(spark, str(tmp_path / "out"), validate=True).columns == ["placeFips", "city", "state", "stateFips", "placeName", "placeType"]
    with pytest.raises(ValueError, match="LSAD"):
        P.column_index(["GEOID", "NAME", "USPS"])
    bad = spark.createDataFrame([("1", "x", "az", " ")], "GEOID string, NAME string, USPS string, LSAD string")
    with pytest.raises(Exception, match="required value"):
        P.places(bad).collect()


def test_recorded_sources(spark, tmp_path):
    from civigrid.sources import recorded

    recorded.register(spark)
    recorded.record(str(tmp_path), "q1", json.dumps({"total": 1, "results": [{"title": "a", "url": "u"}, {"title": "b"}]}))
    recorded.record(str(tmp_path), "q2", "[]")
    answers = spark.read.format("catalog_search").option("asked", json.dumps(["q1", "q2", "q3"])).option("recorded", str(tmp_path)).load()
    assert [(r.query, r.pos, r.title) for r in recorded.hits(answers).orderBy("pos").collect()] == [("q1", 0, "a"), ("q1", 1, "b")]
    assert recorded.hits_asked(500) == 100 and recorded.hits_asked(None) == 50


def test_registry_documents(spark, tmp_path):
    from civigrid.sources import documents

    entry = {"placeFips": "0477000", "city": "Tucson", "state": "AZ", "districtType": "ward", "source": {"url": "https://e.com/x", "serviceType": "FeatureServer", "title": "COT_wards", "official": False}, "fields": {"district": "WARD", "name": "NAME"}, "metadata": {"generatedAt": "2026-01-01T00:00:00.000Z", "generatorVersion": "0.1.0", "alternatives": [], "requiresReview": True}}
    path = tmp_path / "r.json"
    path.write_text(json.dumps({"version": "0.1.0", "generatedAt": "2026-01-01T00:00:00.000Z", "entries": [entry]}))
    with pytest.raises(ValueError, match="missing boundaryType"):
        documents.read_package(spark, str(path))
    entries = documents.read_generated(spark, str(path))
    documents.write_registry(entries.drop("pos"), str(tmp_path / "again"))
    assert documents.read_generated(spark, str(tmp_path / "again")).count() == 1
    package = R.as_package(entries, {"ward": "city-council-district"}).first()
    assert package.boundaryType == "city-council-district" and package.source.fieldMapping.district == "WARD"
    assert cli.main(["validate", str(path)]) == 0 and cli.main(["inspect"]) == 1 and cli.main(["validate", "--nope"]) == 1


def test_boundaries_pass_over_bad_files(spark, tmp_path):
    from civigrid.plans.lookup import lookup_one
    from civigrid.sources.documents import read_boundaries

    os.makedirs(tmp_path / "b/0477000")
    good = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"WARD": 3, "NAME": None}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]]}}]}
    (tmp_path / "b/0477000/ward.geojson").write_text(json.dumps(good))
    (tmp_path / "b/0477000/other.geojson").write_text("{")
    entries = spark.createDataFrame([(0, "0477000", "Tucson", "AZ", "ward", (("WARD", "NAME"),))], "pos long, placeFips string, city string, state string, boundaryType string, source struct<fieldMapping:struct<district:string,name:string>>")
    shapes = read_boundaries(spark, str(tmp_path / "b"))
    assert lookup_one(spark, 1, 1, entries, shapes)["district"] == {"id": "0477000-ward-3", "district": "3", "name": "3", "city": "Tucson", "state": "AZ", "place_fips": "0477000", "boundary_type": "ward"}
    assert lookup_one(spark, 5, 5, entries, shapes, city="tucson")["district"] is None


def test_discovery_takes_every_supplier(spark, tmp_path):
    keys = [*range(1, 46), 1007]
    spark.createDataFrame([(k,) for k in keys], "s_suppkey long").write.parquet(str(tmp_path / "supplier.parquet"))
    failed = {k for k in keys if k % 11 == 3}
    asked = {k: next(q for q in range(6) if (k + q) % 4) for k in keys if k % 5 and k not in failed}  # the first search with an answer
    wanted = {(f"{k:07d}", 1000 * q + v, f"https://gis.tucsonaz.gov/rest/services/P{k}/FeatureServer/0", k % 3 == 0) for k, q in asked.items() for v in (0, 2) if v == 0 or k % 7 != 1}
    got = [(r.place_fips, r.ord, r.url, r.rejected) for r in registered.queries()["q_inspect"](spark, str(tmp_path)).collect()]
    assert len(got) == len(wanted) and set(got) == wanted
    total = registered.queries()["q_discovery_summary"](spark, str(tmp_path)).first()
    assert (total.municipalities, total.candidates, total.inspected, total.failed) == (len(keys), len(wanted), len(wanted), len(failed))
    assert total.rejected == sum(x[3] for x in wanted) and total.valid == sum(not x[3] for x in wanted)
    assert total.canonical == sum(k % 3 > 0 for k in asked) and total.no_canonical == len(keys) - len(failed) - total.canonical


def test_a_place_without_hits_has_not_failed(spark):
    from civigrid.plans.discovery import discovered, summary

    places = spark.createDataFrame([("0000001", "Nowhere", "AZ"), ("0000002", "Broken", "AZ"), ("0000003", "Odd", "AZ")], "place_fips string, city string, state string")
    hits = spark.createDataFrame([], "query string, pos int, title string, url string")
    bodies = spark.createDataFrame([], "url string, body string")
    failures = spark.createDataFrame([("0000002", "fetch failed"), ("0000003", None)], "place_fips string, error string")
    results = discovered(places, hits, bodies, failures)["results"]
    assert {r.place_fips: r.error for r in results.collect()} == {"0000001": None, "0000002": "fetch failed", "0000003": "undefined"}
    total = summary(results).first()
    assert (total.municipalities, total.failed, total.no_canonical, total.canonical) == (3, 2, 1, 0)
    assert summary(discovered(places, hits, bodies)["results"]).first().failed == 0


def test_download(tmp_path):
    import functools
    import http.server
    import threading

    from civigrid.sources.gazetteer import download

    (tmp_path / "a.zip").write_bytes(b"PK")
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), functools.partial(http.server.SimpleHTTPRequestHandler, directory=str(tmp_path)))
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    assert download(f"{base}/a.zip") == b"PK"
    with pytest.raises(RuntimeError, match="404"):
        download(f"{base}/none.zip")
    server.shutdown()


def test_property_names_keep_their_order(spark):
    from civigrid.operators.geojson import detected_fields
    from civigrid.sources.documents import exploded, feature_collections

    text = '{"type":"FeatureCollection","features":[{"properties":{"zz_ward_x":1,"a_district_y":2}},{"properties":null}]}'
    docs = spark.createDataFrame([("k", text), ("none", "{"), ("other", "[]")], "place_fips string, value string")
    got = detected_fields(exploded(feature_collections(docs)), ["place_fips"]).collect()
    assert [(r.place_fips, r.district_property, r.name_property) for r in got] == [("k", "zz_ward_x", None)]


def comparable(df: pd.DataFrame) -> list[str]:
    def plain(x):
        if isinstance(x, (list, tuple)):
            return str(x)
        if pd.isna(x):
            return None
        return float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) or type(x).__name__.startswith(("int", "float", "Int")) else str(x)

    return sorted(repr([plain(x) for x in r]) for r in df[sorted(df.columns)].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    got, wanted = registered.queries()[name](spark, SF).toPandas(), con.sql(registered.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(wanted.columns)
    assert comparable(got) == comparable(wanted)


def test_rows_are_dealt_by_their_number(spark, monkeypatch):
    from civigrid.operators import staging

    monkeypatch.setattr(staging, "ROWS_OF_A_TASK", 50)
    rows = spark.range(0, 201, 1, 1)
    assert staging.dealt(rows).rdd.getNumPartitions() == 5
    assert sorted(r[0] for r in staging.dealt(rows, "id").collect()) == list(range(201))
    assert staging.dealt(spark.range(0)).count() == 0
    found = registered.fresh_layers(spark, SF)
    assert found.rdd.getNumPartitions() == -(-found.count() // 50)


def test_texts_are_worked_out_once(spark):
    found = registered.QUERIES["q_score_canonical"](spark, SF)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") < 20


@pytest.mark.parametrize(("f", "given", "wanted"), [(T.words_text, "\u00a0_A-\u2003b\ufeff-", "a b"), (T.title_text, "_\u00c9t\u00e9\u2003(2)\u00b2--", "\u00e9t\u00e9 2 \u00b2"), (T.collapsed, "\u2003 a\t\u00a0b ", "a b")])
def test_white_space_of_any_kind(spark, f, given, wanted):
    assert one(spark, given, f) == wanted


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def counted(df):
    """``df`` with its true size known, so that a join would broadcast it."""
    df.cache().count()
    return df


def test_sources_are_grouped_where_their_place_was_dealt(spark):
    rows = [{"ord": 0}, {"ord": 1, "service_name": "x", "layer_name": "y", "fields": [("COUNCIL", None)]}, {"ord": 2}, {"ord": 3, "place_fips": "b"}]
    found = M.grouped_sources(counted(layers(spark, *rows)))
    assert "Broadcast" not in plan_of(found) and "ENSURE_REQUIREMENTS" not in plan_of(found)
    got = {r.ord: (r.group_id, r.member_score, list(r.member_reasons)) for r in found.collect()}
    assert got[0] == (0, None, ["initial candidate"]) and got[1] == (1, None, ["initial candidate"]) and got[3] == (3, None, ["initial candidate"])
    assert got[2][:2] == (0, 1.0) and "same service name" in got[2][2]


def test_pairs_are_not_broadcast(spark):
    given = counted(spark.createDataFrame([("a", 0), ("a", 1), ("a", 2), ("b", 3)], "place_fips string, ord int"))

    def met(**options):
        return M.pairs(given, **options).select(F.col("a.ord"), F.col("b.ord"))

    assert "Broadcast" not in plan_of(met())
    assert sorted(map(tuple, met().collect())) == [(1, 0), (2, 0), (2, 1)]
    assert sorted(map(tuple, met(own=True).collect())) == [(0, 0), (1, 0), (1, 1), (2, 0), (2, 1), (2, 2), (3, 3)]


def test_layers_are_deduplicated_where_their_place_was_dealt(spark, monkeypatch):
    from civigrid.operators import staging

    monkeypatch.setattr(staging, "ROWS_OF_A_TASK", 2)
    rows = [{"ord": 0, "url": "https://e.com/a"}, {"ord": 1, "url": "https://e.com/a/"}, {"ord": 2, "url": "https://e.com/c", "place_fips": "b"}]
    found = M.grouped_layers(counted(layers(spark, *rows)))
    assert "Broadcast" not in plan_of(found) and "ENSURE_REQUIREMENTS" not in plan_of(found)
    got = {r.ord: (r.group_id, r.member_score, list(r.member_reasons)) for r in found.collect()}
    assert got == {0: (0, None, ["initial candidate group"]), 1: (0, 1.0, ["same ArcGIS layer URL"]), 2: (2, None, ["initial candidate group"])}


def members_of(spark, *rows):
    return layers(spark, *rows).withColumns({"city": F.lit("Tucson"), "state": F.lit("AZ"), "service_type": F.lit("FeatureServer"), "requires_review": F.lit(False), "supports_query": F.lit(True), "supports_geojson": F.lit(True), "supports_pagination": F.lit(True)})


def test_a_groups_alternatives_need_no_join(spark):
    given = members_of(spark, {"ord": 0, "url": "https://e.com/b"}, {"ord": 1, "url": "https://e.com/a"}, {"ord": 2, "url": "https://e.com/c"}, {"ord": 3, "place_fips": "b"})
    found = L.group_sources(given.withColumn("group_id", F.when(F.col("ord") < 3, 0).otherwise(3)))
    assert "Join" not in plan_of(found)
    assert {r.ord: [a.url for a in r.alternatives] for r in found.collect()} == {1: ["https://e.com/b", "https://e.com/c"], 3: []}


def test_places_are_not_broadcast_to_their_sources(spark):
    sources = counted(L.place_sources(L.group_sources(members_of(spark, {"ord": 0}, {"ord": 1, "place_fips": "b"}).withColumn("group_id", F.col("ord")))))
    found = R.built(counted(spark.createDataFrame([("b", "Tucson", "AZ"), ("c", "Mesa", "AZ")], "place_fips string, city string, state string")), sources, "2026-01-01T00:00:00.000Z")
    assert "Broadcast" not in plan_of(found)
    assert [(r.placeFips, r.city) for r in found.collect()] == [("b", "Tucson")]
