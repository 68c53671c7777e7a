"""Documents as one file, registries read once, and boundaries of which only the wanted ones are read."""

import json
import os
import re

import pytest
from pyspark.sql import functions as F

from civigrid.operators.geojson import POLYGONS
from civigrid.operators.registry import ordered
from civigrid.plans.lookup import lookup, lookup_files, lookup_one
from civigrid.sources import documents, gazetteer
from civigrid.sources.catalogue import Catalogue

ENTRY = "placeFips string, city string, state string, districtType string, source struct<url:string,serviceType:string,title:string,official:boolean>, fields struct<district:string,name:string>, metadata struct<generatedAt:string,requiresReview:boolean>"


def entries(spark, n):
    return spark.range(n).select(F.lpad(F.col("id").cast("string"), 7, "0").alias("placeFips"), F.concat(F.lit("Ort, \"é\"\n"), F.col("id").cast("string")).alias("city"), F.lit("AZ").alias("state"), F.lit("ward").alias("districtType"), F.struct(F.lit("u").alias("url")).alias("source")).repartition(5)


@pytest.mark.parametrize("n", [0, 1, 3000])
def test_a_registry_is_one_file(spark, tmp_path, n):
    path = tmp_path / "registry.json"
    if n == 1:
        path.mkdir()  # what an earlier version left
        (path / "part-0").write_text("{}")
    documents.write_registry(entries(spark, n), str(path))
    doc = json.loads(path.read_text())
    assert list(doc) == ["version", "generatedAt", "entries"] and len(doc["entries"]) == n and re.fullmatch(r"\d{4}-.*Z", doc["generatedAt"])
    assert sorted(e["placeFips"] for e in doc["entries"]) == [f"{i:07d}" for i in range(n)]
    assert [x for x in os.listdir(tmp_path) if not x.startswith(".")] == ["registry.json"]  # no parts are left
    assert [r.placeFips for r in documents.read_generated(spark, str(path)).orderBy("pos").collect()] == [e["placeFips"] for e in doc["entries"]]
    assert [e["placeFips"] for e in doc["entries"]] == [r.placeFips for r in ordered(entries(spark, n)).collect()]


def test_a_broken_write_leaves_the_file(spark, tmp_path):
    path = tmp_path / "registry.json"
    path.write_text("old")
    bad = entries(spark, 10).withColumn("city", F.when(F.col("placeFips") == "0000005", F.raise_error(F.lit("broken"))).otherwise(F.col("city")))
    with pytest.raises(Exception, match="broken"):
        documents.write_registry(bad, str(path))
    assert path.read_text() == "old" and not [x for x in os.listdir(tmp_path) if "parts" in x]


def test_places_are_one_file(spark, tmp_path):
    found = spark.createDataFrame([("0400001", "B", "AZ", "B town", "incorporated-place", "g", "a", "A", 1.5, None, 1), ("0400002", "a", "AZ", "a city", "incorporated-place", "g", "a", "A", None, 2.0, 0)], "place_fips string, city string, state string, place_name string, place_type string, geoid_fq string, ansicode string, funcstat string, latitude double, longitude double, ord long")
    gazetteer.write_places(found, str(tmp_path / "places.json"), "it's \"x\"", 2025)
    doc = json.loads((tmp_path / "places.json").read_text())
    assert doc["source"] == "it's \"x\"" and doc["year"] == 2025 and [p["city"] for p in doc["places"]] == ["a", "B"]
    with pytest.raises(ValueError):
        gazetteer.write_places(found.limit(0), str(tmp_path / "none.json"), "x", 2025)
    assert not (tmp_path / "none.json").exists()


PACKAGE_ENTRY = {"placeFips": "0477000", "city": "Tucson", "state": "AZ", "boundaryType": "ward", "generatedFile": "0477000/ward.geojson", "source": {"sourceType": "arcgis", "url": "https://e.com/a", "title": "t", "official": True, "verified": True, "lastVerified": "2026-01-01", "format": "arcgis", "fieldMapping": {"district": "WARD", "name": "NAME"}}}


def package(*cities):
    return json.dumps({"version": "1", "generatedAt": "2026-01-01T00:00:00.000Z", "entries": [PACKAGE_ENTRY | {"city": c} for c in cities]})


def test_a_registry_is_read_once(spark, tmp_path):
    path = tmp_path / "registry.json"
    path.write_text(package("Tucson"))
    held = Catalogue(spark)
    first = held.package(str(path))
    assert held.package(str(path)) is first and first.first().city == "Tucson"
    assert "InMemoryTableScan" in first._jdf.queryExecution().executedPlan().toString()
    path.write_text(package("Tucson", "Mesa"))
    second = held.package(str(path))
    assert second is not first and second.count() == 2 and held.package(str(path)) is second
    path.write_text("{}")
    with pytest.raises(ValueError):
        held.package(str(path))
    path.write_text(package("Mesa"))
    third = held.package(str(path))
    (tmp_path / "places.json").write_text(json.dumps({"places": [{"placeFips": "1", "city": "Mesa"}]}))
    places = held.places(str(tmp_path / "places.json"))
    assert held.places(str(tmp_path / "places.json")) is places and places.count() == 1
    rows = [kept[1] for kept in held._kept.values()]
    assert all(r.storageLevel.useMemory for r in rows)
    held.release(str(path))
    held.release()
    assert not held._kept and not any(r.storageLevel.useMemory for r in rows) and third.count() == 1


def square(x, y, ward):
    return {"type": "Feature", "properties": {"WARD": ward, "NAME": f"n{ward}"}, "geometry": {"type": "Polygon", "coordinates": [[[x, y], [x + 1, y], [x + 1, y + 1], [x, y + 1], [x, y]]]}}


def boundary_folder(tmp_path, n):
    for i in range(n):
        place = f"{i % 5:02d}{i:05d}"
        os.makedirs(tmp_path / "b" / place, exist_ok=True)
        (tmp_path / "b" / place / "ward.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [square(i, 0, i)]}))
    return str(tmp_path / "b")


def scans(df):
    """What the scans under a plan read, once it has run: its metrics as text."""
    plan = df._jdf.queryExecution().executedPlan()
    todo, out = [plan], []
    while todo:
        p = todo.pop()
        name = p.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(p.plan())
        if name == "FileSourceScanExec":
            at = p.metrics().iterator()
            texts = []
            while at.hasNext():
                kv = at.next()
                texts.append(f"{kv._2().name().get() if kv._2().name().isDefined() else kv._1()}: {kv._2().value()}")
            out.append("; ".join(texts))
        kids = p.children().iterator()
        while kids.hasNext():
            todo.append(kids.next())
    return out


def test_only_wanted_boundaries_are_read(spark, tmp_path):
    folder = boundary_folder(tmp_path, 40)
    registry = spark.createDataFrame([(i, f"{i % 5:02d}{i:05d}", f"City{i}", "AZ", "ward", (("WARD", "NAME"),)) for i in range(41)] + [(50, None, "x", "AZ", None, (("WARD", "NAME"),))], "pos long, placeFips string, city string, state string, boundaryType string, source struct<fieldMapping:struct<district:string,name:string>>")
    points = spark.createDataFrame([(i, 0.5, i + 0.25) for i in range(42)], "point_id int, lat double, lon double")
    want = {i: str(i) if i < 40 else None for i in range(42)}
    assert {r.point_id: r.district for r in lookup_files(spark, points, registry, folder).collect()} == want
    one = lookup_files(spark, points, registry, folder, city="City7")
    assert {r.point_id for r in one.where("found").collect()} == {7}
    few = documents.read_boundaries(spark, folder, [("0200007", "ward"), ("0200007", "none"), ("9999999", "ward")])
    assert few.count() == 1 and documents.read_boundaries(spark, folder, []).count() == 0
    os.rename(tmp_path / "b" / "0300013", tmp_path / "b13")  # entries without a file are passed over
    assert lookup_files(spark, points, registry, folder).where("found").count() == 39

    store = str(tmp_path / "store")
    documents.write_boundary_store(documents.read_boundaries(spark, folder), store)
    table = documents.read_boundary_store(spark, store)
    assert table.where("place_fips = '0200007'").first().region == "02" and table.where(F.col("geometry_type").isin(*POLYGONS)).count() == 39
    assert {r.point_id: r.district for r in lookup(points, registry, table).collect()} == want | {13: None}
    assert lookup_one(spark, 0.5, 7.25, registry, table, city="City7")["district"]["district"] == "7"
    pruned = table.where(F.col("place_fips").isin("0200007") & F.col("boundary_type").isin("ward") & F.col("region").isin("02"))
    pruned.collect()
    read = "; ".join(scans(pruned))
    assert re.search(r"number of files read: 1\b", read) and re.search(r"number of partitions read: 1\b", read), read
    explained = pruned._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in explained and re.search(r"PushedFilters: \[[^\]]*place_fips", explained)
