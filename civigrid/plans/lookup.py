"""Look-up of districts by coordinates: registry filter, boundaries, point in polygon, district."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civigrid.operators.geo import check_point, located
from civigrid.operators.geojson import districts
from civigrid.operators.registry import matching
from civigrid.sources.documents import read_boundaries

#: Places and types of entries that may filter the boundaries' scan; beyond them the join alone decides.
FEW = 1000


def lookup(points: DataFrame, entries: DataFrame, boundaries: DataFrame, **options) -> DataFrame:
    """``points`` (point_id, lat, lon) with found and the district that holds each.

    Entries are filtered before any boundary is read. Where few are left, their places and types filter the boundaries'
    scan, so a table of ``write_boundary_store`` is read only where they are. Entries without boundaries and features that
    are no polygons are passed over; the first entry in the registry's order wins, then the first feature.
    """
    wanted = matching(entries, **options)
    shapes = boundaries.where(F.col("geometry_type").isin("Polygon", "MultiPolygon"))
    few = wanted_boundaries(wanted)
    if few is not None:
        places, kinds = sorted({p for p, _ in few}), sorted({k for _, k in few})
        shapes = shapes.where(F.col("place_fips").isin(places) & F.col("boundary_type").isin(kinds))
        if "region" in boundaries.columns:
            shapes = shapes.where(F.col("region").isin(sorted({p[:2] for p in places})))
    joined = shapes.join(wanted, (shapes.place_fips == wanted.placeFips) & (shapes.boundary_type == wanted.boundaryType))
    named = districts(joined).select(F.col("pos").alias("entry_pos"), "feature_pos", "coordinates", "id", "district", "name", "city", "state", F.col("placeFips").alias("place_fips"), F.col("boundaryType").alias("boundary_type"))
    return located(points, named)


def wanted_boundaries(wanted: DataFrame) -> list[tuple[str, str]] | None:
    """The places and types of some entries; None where they are too many for a filter."""
    found = wanted.select("placeFips", "boundaryType").where("placeFips IS NOT NULL AND boundaryType IS NOT NULL").distinct().limit(FEW + 1).collect()
    return [tuple(r) for r in found] if len(found) <= FEW else None


def lookup_files(spark: SparkSession, points: DataFrame, entries: DataFrame, folder: str, **options) -> DataFrame:
    """``lookup`` in a folder of GeoJSON files, of which only the wanted entries' are opened."""
    wanted = wanted_boundaries(matching(entries, **options))
    return lookup(points, entries, read_boundaries(spark, folder, wanted), **options)


def lookup_one(spark: SparkSession, lat: float, lon: float, entries: DataFrame, boundaries: DataFrame, **options) -> dict:
    """One point: found, district (or None) and coordinates; a coordinate out of range is an error before anything is read."""
    check_point(lat, lon)
    point = spark.createDataFrame([(0, float(lat), float(lon))], "point_id int, lat double, lon double")
    row = lookup(point, entries, boundaries, **options).first()
    names = ("id", "district", "name", "city", "state", "place_fips", "boundary_type")
    return {"found": row.found, "district": {n: row[n] for n in names} if row.found else None, "coordinates": {"latitude": lat, "longitude": lon}}
