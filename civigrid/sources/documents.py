"""Registry documents and boundary files: reading and writing."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from civigrid.functions.text import iso_now
from civigrid.operators.geojson import coordinates
from civigrid.operators.registry import VERSION, ordered
from civigrid.operators.validation import document_error, package_entries
from civigrid.sources.onefile import existing, write_document

GENERATED = (
    "version string, generatedAt string, entries array<struct<placeFips:string,city:string,state:string,districtType:string,"
    "source:struct<url:string,serviceType:string,title:string,official:boolean>,fields:struct<district:string,name:string>,"
    "metadata:struct<generatedAt:string,generatorVersion:string,alternatives:array<struct<url:string,title:string,serviceType:string,officialMunicipalSource:boolean,score:double>>,requiresReview:boolean>>>"
)
PACKAGE = (
    "version string, generatedAt string, entries array<struct<placeFips:string,city:string,state:string,boundaryType:string,generatedFile:string,"
    "source:struct<sourceType:string,url:string,title:string,official:boolean,verified:boolean,lastVerified:string,format:string,fieldMapping:struct<district:string,name:string>>>>"
)


def read_document(spark: SparkSession, path: str, schema: str) -> tuple[str | None, str | None, DataFrame]:
    """version, generatedAt and the entries (with pos) of a registry document; what is no such document is an error."""
    doc = spark.read.schema(schema).json(path, multiLine=True)
    head = doc.select("version", "generatedAt", F.col("entries").isNull().alias("none")).first()
    error = "no document" if head is None else document_error(head.version, head.generatedAt, None if head.none else [])
    if error:
        raise ValueError(f"Invalid municipal registry: {error}")
    return head.version, head.generatedAt, doc.select(F.posexplode("entries").alias("pos", "e")).select("pos", "e.*")


def read_generated(spark: SparkSession, path: str) -> DataFrame:
    return read_document(spark, path, GENERATED)[2]


def package_rows(spark: SparkSession, path: str) -> DataFrame:
    """Entries for look-ups, each with what is wrong with it."""
    return package_entries(read_document(spark, path, PACKAGE)[2])


def read_package(spark: SparkSession, path: str) -> DataFrame:
    """Entries for look-ups; the first invalid one is an error. They are read each time; a ``Catalogue`` keeps them."""
    return without_error(package_rows(spark, path))


def without_error(entries: DataFrame) -> DataFrame:
    bad = entries.where("error IS NOT NULL").orderBy("pos").limit(1).collect()
    if bad:
        raise ValueError(bad[0].error)
    return entries.drop("error")


def write_registry(entries: DataFrame, path: str) -> None:
    """A registry document in its order: one file, which replaces what was there at once."""
    now = entries.sparkSession.range(1).select(iso_now()).first()[0]
    write_document(ordered(entries), F.struct(*entries.columns), f'{{"version":{json.dumps(VERSION)},"generatedAt":{json.dumps(now)},"entries":[', "]}\n", path)


def read_boundaries(spark: SparkSession, folder: str, wanted: list[tuple[str, str]] | None = None) -> DataFrame:
    """Features of ``<folder>/<place>/<type>.geojson``: place_fips, boundary_type, feature_pos, feature_id, properties, geometry_type, coordinates.

    Files that are no JSON or no feature collection are passed over; features that are no polygons have null coordinates.
    With ``wanted`` (places and types) only these files are looked at; those that don't exist have no features.
    """
    paths = [f"{folder}/*/*.geojson"] if wanted is None else existing(spark, [f"{folder}/{place}/{kind}.geojson" for place, kind in wanted])
    if paths:
        raw = spark.read.text(paths, wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))
    else:
        raw = spark.createDataFrame([], "value string, path string")
    doc = raw.select(F.regexp_extract("path", r"/([^/]+)/([^/]+)\.geojson$", 1).alias("place_fips"), F.regexp_extract("path", r"/([^/]+)/([^/]+)\.geojson$", 2).alias("boundary_type"), "value")
    return exploded(feature_collections(doc))


def write_boundary_store(boundaries: DataFrame, folder: str) -> None:
    """Boundaries as a Parquet table that look-ups prune: folders by the state's digits of the place and by type, files sorted by place."""
    keyed = boundaries.withColumn("region", F.substring("place_fips", 1, 2))
    keyed.repartitionByRange("region", "boundary_type", "place_fips").sortWithinPartitions("region", "boundary_type", "place_fips", "feature_pos").write.mode("overwrite").partitionBy("region", "boundary_type").parquet(folder)


def read_boundary_store(spark: SparkSession, folder: str) -> DataFrame:
    """The table of ``write_boundary_store``; ``lookup`` reads the folders and row groups of the entries that it wants."""
    kinds = spark.read.parquet(folder).schema
    texts = StructType([StructField(f.name, StringType() if f.name in ("region", "boundary_type") else f.dataType) for f in kinds])
    return spark.read.schema(texts).parquet(folder)  # else "04" would be read as a number


def feature_collections(documents: DataFrame) -> DataFrame:
    """Of JSON texts in ``value`` those that are feature collections: their features, and the properties' texts, in whose order names stand."""
    own = [c for c in documents.columns if c != "value"]
    doc = documents.select(*own, "value", F.try_parse_json("value").alias("v")).where(F.try_variant_get("v", "$.type", "string") == "FeatureCollection")
    texts = F.from_json("value", "features array<struct<properties:string>>")["features"]
    return doc.select(*own, F.try_variant_get("v", "$.features", "array<variant>").alias("features"), F.transform(texts, lambda x: x["properties"]).alias("texts"))


def exploded(collections: DataFrame) -> DataFrame:
    """Features of collections (an array of JSON values in ``features``, their properties' texts in ``texts``), with the other columns."""
    own = [c for c in collections.columns if c not in ("features", "texts")]
    rows = collections.select(*own, "texts", F.posexplode("features").alias("feature_pos", "f"))
    g = F.try_variant_get("f", "$.geometry", "variant")
    return rows.select(
        *own,
        "feature_pos",
        F.try_variant_get("f", "$.id", "variant").alias("feature_id"),
        F.try_variant_get("f", "$.properties", "variant").alias("properties"),
        F.get("texts", F.col("feature_pos")).alias("properties_text"),
        F.try_variant_get(g, "$.type", "string").alias("geometry_type"),
        coordinates(g).alias("coordinates"),
    )
