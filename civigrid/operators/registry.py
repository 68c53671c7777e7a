"""The registry of sources: building, ordering, searching."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civigrid.functions.text import place_key, state_code

VERSION = "0.1.0"


def matching(entries: DataFrame, city: str | None = None, state: str | None = None, place_fips: str | None = None, boundary_type: str | None = None) -> DataFrame:
    """Entries that meet all options given; None doesn't filter."""
    if city is not None:
        entries = entries.where(place_key(F.col("city")) == place_key(F.lit(city)))
    if state is not None:
        entries = entries.where(state_code(F.col("state")) == state_code(F.lit(state)))
    if place_fips is not None:
        entries = entries.where(F.col("placeFips") == place_fips)
    if boundary_type is not None:
        entries = entries.where(F.col("boundaryType") == boundary_type)
    return entries


def first_matching(entries: DataFrame, **options) -> DataFrame:
    return matching(entries, **options).orderBy("pos").limit(1)


def built(places: DataFrame, sources: DataFrame, generated_at: str) -> DataFrame:
    """An entry for each place with a source, nested as in the registry's document; the place says who it is.

    Both sides grow with the places, whatever is estimated for them, so neither is broadcast.
    """
    own = places.select("place_fips", F.col("city").alias("p_city"), F.col("state").alias("p_state"))
    joined = own.hint("merge").join(sources, "place_fips")
    return joined.select(
        F.col("place_fips").alias("placeFips"),
        F.col("p_city").alias("city"),
        F.col("p_state").alias("state"),
        F.col("district_type").alias("districtType"),
        F.struct(F.col("url"), F.col("service_type").alias("serviceType"), F.col("title"), F.col("official_source").alias("official")).alias("source"),
        F.struct(F.col("district_field").alias("district"), F.col("name_field").alias("name")).alias("fields"),
        F.struct(
            F.lit(generated_at).alias("generatedAt"),
            F.lit(VERSION).alias("generatorVersion"),
            F.transform("alternatives", lambda a: F.struct(a["url"].alias("url"), a["title"].alias("title"), a["service_type"].alias("serviceType"), a["official_source"].alias("officialMunicipalSource"), a["score"].alias("score"))).alias("alternatives"),
            F.col("requires_review").alias("requiresReview"),
        ).alias("metadata"),
    )


def ordered(entries: DataFrame) -> DataFrame:
    return entries.orderBy(*(F.collate(c, "UNICODE") for c in ("state", "city", "districtType", "placeFips")))


def as_package(entries: DataFrame, boundary_types: dict[str, str] | None = None) -> DataFrame:
    """Generated entries in the form that look-ups read, which names other columns."""
    kinds = boundary_types or {}
    kind = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in kinds.items() for x in kv)), F.col("districtType")), F.col("districtType")) if kinds else F.col("districtType")
    return entries.select(
        "placeFips",
        "city",
        "state",
        kind.alias("boundaryType"),
        F.concat("placeFips", F.lit("/"), kind, F.lit(".geojson")).alias("generatedFile"),
        F.struct(F.lit("arcgis").alias("sourceType"), F.col("source.url").alias("url"), F.col("source.title").alias("title"), F.col("source.official").alias("official"), F.struct(F.col("fields.district").alias("district"), F.col("fields.name").alias("name")).alias("fieldMapping")).alias("source"),
    )
