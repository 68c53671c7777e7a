"""GeoJSON features: properties by name, normalised features, districts of a registry's entry.

Properties are JSON values (``variant``), so that a number and a string that look alike stay different.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civigrid.functions.text import blank, field_key, trimmed
from civigrid.operators.geo import MULTI

# Property names that are looked for, in this order.
DISTRICT_NAMES = ["district", "district_id", "districtid", "district_no", "district_num", "district_number", "districtname", "ward", "ward_id", "wardid", "ward_no", "ward_num", "ward_number", "wardname", "council_district", "councildistrict", "council_district_id"]
NAME_NAMES = ["name", "district_name", "ward_name", "council_name", "label", "description"]
POLYGONS = ["Polygon", "MultiPolygon"]


def value_text(v: Column) -> Column:
    """A JSON scalar as text: strings trimmed and null when blank, numbers and booleans as they print, all else null."""
    kind = F.schema_of_variant(v)
    text = F.try_variant_get(v, "$", "string")
    return F.when(kind == "STRING", blank(trimmed(text))).when(kind.rlike("^(BIGINT|DOUBLE|BOOLEAN|DECIMAL.*|FLOAT|INT|SMALLINT|TINYINT)$"), F.regexp_replace(text, r"\.0+$", ""))


def property_names(features: DataFrame, key: list[str]) -> DataFrame:
    """For each ``key``, the distinct property names in the order in which they are first seen (feature_pos, then place).

    The place is that in ``properties_text``, the properties as they stand in the file; without it names are in
    alphabetical order, as JSON values keep them.
    """
    text = F.coalesce("properties_text", F.to_json("properties")) if "properties_text" in features.columns else F.to_json("properties")
    seen = features.select(*key, "feature_pos", F.posexplode(F.json_object_keys(text)).alias("i", "name"))
    return seen.groupBy(*key, "name").agg(F.min(F.struct("feature_pos", "i")).alias("first"))


def detected_fields(features: DataFrame, key: list[str]) -> DataFrame:
    """For each ``key``: the property that names the district and the one that names its label, null where there is none."""
    names = property_names(features, key).withColumn("k", field_key(F.col("name")))

    def ranks(wanted: list[str]) -> Column:
        order = list(dict.fromkeys(w.replace("_", "") for w in wanted))
        return F.array_position(F.array(*map(F.lit, order)), F.col("k"))

    def best(rank: Column) -> Column:
        return F.min(F.when(rank > 0, F.struct(rank.alias("r"), F.col("first"), F.col("name"))))["name"]

    partly = F.min(F.when(F.contains("k", F.lit("district")) | F.contains("k", F.lit("ward")), F.struct("first", "name")))["name"]
    return names.groupBy(*key).agg(F.coalesce(best(ranks(DISTRICT_NAMES)), partly).alias("district_property"), best(ranks(NAME_NAMES)).alias("name_property"))


def get_property(properties: Column, name: Column) -> Column:
    """The value under a name, else under the first name with the same letters and digits."""
    names = F.coalesce(F.json_object_keys(F.to_json(properties)), F.array().cast("array<string>"))
    like = F.get(F.filter(names, lambda k: field_key(k) == field_key(name)), F.lit(0))
    real = F.when(F.array_contains(names, name), name).otherwise(like)
    entries = F.from_json(F.to_json(properties), "map<string,variant>")
    return F.try_element_at(entries, real)


def normalised(features: DataFrame, city: str, state: str, place_fips: str, boundary_type: str, district_field: str | None = None, name_field: str | None = None, key: list[str] | None = None) -> DataFrame:
    """Features with id, district, name and the place's columns; their own properties stay beside them.

    An id is the feature's own, else its district, else its place in the collection from 1. A geometry that is missing
    or no polygon fails when it is read.
    """
    key = key or []
    one = features if key else features.withColumn("_all", F.lit(1))
    found = detected_fields(one, key or ["_all"])
    both = one.join(found, key or ["_all"], "left")  # a row for each collection; broadcast only if it is found to be small
    d_field = F.lit(district_field) if district_field else F.col("district_property")
    n_field = F.lit(name_field) if name_field else F.col("name_property")
    district, name = value_text(get_property(F.col("properties"), d_field)), value_text(get_property(F.col("properties"), n_field))
    bad = F.col("geometry_type").isNull() | ~F.col("geometry_type").isin(*POLYGONS)
    kind = F.when(bad, F.raise_error(F.concat(F.lit("feature needs a Polygon or MultiPolygon, not "), F.coalesce("geometry_type", F.lit("nothing"))))).otherwise(F.col("geometry_type"))
    return both.select(
        *key,
        "feature_pos",
        F.coalesce(value_text(F.col("feature_id")), district, (F.col("feature_pos") + 1).cast("string")).alias("id"),
        district.alias("district"),
        F.coalesce(name, district).alias("name"),
        F.lit(city).alias("city"),
        F.lit(state).alias("state"),
        F.lit(place_fips).alias("place_fips"),
        F.lit(boundary_type).alias("boundary_type"),
        kind.alias("geometry_type"),
        *(c for c in ("coordinates", "properties") if c in features.columns),
    )


def coordinates(geometry: Column) -> Column:
    """A polygon's or multipolygon's coordinates (JSON value) as a multipolygon's; null for other types."""
    kind = F.try_variant_get(geometry, "$.type", "string")
    whole = F.from_json(F.to_json(F.try_variant_get(geometry, "$.coordinates", "variant")), MULTI)
    single = F.from_json(F.to_json(F.try_variant_get(geometry, "$.coordinates", "variant")), "array<array<array<double>>>")
    return F.when(kind == "MultiPolygon", whole).when(kind == "Polygon", F.array(single))


def districts(features: DataFrame) -> DataFrame:
    """Features joined with their registry entry (entry columns and ``source.fieldMapping``) as districts.

    A district is the text of the mapped property, a missing one ''; a name falls back to the district; an id is the
    property ``id`` if that is a string, else made of place, type and district.
    """
    entries = F.from_json(F.to_json("properties"), "map<string,variant>")

    def text(field: Column) -> Column:
        v = F.try_element_at(entries, field)
        return F.when(F.schema_of_variant(v) != "VOID", F.try_variant_get(v, "$", "string"))

    own = F.try_element_at(entries, F.lit("id"))
    district = trimmed(F.coalesce(text(F.col("source.fieldMapping.district")), F.lit("")))
    rows = features.withColumn("district", district)
    return rows.withColumns(
        {
            "name": trimmed(F.coalesce(text(F.col("source.fieldMapping.name")), F.col("district"))),
            "id": F.when(F.schema_of_variant(own) == "STRING", F.try_variant_get(own, "$", "string")).otherwise(F.concat_ws("-", "placeFips", "boundaryType", "district")),
        }
    )


