"""Scores of candidate layers: for the choice of a source, its older variant, and before inspection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civigrid.functions.text import blank, words_text
from civigrid.operators.rules import Rule, has_any, holds, matches, reasons, score

POLYGONS = ["esriGeometryPolygon", "polygon"]


def is_polygon() -> Column:
    return holds(F.col("geometry_type").isin(*POLYGONS))


def identified() -> Column:
    return F.concat(F.lit("identified as "), F.col("district_type"))


def has(c: str) -> Column:
    return blank(F.col(c)).isNotNull()


def source_rules() -> list[Rule]:
    """Weights and reasons in the choice of a source."""
    return [
        (F.col("official_source"), 100, "official municipal source"),
        (F.col("is_political"), 100, "appears to represent a political boundary"),
        (F.col("is_boundary"), 40, "boundary layer"),
        (has("district_type"), 40, identified()),
        (is_polygon(), 30, "polygon geometry"),
        (has("district_field"), 25, F.concat(F.lit("district field: "), F.col("district_field"))),
        (has("name_field"), 10, F.concat(F.lit("name field: "), F.col("name_field"))),
        (F.col("service_type") == "FeatureServer", 10, "FeatureServer"),
        (F.col("supports_query"), 5, "supports querying"),
        (F.col("supports_geojson"), 5, "supports GeoJSON"),
        (F.col("supports_pagination"), 2, "supports pagination"),
        (F.col("is_thematic"), -100, "thematic dataset"),
        (has("geometry_type") & ~is_polygon(), -50, "non-polygon geometry"),
    ]


def scored_sources(layers: DataFrame) -> DataFrame:
    """``layers`` with score and reasons; a rejected one has minus infinity and that reason alone."""
    rules = source_rules()
    gone = holds(F.col("rejected"))
    return layers.withColumns({"score": F.when(gone, F.lit(float("-inf"))).otherwise(score(rules)), "reasons": F.when(gone, F.array(F.lit("rejected candidate"))).otherwise(reasons(rules))})


def rank_rules() -> list[Rule]:
    """Weights and reasons of the older ranking."""
    title = F.lower(F.coalesce("title", "layer_name", "service_name", F.lit("")))
    named = matches(title, "wards?") | matches(title, "council") | matches(title, "districts?")
    strong = F.exists(F.coalesce("district_fields", F.array().cast("array<string>")), lambda f: holds(f.rlike("(?i)ward|council|district|alderman")))
    return [
        (F.col("official_source"), 30, "official municipal source"),
        (F.col("is_political"), 50, "political boundary"),
        (F.col("is_boundary"), 25, "boundary layer"),
        (F.col("is_thematic"), -50, "thematic dataset"),
        (F.col("is_census"), -50, "Census dataset"),
        (is_polygon(), 20, "polygon geometry"),
        (~is_polygon(), -30, "non-polygon geometry"),
        (has("district_type"), 20, identified()),
        (has("district_field"), 20, F.concat(F.lit("district field: "), F.col("district_field"))),
        (has("name_field"), 10, F.concat(F.lit("name field: "), F.col("name_field"))),
        (F.col("supports_query"), 5, "supports querying"),
        (F.col("supports_geojson"), 5, "supports GeoJSON"),
        (F.col("supports_pagination"), 3, "supports pagination"),
        (F.col("service_type") == "FeatureServer", 5, "FeatureServer"),
        (named, 15, "title contains political district terminology"),
        (strong, 10, "field names strongly indicate political district"),
    ]


def scored_ranks(layers: DataFrame) -> DataFrame:
    rules = rank_rules()
    return layers.withColumns({"score": score(rules), "reasons": reasons(rules)})


def early_rules() -> list[Rule]:
    """Terms, weights and reasons of the score before inspection."""
    t = words_text(F.col("title"))
    polygon = holds(F.contains(F.lower(F.col("geometry_type")), F.lit("polygon")))
    return [
        (F.col("is_likely_boundary"), 25, "likely political boundary layer"),
        (F.col("is_polygon_layer"), 20, "polygon geometry"),
        (F.col("has_district_field"), 20, "district/ward field detected"),
        (F.col("has_name_field"), 10, "district/name field detected"),
        (F.col("is_feature_server"), 10, "FeatureServer"),
        (F.col("is_map_server"), 5, "MapServer"),
        (F.col("is_official"), 20, "official municipal source"),
        (has_any(t, ["ward"]), 20, "title contains ward"),
        (has_any(t, ["council district", "city council"]), 25, "title contains council district"),
        (has_any(t, ["boundary", "boundaries"]), 15, "title contains boundary terminology"),
        (has_any(t, ["municipal", "city of"]), 5, "title appears municipal"),
        (holds(F.col("is_housing")) | has_any(t, ["housing", "section 8"]), -40, "housing dataset"),
        (holds(F.col("is_census")) | has_any(t, ["census block", "block group", "tract", "census geography", "census data"]), -45, "Census geography/dataset"),
        (F.col("is_thematic"), -35, "thematic dataset"),
        (has_any(t, ["equity", "index", "priority", "demographic", "population", "income"]), -20, "thematic/non-boundary terminology"),
        (~holds(F.col("is_polygon_layer")) & polygon, 15, "polygon geometry detected"),
    ]


def scored_early(candidates: DataFrame) -> DataFrame:
    """``candidates`` with score (0 to 100) and reasons from title and flags alone."""
    rules = early_rules()
    return candidates.withColumns({"score": F.greatest(F.lit(0.0), F.least(F.lit(100.0), score(rules))), "reasons": reasons(rules)})
