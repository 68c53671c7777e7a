"""Choice of one source for each group and each place, with its alternatives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civigrid.functions.text import blank
from civigrid.operators.scoring import scored_ranks, scored_sources

LABEL = "Municipal district layer"


def review() -> Column:
    return F.coalesce(F.col("requires_review"), F.lit(False)) | F.coalesce(F.col("needs_review"), F.lit(False))


def by_preference() -> list[Column]:
    """Score, then no review, official, feature server, address."""
    return [F.desc("score"), F.asc("_review"), F.desc("official_source"), F.desc("_feature"), F.collate(F.col("url"), "UNICODE").asc(), F.asc("ord")]


def prepared(layers: DataFrame) -> DataFrame:
    return scored_sources(layers).withColumn("_review", review()).withColumn("_feature", F.col("service_type") == "FeatureServer")


def ranked_for_display(layers: DataFrame) -> DataFrame:
    """``layers`` with score, reasons and place_rank: score, then title, then order."""
    title = F.collate(F.coalesce("title", "candidate_title", F.lit("")), "UNICODE")
    return scored_sources(layers).withColumn("place_rank", F.row_number().over(Window.partitionBy("place_fips").orderBy(F.desc("score"), title.asc(), F.asc("ord"))))


def top(layers: DataFrame, n: int = 5) -> DataFrame:
    return ranked_for_display(layers).where(F.col("place_rank") <= n)


def group_sources(members: DataFrame) -> DataFrame:
    """A row for each group whose best member can be used: the source, its alternatives in rank order, whether it needs review.

    If the best member is rejected or lacks a district field or type, the group has no source; the next one isn't tried.
    Members are sorted once, and the best one's row gets the list of those after it, so nothing is joined.
    """
    w = Window.partitionBy("place_fips", "group_id").orderBy(*by_preference())
    other = F.struct(F.col("url"), F.col("title"), F.col("service_type"), F.col("official_source"), F.col("score"))
    after = F.collect_list(F.when(F.col("score") > float("-inf"), other)).over(w.rowsBetween(1, Window.unboundedFollowing))
    ranked = prepared(members).withColumns({"_rank": F.row_number().over(w), "alternatives": after})
    best = ranked.where("_rank = 1").where((F.col("score") > float("-inf")) & blank(F.col("district_field")).isNotNull() & blank(F.col("district_type")).isNotNull())
    return best.select(
        "place_fips",
        "group_id",
        "ord",
        "city",
        "state",
        "url",
        F.coalesce("title", "layer_name", "service_name", F.lit(LABEL)).alias("title"),
        "district_type",
        "service_type",
        "official_source",
        "district_field",
        "name_field",
        F.coalesce("geometry_type", F.lit("unknown")).alias("geometry_type"),
        "score",
        "alternatives",
        F.col("reasons").alias("selection_reasons"),
        F.col("_review").alias("requires_review"),
    )


def place_sources(sources: DataFrame) -> DataFrame:
    """The one source of each place, by the same preferences among its groups' sources."""
    ready = sources.withColumn("_review", F.col("requires_review")).withColumn("_feature", F.col("service_type") == "FeatureServer")
    return ready.withColumn("_rank", F.row_number().over(Window.partitionBy("place_fips").orderBy(*by_preference()))).where("_rank = 1").drop("_rank", "_review", "_feature")


def ranked_sources(members: DataFrame) -> DataFrame:
    """The older choice: by score and order alone; a lead of less than 10 over the second needs review."""
    w = Window.partitionBy("place_fips", "group_id").orderBy(F.desc("score"), F.asc("ord"))
    ranked = scored_ranks(members).withColumns({"_rank": F.row_number().over(w), "second": F.lead("score").over(w)})
    best = ranked.where("_rank = 1").where(blank(F.col("district_field")).isNotNull() & blank(F.col("district_type")).isNotNull() & blank(F.col("geometry_type")).isNotNull())
    gap = F.col("score") - F.coalesce("second", F.lit(0.0))
    return best.select("place_fips", "group_id", "ord", "city", "state", "url", F.coalesce("title", "layer_name", "service_name", F.concat_ws(" ", "city", "district_type")).alias("title"), "district_type", "service_type", "official_source", "district_field", "name_field", "geometry_type", "score", gap.alias("score_gap"), F.col("reasons").alias("selection_reasons"), (gap < 10).alias("requires_review"))
