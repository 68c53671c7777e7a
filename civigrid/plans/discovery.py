"""The discovery run: places, searches, inspection, classification, grouping, choice, registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civigrid.functions.text import blank
from civigrid.functions.urls import lookup_key, request_key
from civigrid.operators.classify import classified
from civigrid.operators.fields import inspected
from civigrid.operators.registry import built
from civigrid.operators.scoring import scored_sources
from civigrid.operators.selection import group_sources, place_sources
from civigrid.operators.staging import staged
from civigrid.operators.similarity import grouped_sources, groups

# What is searched for after a place's name and state.
TEMPLATES = ["council districts", "city council", "wards", "ward boundaries", "council district boundaries", "municipal districts"]


def search_texts(places: DataFrame) -> DataFrame:
    """Each place with its six search texts: query_no from 0 and query."""
    made = F.array(*(F.concat(F.lit('"'), F.col("city"), F.lit('" '), F.col("state"), F.lit(f" {t}")) for t in TEMPLATES))
    return places.select("*", F.posexplode(made).alias("query_no", "query"))


def candidates(searches: DataFrame, hits: DataFrame) -> DataFrame:
    """Candidates of the hits with an address, ``ord`` by query and place in the answer."""
    own = searches.join(hits.select("query", "pos", F.col("title").alias("candidate_title"), "url"), "query").where(blank(F.col("url")).isNotNull())
    return own.select("place_fips", "city", "state", (F.col("query_no") * 1000 + F.col("pos")).cast("long").alias("ord"), "url", "candidate_title", F.lit(0.0).alias("candidate_score"), F.lit(False).alias("requires_review"), F.array(F.concat(F.lit("search query: "), F.col("query"))).alias("candidate_reasons"), F.lit("arcgis").alias("source"), F.col("query").alias("search_query"))


def distinct_urls(found: DataFrame) -> DataFrame:
    """One candidate for each place and address (as compared), the first one's columns with all reasons in order."""
    others = [c for c in found.columns if c not in ("place_fips", "candidate_reasons")]
    keyed = found.withColumn("_key", lookup_key(F.col("url")))
    merged = keyed.groupBy("place_fips", "_key").agg(F.min_by(F.struct(*others), "ord").alias("_first"), F.array_sort(F.collect_list(F.struct("ord", F.col("candidate_reasons").alias("r")))).alias("_all"))
    return merged.select("place_fips", "_first.*", F.array_distinct(F.flatten(F.transform("_all", lambda x: x["r"]))).alias("candidate_reasons"))


COUNTED = ("candidates", "inspected", "valid", "rejected", "groups", "chosen")


def discovered(places: DataFrame, hits: DataFrame, metadata: DataFrame, failures: DataFrame | None = None, faults: DataFrame | None = None) -> dict[str, DataFrame]:
    """All tables of a run, keyed by place: candidates, inspected, uninspected, valid, rejected, groups, sources, chosen, results.

    A search or an address without an answer only leaves its hits or its layer out; a place with no hit at all has no
    source, but hasn't failed. A place has failed if its processing broke off: ``failures`` has such places (place_fips)
    with the message of the cause. ``results`` has a row for each place, with counts and, for failed ones, the error;
    no other table has rows of failed places. ``faults`` (url, cause) has addresses whose metadata can't be classified:
    candidates that lead to one are listed in ``uninspected`` and are not inspected.
    """
    none = places.sparkSession.createDataFrame([], "place_fips string, error string")
    failed = (none if failures is None else failures).groupBy("place_fips").agg(F.min(F.coalesce("error", F.lit("undefined"))).alias("error"))
    searches = search_texts(places.join(failed.select("place_fips"), "place_fips", "left_anti").select(*places.columns))
    found = staged(distinct_urls(candidates(searches, hits)))
    looked = inspected(found.withColumn("candidate_url", F.col("url")), metadata)
    cause = F.lit(None).cast("string")
    if faults is not None:
        looked = staged(looked)
        own, best = (faults.select(F.col("url").alias(f"_{k}"), F.col("cause").alias(f"_{k}_cause")) for k in ("own", "best"))
        looked = looked.join(own, request_key(F.col("candidate_url")) == F.col("_own"), "left").join(best, request_key(F.col("url")) == F.col("_best"), "left")
        cause = F.coalesce("_own_cause", "_best_cause")
    looked = looked.withColumn("_cause", cause)
    layers = staged(classified(looked.where("_cause IS NULL").drop("_cause", "_own", "_own_cause", "_best", "_best_cause")))
    valid, rejected = layers.where("NOT rejected"), layers.where("rejected")
    members = staged(grouped_sources(valid))
    sources = group_sources(members)
    chosen = place_sources(sources)
    tables = {"candidates": found, "inspected": layers, "uninspected": looked.where("_cause IS NOT NULL").select("place_fips", "ord", F.col("candidate_url").alias("url"), F.col("_cause").alias("cause")), "valid": valid, "rejected": rejected, "scored": scored_sources(valid), "members": members, "groups": groups(members), "sources": sources, "chosen": chosen}
    counts = places.join(failed, "place_fips", "left")
    for name in COUNTED:
        counts = counts.join(tables[name].groupBy("place_fips").agg(F.count("*").alias(f"n_{name}")), "place_fips", "left")
    tables["results"] = counts.select(*places.columns, *(F.coalesce(f"n_{n}", F.lit(0)).alias(f"n_{n}") for n in COUNTED), "error")
    return tables


def summary(results: DataFrame) -> DataFrame:
    """Totals over the places of a run."""
    def total(c: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c.removeprefix("n_"))

    failed = F.col("error").isNotNull()
    return results.agg(F.count("*").alias("municipalities"), *(total(f"n_{n}") for n in ("candidates", "inspected", "valid", "rejected", "groups")), F.count_if(F.col("n_chosen") > 0).alias("canonical"), F.count_if(~failed & (F.col("n_chosen") == 0)).alias("no_canonical"), F.count_if(failed).alias("failed"))


def registry_of(places: DataFrame, chosen: DataFrame, generated_at: str) -> DataFrame:
    return built(places, chosen, generated_at)
