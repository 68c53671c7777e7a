"""Inspection of layers: which fields name a district, which layer of a service is meant, and what a layer can do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civigrid.functions import urls
from civigrid.functions.text import blank, trimmed, words_text
from civigrid.operators.rules import Rule, has_any, holds, score

# Terms looked for anywhere in a name, and the weights of the groups. Names have spaces for underscores
# when they are looked at, so a term with an underscore is written with a space.
WARD_TERMS = ["ward"]
COUNCIL_FIELDS = ["council district", "councildistrict"]
DISTRICT_TERMS = ["district"]
DISTRICT_ALIASES = ["ward", "council", "district"]
NAME_FIELDS = ["ward name", "wardname", "district name", "districtname", "council district name", "councildistrictname"]
NAME_ALIASES = ["ward name", "district name", "council district name"]
LAYER_COUNCIL = ["council district", "city council"]
LAYER_BOUNDARY = ["boundary", "boundaries"]
LAYER_OTHER = ["transit", "bus", "rail", "park", "golf", "tree", "groundwater", "housing", "crime", "police", "airport", "road", "parcel"]


def district_field_score(n: Column, a: Column) -> Column:
    """From the words of a field's name and alias."""
    rules: list[Rule] = [(has_any(n, WARD_TERMS), 60, ""), (has_any(n, COUNCIL_FIELDS), 70, ""), (has_any(n, DISTRICT_TERMS), 50, ""), (has_any(a, DISTRICT_ALIASES), 30, "")]
    return score(rules)


def name_field_score(n: Column, a: Column) -> Column:
    """From the words of a field's name and alias."""
    rules: list[Rule] = [(has_any(n, NAME_FIELDS), 70, ""), (has_any(a, NAME_ALIASES), 60, ""), (F.endswith(n, F.lit("name")), 30, ""), ((a == "name") | F.endswith(a, F.lit(" name")), 20, "")]
    return score(rules)


def layer_score(name: Column) -> Column:
    n = words_text(name)
    return score([(has_any(n, WARD_TERMS), 50, ""), (has_any(n, LAYER_COUNCIL), 60, ""), (has_any(n, DISTRICT_TERMS), 35, ""), (has_any(n, LAYER_BOUNDARY), 30, ""), (has_any(n, LAYER_OTHER), -50, "")])


def clean_fields(fields: Column) -> Column:
    """Fields (array of name and alias) with a name, names and aliases trimmed; null gives none."""
    kept = F.filter(F.coalesce(fields, F.array().cast("array<struct<name:string,alias:string>>")), lambda f: f["name"].isNotNull())
    return F.transform(kept, lambda f: F.struct(trimmed(f["name"]).alias("name"), trimmed(f["alias"]).alias("alias")))


def ranked_fields(fields: Column, by) -> Column:
    """Names of the fields (with n and a, the words of name and alias) with a positive score, best first, as they come among equals."""
    scored = F.transform(fields, lambda f, i: F.struct((-by(f["n"], f["a"])).alias("s"), i.alias("i"), f["name"].alias("name")))
    return F.transform(F.array_sort(F.filter(scored, lambda x: x["s"] < 0)), lambda x: x["name"])


def detected(layers: DataFrame) -> DataFrame:
    """``layers`` with district_fields, name_fields and the first of each, found in ``fields``."""
    worded = F.transform("fields", lambda f: F.struct(f["name"].alias("name"), words_text(f["name"]).alias("n"), words_text(f["alias"]).alias("a")))
    clean = layers.withColumn("fields", clean_fields(F.col("fields"))).withColumn("_worded", worded)
    found = clean.withColumns({"district_fields": ranked_fields(F.col("_worded"), district_field_score), "name_fields": ranked_fields(F.col("_worded"), name_field_score)}).drop("_worded")
    return found.withColumns({"district_field": F.get("district_fields", F.lit(0)), "name_field": F.get("name_fields", F.lit(0))})


def service_layers(layers: Column, service_url: Column) -> Column:
    """A service's layers (array of id, name, url) with an address each, their own or one made of the service's."""
    made = F.transform(layers, lambda x: F.struct(x["id"].alias("id"), x["name"].alias("name"), F.coalesce(x["url"], F.concat(F.regexp_replace(service_url, "/+$", ""), F.lit("/"), x["id"].cast("string"))).alias("url")))
    return F.filter(made, lambda x: blank(x["url"]).isNotNull())


def best_layers(layers: DataFrame, key: list[str]) -> DataFrame:
    """For each ``key``, the layer whose name scores highest, the first among equals; needs name and pos."""
    w = Window.partitionBy(*key).orderBy(F.desc("layer_score"), F.asc("pos"))
    return layers.withColumn("layer_score", layer_score(F.col("name"))).withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def capabilities(layers: DataFrame) -> DataFrame:
    """``layers`` with supports_query, supports_geojson and supports_pagination from what the metadata says."""
    listed = F.transform(F.split(F.coalesce(F.col("supportedQueryFormats"), F.lit("")), ","), lambda x: F.lower(trimmed(x)))
    return layers.withColumns(
        {
            "supports_query": F.coalesce(F.col("supportsQuery"), has_any(words_text(F.col("capabilities")), ["query"])),
            "supports_geojson": F.array_contains(listed, "geojson"),
            "supports_pagination": F.coalesce(F.col("supportsPagination"), F.col("advancedQueryCapabilities.supportsPagination")),
        }
    )


METADATA = (
    "name string, description string, type string, geometryType string, supportedQueryFormats string, capabilities string, objectIdField string, maxRecordCount bigint, "
    "supportsQuery boolean, supportsPagination boolean, fields array<struct<name:string,alias:string,type:string,length:int>>, layers array<struct<id:int,name:string,url:string>>, "
    "tables array<struct<id:int,name:string,url:string>>, advancedQueryCapabilities struct<supportsPagination:boolean>, error struct<code:int,message:string>"
)


def inspected(candidates: DataFrame, metadata: DataFrame) -> DataFrame:
    """``candidates`` (url and others) with what ``metadata`` (url, body) says of them.

    A layer's address gives that layer, a service's its best layer, and any other address an unknown source for which
    nothing is looked up. A missing or broken body leaves an empty inspection of a known service.
    """
    parsed = metadata.select(urls.request_key(F.col("url")).alias("m_url"), F.from_json("body", METADATA).alias("m")).dropDuplicates(["m_url"])
    own = candidates.withColumn("_id", F.monotonically_increasing_id()).withColumn("inspect_url", urls.request_key(F.col("url"))).withColumns({"service_type": urls.service_type(F.col("inspect_url")), "is_layer": urls.is_layer(F.col("inspect_url"))})
    known = own.join(parsed, (F.col("inspect_url") == F.col("m_url")) & (F.col("service_type") != "unknown"), "left").drop("m_url")
    m, b = F.col("m"), F.col("b")
    listed = known.where(~F.col("is_layer") & m.isNotNull() & m["error"].isNull()).select("_id", F.posexplode(service_layers(F.coalesce(m["layers"], F.array().cast("array<struct<id:int,name:string,url:string>>")), F.col("inspect_url"))).alias("pos", "l")).select("_id", "pos", "l.name", F.col("l.url").alias("best_url"))
    best = best_layers(listed, ["_id"]).select("_id", "best_url")
    second = parsed.select(F.col("m_url").alias("b_url"), F.col("m").alias("b"))
    both = known.join(best, "_id", "left").join(second, urls.request_key(F.col("best_url")) == F.col("b_url"), "left")
    # One of: nothing known, a layer's own metadata, a service that names no layer, a service's best layer, no usable answer.
    by_service = F.col("best_url").isNotNull()
    answered = F.when(by_service, b.isNotNull()).otherwise(m.isNotNull())
    layer = F.when(by_service, b).when(F.col("is_layer"), m)
    good = F.when(layer["error"].isNull(), layer)
    url = F.when(by_service & answered, F.col("best_url")).otherwise(F.col("inspect_url"))
    at_layer = answered & (by_service | F.col("is_layer"))
    own_name = urls.layer_name(url)
    service = F.coalesce(F.when(by_service, F.coalesce(m["name"], urls.service_name(F.col("inspect_url")))), F.when(good.isNotNull() | ~F.col("is_layer"), urls.service_name(url)))
    title = F.when(good.isNotNull(), F.coalesce(good["name"], own_name)).when(at_layer, F.coalesce(F.when(by_service, m["name"]), own_name)).otherwise(m["name"])
    none = F.array().cast("array<struct<name:string,alias:string>>")
    known_service = F.col("service_type") != "unknown"
    able = capabilities(both.withColumn("_d", good).select("*", *(F.col(f"_d.{c}").alias(c) for c in ("supportsQuery", "capabilities", "supportedQueryFormats", "supportsPagination", "advancedQueryCapabilities"))))
    found = F.col("_d").isNotNull()
    out = able.select(
        *[c for c in candidates.columns if c != "url"],
        url.alias("url"),
        known_service.alias("is_service"),
        F.col("service_type"),
        F.when(answered, at_layer).otherwise(F.col("is_layer") & known_service).alias("is_layer"),
        F.when(answered, title).alias("title"),
        F.when(answered, service).alias("service_name"),
        F.when(at_layer, F.coalesce(good["name"], own_name)).alias("layer_name"),
        F.when(answered, F.coalesce(good["description"], F.when(by_service | ~F.col("is_layer"), m["description"]))).alias("description"),
        F.when(found, urls.geometry_type(good["geometryType"])).alias("geometry_type"),
        F.coalesce(F.transform(good["fields"], lambda f: F.struct(f["name"].alias("name"), f["alias"].alias("alias"))), none).alias("fields"),
        *(F.when(found, F.col(c)).alias(c) for c in ("supports_query", "supports_geojson", "supports_pagination")),
    )
    return detected(out)
