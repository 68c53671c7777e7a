"""Classification of inspected layers by keywords, geometry and fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civigrid.functions.text import blank, words_text
from civigrid.operators.rules import found, holds, labels, matches

# Labels and their patterns; each stands between word borders. "properties?" and "boundaries?" match the
# plural with or without its last letter only, as they must.
POLITICAL = {
    "ward": "wards?",
    "council district": "council districts?",
    "city council": "city council",
    "aldermanic": "aldermanic",
    "alderman": "alderman",
    "municipal district": "municipal districts?",
    "political district": "political districts?",
    "election district": "election districts?",
    "voting district": "voting districts?",
}
WARD = {"ward": "wards?", "ward boundary": "ward boundaries?"}
COUNCIL = {"council district": "council districts?", "city council": "city council", "council ward": "council wards?"}
ALDERMANIC = {"aldermanic": "aldermanic", "alderman": "alderman"}
MUNICIPAL = {"municipal district": "municipal districts?"}
THEMATIC = {
    "transit": "transit",
    "transit stop": "transit stops?",
    "route": "routes?",
    "golf": "golf",
    "exercise": "exercise",
    "lighting": "lighting",
    "playground": "playgrounds?",
    "playing field": "playing fields?",
    "ballfield": "ballfields?",
    "maintenance": "maintenance",
    "garden": "gardens?",
    "aquatic": "aquatics?",
    "pool": "pools?",
    "road": "roads?",
    "crime": "crimes?",
    "hate": "hate",
    "violence": "violence",
    "connectivity": "connectivity",
    "project": "projects?",
    "tree equity": "tree equity",
    "neighborhood": "neighborhoods?",
    "zoning": "zoning",
    "water": "water",
    "groundwater": "groundwater",
    "airport": "airport",
    "environment": "environment",
}
CENSUS = {"census": "census", "block group": "block groups?", "census tract": "census tracts?", "tract": "tracts?"}
PARCEL = {"parcel": "parcels?", "property": "properties?", "APN": "apn", "owner": "owners?", "ownership": "ownership", "assessor": "assessor", "zoning": "zoning"}
HOUSING = {"housing": "housing", "households": "households?", "residential": "residential", "affordable housing": "affordable housing", "vacancy": "vacancy"}
FAMILIES = [("ward", WARD), ("council-district", COUNCIL), ("aldermanic-district", ALDERMANIC), ("municipal-district", MUNICIPAL)]
OFFICIAL_HOSTS = ["tucsonaz.gov", "cityoftucson"]


def joined(parts: list[Column]) -> Column:
    """Non-empty texts with spaces between."""
    return F.array_join(F.filter(F.array(*parts), lambda x: x != ""), " ")


def any_of(text: Column, patterns: dict[str, str]) -> Column:
    return found(text, list(patterns.values()))


def district_type(families: Column) -> Column:
    """The first family that a text has a pattern of (an array of booleans), by the families' rank; else null."""
    out = F.lit(None).cast("string")
    for i, (name, _) in reversed(list(enumerate(FAMILIES))):
        out = F.when(F.get(families, F.lit(i)), F.lit(name)).otherwise(out)
    return out


def political_field(names: Column) -> Column:
    """Whether any field name has a district's word by itself, underscores counting as spaces."""
    texts = F.transform(F.coalesce(names, F.array().cast("array<string>")), words_text)
    return F.exists(texts, lambda t: matches(t, "(?:ward|district|council)") | holds(t.rlike(r"(?i)(?<![A-Za-z0-9_])alderman")))


def classified(layers: DataFrame, official_hosts: list[str] | None = None) -> DataFrame:
    """``layers`` with the classification's columns.

    Needs url, source, title, service_name, layer_name, description, geometry_type, fields (array of name and alias),
    district_field, district_fields and name_fields. Nulls count as absent.
    """
    title, service, layer, description = (words_text(F.col(c)) for c in ("title", "service_name", "layer_name", "description"))
    none = F.array().cast("array<string>")
    fields = [F.coalesce(_normal("fields", part), none) for part in ("name", "alias")]
    flat = F.array_join(F.filter(F.concat(*fields), lambda x: x != ""), " ")
    with_text = layers.withColumn("_all", joined([title, service, layer, description, flat])).withColumn("_identity", joined([title, service, layer]))
    url = F.lower(F.col("url"))
    official = F.col("source") == "municipal"
    for host in OFFICIAL_HOSTS if official_hosts is None else official_hosts:
        official = holds(official) | holds(F.contains(url, F.lit(host)))
    with_text = with_text.withColumn("_families", F.array(*(any_of(F.col("_identity"), patterns) for _, patterns in FAMILIES)))
    matched = with_text.withColumns(
        {
            "match_thematic": labels(F.col("_all"), THEMATIC),
            "match_census": labels(F.col("_all"), CENSUS),
            "match_parcel": labels(F.col("_all"), PARCEL),
            "match_housing": labels(F.col("_all"), HOUSING),
            "match_political": labels(F.col("_all"), POLITICAL),
            "official_source": holds(official),
            "is_polygon": holds(F.col("geometry_type").isin("esriGeometryPolygon", "polygon")),
            "_political_field": political_field(F.col("district_fields")),
            "district_type": district_type(F.col("_families")),
        }
    )

    def some(c: str) -> Column:
        return F.size(c) > 0

    points = sum((F.when(F.get("_families", F.lit(i)), 5).otherwise(0) for i in range(len(FAMILIES))), F.lit(0))
    for condition, weight in ((F.col("is_polygon"), 2), (F.col("_political_field"), 1), (holds(some("name_fields")), 1), (F.col("official_source"), 1), (some("match_census"), -5), (some("match_parcel"), -5), (some("match_housing"), -2), (some("match_thematic"), -2)):
        points = points + F.when(condition, weight).otherwise(0)
    scored = matched.withColumn("political_score", points)
    political = F.col("is_polygon") & (F.col("political_score") >= 6) & (F.col("_political_field") | F.col("district_type").isNotNull())
    kept = scored.withColumn("is_political", political)
    return kept.withColumns(
        {
            "is_boundary": F.col("is_political"),
            "is_thematic": some("match_thematic") & ~F.col("is_political"),
            "is_census": some("match_census"),
            "is_parcel": some("match_parcel"),
            "is_housing": some("match_housing"),
            "match_boundary": F.when(F.col("is_political"), F.array(F.lit("political boundary"))).otherwise(none),
            "match_official": F.when(F.col("official_source"), F.array(F.lit("official municipal source"))).otherwise(none),
            # Without a polygon nothing is political; housing and weak fields only reject what isn't political either.
            "rejected": ~F.col("is_political") | some("match_census") | some("match_parcel"),
            "needs_review": F.col("is_political") & ((F.col("political_score") < 8) | ~F.col("official_source") | blank(F.col("district_field")).isNull() | F.col("district_type").isNull()),
        }
    ).drop("_all", "_identity", "_families", "_political_field")


def _normal(fields: str, part: str) -> Column:
    return F.transform(fields, lambda f: words_text(f[part]))


def split_rejected(layers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid and rejected layers."""
    return layers.where("NOT rejected"), layers.where("rejected")
