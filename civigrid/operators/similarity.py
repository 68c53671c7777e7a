"""Pairs of layers: fingerprints, similarity, and greedy grouping in input order.

A place has at most a few hundred candidates (six searches of at most a hundred hits), and both groupings depend on
the order of a place's candidates; so a place is one group here, and places are what is spread over the cluster.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civigrid.functions.text import blank, field_key, fixed, identity_key, title_text
from civigrid.functions.urls import layer_key, plain_geometry
from civigrid.operators.rules import holds, jaccard, present
from civigrid.operators.staging import dealt

# Terms of district and name fields, and words of titles that say nothing.
DISTRICT_TERMS = ["ward", "wards", "ward_no", "ward_num", "ward_number", "district", "districts", "district_no", "district_num", "district_number", "council", "council_district", "councildistrict"]
NAME_TERMS = ["name", "ward_name", "district_name", "council_name", "label", "description"]
IDLE_WORDS = ["city", "county", "of", "the", "and", "open", "data", "gis", "arcgis", "layer", "layers", "map", "service", "services", "boundary", "boundaries"]
NO_TEXT = "array<string>"


def texts(c: Column) -> Column:
    return F.coalesce(c, F.array().cast(NO_TEXT))


def _keys(names: Column) -> Column:
    return F.array_sort(F.filter(F.transform(texts(names), field_key), lambda x: x != ""))


def has_term(field: Column, terms: list[str]) -> Column:
    """Whether a field's name or alias has any of the terms in it, letters and digits alone."""
    name, alias = field_key(field["name"]), field_key(field["alias"])
    out = F.lit(False)
    for t in sorted({t.replace("_", "") for t in terms}):
        out = out | F.contains(name, F.lit(t)) | F.contains(alias, F.lit(t))
    return out


def eligible() -> Column:
    """Whether a layer takes part in the grouping of sources."""
    return holds(F.col("is_political") & F.col("is_boundary") & blank(F.col("district_type")).isNotNull() & F.col("geometry_type").isin("esriGeometryPolygon", "polygon"))


def source_print() -> Column:
    """What the grouping of sources compares."""
    names = F.transform("fields", lambda f: f["name"])
    return F.struct(identity_key(F.col("service_name")).alias("service"), identity_key(F.col("layer_name")).alias("layer"), blank(F.col("geometry_type")).alias("geometry"), _keys(F.col("district_fields")).alias("districts"), _keys(F.col("name_fields")).alias("names"), _keys(names).alias("fields"))


def layer_print() -> Column:
    """What the de-duplication of layers compares; a candidate's own title stands in for a missing one."""
    def named(terms: list[str] | None) -> Column:
        chosen = F.col("fields") if terms is None else F.filter("fields", lambda f: has_term(f, terms))
        return _keys(F.transform(chosen, lambda f: f["name"]))

    words = F.array_distinct(F.filter(F.split(title_text(F.coalesce("title", "candidate_title")), " "), lambda w: (F.length(w) > 1) & ~w.isin(*IDLE_WORDS)))
    return F.struct(
        layer_key(F.coalesce(blank(F.col("url")), F.col("candidate_url"))).alias("url"),
        blank(F.col("district_type")).alias("type"),
        plain_geometry(F.col("geometry_type")).alias("geometry"),
        blank(title_text(F.col("service_name"))).alias("service"),
        blank(title_text(F.col("layer_name"))).alias("layer"),
        words.alias("words"),
        named(DISTRICT_TERMS).alias("districts"),
        named(NAME_TERMS).alias("names"),
        named(None).alias("fields"),
    )


def _steps(value: Column, steps: list[tuple[float, float, str]]) -> tuple[Column, Column]:
    """The points and reason of the first step that a value reaches."""
    points, reason = F.lit(0.0), F.lit(None).cast("string")
    for least, weight, text in reversed(steps):
        at = value >= least
        points, reason = F.when(at, F.lit(weight)).otherwise(points), F.when(at, F.lit(text)).otherwise(reason)
    return points, reason


def source_similarity(a: Column, b: Column) -> Column:
    """Score (at most 1) and reasons of two fingerprints; empty values never agree. Weights and reasons."""
    parts = [(F.when(holds(a[k] == b[k]), F.lit(w)).otherwise(F.lit(0.0)), F.when(holds(a[k] == b[k]), F.lit(r))) for k, w, r in (("service", 0.25, "same service name"), ("layer", 0.20, "same layer name"), ("geometry", 0.15, "same geometry type"))]
    parts.append(_steps(jaccard(a["districts"], b["districts"]), [(1.0, 0.25, "same district fields"), (0.5, 0.15, "similar district fields")]))
    parts.append(_steps(jaccard(a["names"], b["names"]), [(1.0, 0.10, "same name fields"), (0.5, 0.05, "similar name fields")]))
    parts.append(_steps(jaccard(a["fields"], b["fields"]), [(0.8, 0.10, "high field similarity")]))
    total = parts[0][0]
    for p, _ in parts[1:]:
        total = total + p
    return F.struct(F.least(total, F.lit(1.0)).alias("score"), present([r for _, r in parts]).alias("reasons"))


def layer_similarity(a: Column, b: Column) -> Column:
    """equivalent, confidence, reasons and the three ratios of two layers. Weights and reasons.

    Reasons name a ratio's kind; ``with_ratios`` adds its two decimals.
    """
    title, district, field = (jaccard(a[k], b[k]) for k in ("words", "districts", "fields"))
    geometry = a["geometry"].isNull() | b["geometry"].isNull() | (a["geometry"] == b["geometry"])
    parts = [(F.lit(0.20), F.lit("same political district type"))]
    parts += [(F.when(holds(c), F.lit(w)).otherwise(F.lit(0.0)), F.when(holds(c), F.lit(r))) for c, w, r in ((geometry, 0.15, "same geometry type"), (a["service"] == b["service"], 0.20, "same ArcGIS service"), (a["layer"] == b["layer"], 0.15, "same ArcGIS layer name"))]
    parts.append(_steps(title, [(0.75, 0.20, "highly similar layer titles"), (0.50, 0.15, "similar layer titles"), (0.30, 0.05, "partially similar layer titles")]))
    parts.append(_steps(district, [(0.75, 0.20, "strong district-field similarity"), (5e-324, 0.10, "partial district-field similarity")]))
    parts.append(_steps(field, [(0.75, 0.10, "highly similar field structure"), (0.50, 0.05, "similar field structure")]))
    total = parts[0][0]
    for p, _ in parts[1:]:
        total = total + p
    same_url, same_type = holds(a["url"] == b["url"]), holds(a["type"] == b["type"])
    equivalent = same_url | (same_type & (total >= 0.70))
    confidence = F.when(same_url, F.lit(1.0)).when(same_type, F.least(total, F.lit(1.0))).otherwise(F.lit(0.0))
    why = F.when(same_url, F.array(F.lit("same ArcGIS layer URL"))).when(same_type, present([r for _, r in parts])).otherwise(F.array(F.lit("different political district types")))
    return F.struct(equivalent.alias("equivalent"), confidence.alias("confidence"), why.alias("reasons"), title.alias("title_ratio"), district.alias("district_ratio"), field.alias("field_ratio"))


def with_ratios(found: DataFrame, column: str = "similarity") -> DataFrame:
    """``reasons`` of layer similarities, where a reason that comes from a ratio ends with the ratio in two decimals."""
    s = F.col(column)
    ratios = found.withColumns({f"_{k}": fixed(s[f"{k}_ratio"], 2) for k in ("title", "district", "field")})
    text = F.transform(s["reasons"], lambda r: F.when(F.endswith(r, F.lit("layer titles")), F.concat(r, F.lit(" ("), F.col("_title"), F.lit(")"))).when(F.endswith(r, F.lit("district-field similarity")), F.concat(r, F.lit(" ("), F.col("_district"), F.lit(")"))).when(F.endswith(r, F.lit("field structure")), F.concat(r, F.lit(" ("), F.col("_field"), F.lit(")"))).otherwise(r))
    return ratios.withColumn("reasons", text).drop("_title", "_district", "_field")


def pairs(layers: DataFrame, key: str = "place_fips", order: str = "ord", own: bool = False) -> DataFrame:
    """The pairs of a place's layers, the earlier one second, with ``own`` also each with itself; an equi-join on the place.

    Both sides are as large as the table, whatever is estimated for them, so neither is broadcast.
    """
    a, b = layers.alias("a"), layers.alias("b")
    x, y = F.col(f"a.{order}"), F.col(f"b.{order}")
    return a.hint("merge").join(b, (F.col(f"a.{key}") == F.col(f"b.{key}")) & ((x >= y) if own else (x > y)))


def with_outcome(layers: DataFrame, outcomes: DataFrame, key: str, order: str) -> DataFrame:
    """``layers`` with the group_id, member_score and member_reasons that a place's ``outcomes`` (``out``: ord, head, score, reasons) have for them.

    Both sides are dealt by place, and a place's outcomes are one row, so they meet without a further shuffle.
    """
    mine = F.get(F.filter("out", lambda o: o["ord"] == F.col(order)), F.lit(0))
    met = layers.hint("merge").join(outcomes, key).select(*layers.columns, mine.alias("_mine"))
    return met.select(*layers.columns, F.col("_mine.head").alias("group_id"), F.col("_mine.score").alias("member_score"), F.col("_mine.reasons").alias("member_reasons"))


def grouped_sources(layers: DataFrame, threshold: float = 0.60, key: str = "place_fips", order: str = "ord") -> DataFrame:
    """For each eligible layer, in order: the first group whose first member is similar enough, else a group of its own.

    Adds group_id (the first member's order), member_score (null for the first) and member_reasons. One fold for a
    place, in the JVM; places are dealt over tasks by the number of eligible layers. A score decides on a head, and
    only the one that is taken has its reasons worked out.
    """
    prints = dealt(layers.where(eligible()), key).withColumn("_print", source_print())
    kind = prints.select("_print").schema["_print"].dataType.simpleString()
    order_kind = dict(prints.dtypes)[order]
    state = f"struct<heads:array<struct<ord:{order_kind},print:{kind}>>,out:array<struct<ord:{order_kind},head:{order_kind},score:double,reasons:array<string>>>>"

    def step(acc: Column, x: Column) -> Column:
        def after(hit: Column) -> Column:
            s, new = source_similarity(x["print"], hit["print"]), hit.isNull()
            heads = F.when(new, F.concat(acc["heads"], F.array(F.struct(x["ord"].alias("ord"), x["print"].alias("print"))))).otherwise(acc["heads"])
            row = F.struct(x["ord"].alias("ord"), F.coalesce(hit["ord"], x["ord"]).alias("head"), F.when(~new, s["score"]).alias("score"), F.when(new, F.array(F.lit("initial candidate"))).otherwise(s["reasons"]).alias("reasons"))
            return F.struct(heads.alias("heads"), F.concat(acc["out"], F.array(row)).alias("out"))

        near = F.filter(acc["heads"], lambda h: source_similarity(x["print"], h["print"])["score"] >= threshold)
        # One element, the first such head or null: what follows has it by name and doesn't look for it again.
        return F.get(F.transform(F.array(F.get(near, F.lit(0))), after), F.lit(0)).cast(state)

    init = F.struct(F.array().alias("heads"), F.array().alias("out")).cast(state)
    folded = prints.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("ord"), F.col("_print").alias("print")))).alias("xs")).select(key, F.aggregate("xs", init, step)["out"].alias("out"))
    return with_outcome(prints.drop("_print"), folded, key, order)


def groups(members: DataFrame, key: str = "place_fips", order: str = "ord") -> DataFrame:
    """A row for each group: members, confidence and the ordered union of their reasons. The confidence starts at 1 and only rises, so it is 1."""
    listed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col("member_reasons").alias("r"))))
    return members.groupBy(key, "group_id").agg(F.count("*").alias("members"), F.greatest(F.lit(1.0), F.max(F.coalesce("member_score", F.lit(1.0)))).alias("confidence"), listed.alias("_l")).withColumn("reasons", F.array_distinct(F.flatten(F.transform("_l", lambda x: x["r"])))).drop("_l")


def deduplicable() -> Column:
    return holds(~F.col("rejected") & F.col("is_political") & F.col("is_boundary"))


def grouped_layers(layers: DataFrame, key: str = "place_fips", order: str = "ord") -> DataFrame:
    """For each layer, in order: the group that holds its most confident equivalent member, the earliest among equals.

    Adds group_id (the first member's order), member_score and member_reasons. All pairs of a place are compared in an
    equi-join; then one fold for a place, in the JVM, takes its layers in order. Each layer's pair with itself stands for
    it where nothing is close. Places are dealt over tasks once, and all this happens there.
    """
    given = dealt(layers, key)
    prints = given.select(key, order, layer_print().alias("_print"))
    found = pairs(prints, key, order, own=True).select(F.col(f"a.{key}").alias(key), F.col(f"a.{order}").alias("x"), F.col(f"b.{order}").alias("y"), layer_similarity(F.col("a._print"), F.col("b._print")).alias("similarity"))
    close = with_ratios(found.where((F.col("x") == F.col("y")) | F.col("similarity.equivalent"))).select(key, "x", "y", F.col("similarity.confidence").alias("confidence"), "reasons")
    order_kind = dict(layers.dtypes)[order]
    rows = close.groupBy(key, "x").agg(F.collect_list(F.when(F.col("x") != F.col("y"), F.struct("y", "confidence", "reasons"))).alias("near"))
    # Members stand with their group and their place in it, which say who comes first among equally close ones.
    state = f"array<struct<ord:{order_kind},home:{order_kind},place:int,score:double,reasons:array<string>>>"

    def step(done: Column, x: Column) -> Column:
        def ranked(n: Column) -> Column:
            own = F.get(F.filter(done, lambda d: d["ord"] == n["y"]), F.lit(0))
            return F.struct((-n["confidence"]).alias("far"), own["home"].alias("home"), own["place"].alias("place"), n["reasons"].alias("reasons"))

        best = F.array_min(F.transform(x["near"], ranked))

        def row(b: Column) -> Column:
            home = F.coalesce(b["home"], x["x"])
            place = F.size(F.filter(done, lambda d: d["home"] == home)) + 1
            return F.struct(x["x"].alias("ord"), home.alias("home"), place.alias("place"), (-b["far"]).alias("score"), F.coalesce(b["reasons"], F.array(F.lit("initial candidate group"))).alias("reasons"))

        return F.concat(done, F.transform(F.array(best), row)).cast(state)

    outcome = F.transform(F.aggregate("xs", F.array().cast(state), step), lambda o: F.struct(o["ord"].alias("ord"), o["home"].alias("head"), o["score"].alias("score"), o["reasons"].alias("reasons")))
    folded = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("x", "near"))).alias("xs")).select(key, outcome.alias("out"))
    return with_outcome(given, folded, key, order)


def deduplicated_layers(layers: DataFrame, **names) -> DataFrame:
    """``grouped_layers`` of the valid political boundaries."""
    return grouped_layers(layers.where(deduplicable()), **names)
