"""Checks of registries and places: for each row, the first rule that fails, else null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civigrid.functions.text import is_date, state_code, trimmed
from civigrid.functions.urls import is_http
from civigrid.operators.rules import holds

DISTRICT_TYPES = ["ward", "council-district", "aldermanic-district", "municipal-district"]
PLACE_TYPES = ["incorporated-place", "census-designated-place"]


def first_error(checks: list[tuple[Column, str]], prefix: Column | None = None) -> Column:
    """The message of the first condition that doesn't hold."""
    found = [F.when(~holds(ok), F.concat(prefix, F.lit(message)) if prefix is not None else F.lit(message)) for ok, message in checks]
    return F.coalesce(*found, F.lit(None).cast("string"))


def filled(c: Column) -> Column:
    return trimmed(c) != ""


def generated_entries(entries: DataFrame) -> DataFrame:
    """``entries`` of a generated registry (pos from 0, nested source, fields and metadata) with error."""
    col = F.col
    checks = [
        (col("placeFips").rlike(r"^[0-9]{7}$"), "placeFips must be a 7-digit Census place GEOID."),
        (filled(col("city")), "city is required."),
        (col("state").rlike("^[A-Z]{2}$"), "state must be a two-letter abbreviation."),
        (col("districtType").isin(*DISTRICT_TYPES), "invalid districtType: "),
        (col("source").isNotNull(), "source is required."),
        (is_http(col("source.url")), "source.url must be a valid HTTP or HTTPS URL."),
        (col("source.serviceType").isin("FeatureServer", "MapServer"), "source.serviceType must be FeatureServer or MapServer."),
        (filled(col("source.title")), "source.title is required."),
        (col("source.official").isNotNull(), "source.official must be a boolean."),
        (col("fields").isNotNull(), "fields is required."),
        (filled(col("fields.district")), "fields.district is required."),
        (col("metadata").isNotNull(), "metadata is required."),
        (is_date(col("metadata.generatedAt")), "metadata.generatedAt must be a valid date."),
        (col("metadata.requiresReview").isNotNull(), "metadata.requiresReview must be a boolean."),
    ]
    error = first_error(checks, F.concat(F.lit("Entry "), (col("pos") + 1).cast("string"), F.lit(": ")))
    wrong_type = F.endswith(error, F.lit("districtType: "))
    return entries.withColumn("error", F.when(wrong_type, F.concat(error, F.coalesce("districtType", F.lit("undefined")))).otherwise(error))


def package_entries(entries: DataFrame) -> DataFrame:
    """``entries`` of a registry for look-ups with error; the state is given by its code from then on."""
    col = F.col
    checks = [(col(c).isNotNull(), f"Invalid registry entry: missing {c}.") for c in ("placeFips", "city", "state", "boundaryType", "generatedFile")]
    checks += [
        (col("source").isNotNull(), "Invalid registry source: expected an object."),
        (col("source.sourceType").isNotNull(), "Invalid registry source: missing sourceType."),
        (col("source.url").isNotNull(), "Invalid registry source: missing url."),
        (col("source.fieldMapping").isNotNull(), "Invalid registry source: missing fieldMapping."),
        (col("source.fieldMapping.district").isNotNull(), "Invalid registry source: missing fieldMapping.district."),
    ]
    return entries.withColumn("error", first_error(checks)).withColumn("state", state_code(col("state")))


def place_rows(places: DataFrame) -> DataFrame:
    """``places`` (placeFips, city, state, placeType) with error and the state's code; extra columns are dropped."""
    col = F.col
    checks = [(col(c).isNotNull(), f"Invalid Census place: missing {c}.") for c in ("placeFips", "city", "state")]
    kind = col("placeType").isNull() | col("placeType").isin(*PLACE_TYPES)
    error = F.coalesce(first_error(checks), F.when(~kind, F.concat(F.lit("Invalid Census place "), col("placeFips"), F.lit(": invalid placeType."))))
    known = [c for c in ("placeFips", "city", "state", "stateFips", "placeName", "placeType") if c in places.columns]
    return places.select(*known, error.alias("error")).withColumn("state", state_code(col("state")))


def totals(checked: DataFrame) -> DataFrame:
    """Counts of valid and invalid rows."""
    return checked.agg(F.count_if(F.col("error").isNull()).alias("valid"), F.count_if(F.col("error").isNotNull()).alias("invalid"))


def document_error(version: str | None, generated_at: str | None, entries: object) -> str | None:
    """What is wrong with a generated registry as a whole."""
    from datetime import datetime

    if not isinstance(version, str) or not version.strip():
        return "version is required."
    try:
        datetime.fromisoformat(str(generated_at).replace("Z", "+00:00"))
    except ValueError:
        return "generatedAt must be a valid date."
    return None if isinstance(entries, list) else "entries must be an array."


def require_valid(checked: DataFrame) -> DataFrame:
    """Fails if any row has an error, with their number; else gives the rows back."""
    n = checked.where("error IS NOT NULL").count()
    if n:
        raise ValueError(f"Registry validation failed: {n} invalid {'entry' if n == 1 else 'entries'}.")
    return checked
