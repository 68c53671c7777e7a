"""Places: gazetteer rows to incorporated places, and look-ups among them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civigrid.functions.text import blank, census_key, coordinate, state_code, trimmed, without_place_suffix

# legal/statistical area codes and names of incorporated places.
INCORPORATED = ["25", "43", "47", "53", "CITY", "TOWN", "BOROUGH", "VILLAGE", "MUNICIPALITY"]
REQUIRED = ["GEOID", "NAME", "USPS", "LSAD"]
COORDINATES = ["INTPTLAT", "INTPTLONG"]  # not trimmed: white space alone is the number 0
OPTIONAL = ["GEOIDFQ", "ANSICODE", "FUNCSTAT", "INTPTLAT", "INTPTLONG"]


def place_type(lsad: Column) -> Column:
    return F.when(F.upper(trimmed(lsad)).isin(*INCORPORATED), "incorporated-place").otherwise("census-designated-place")


def column_index(header: list[str]) -> dict[str, str]:
    """The column for each trimmed, capitalised name; the last of equal ones. A missing required one is an error."""
    found = {h.strip().upper(): h for h in header}
    for name in REQUIRED:
        if name not in found:
            raise ValueError(f"gazetteer column {name} is missing; there are {', '.join(found)}")
    return found


def gazetteer_rows(raw: DataFrame) -> DataFrame:
    """Trimmed gazetteer columns, ``ord`` kept if there; a row without a required value fails the whole job when it is read."""
    index = column_index([c for c in raw.columns if c != "ord"])
    cols = [(F.col(f"`{index[n]}`") if n in COORDINATES else trimmed(F.col(f"`{index[n]}`"))).alias(n) if n in index else F.lit(None).cast("string").alias(n) for n in REQUIRED + OPTIONAL]
    rows = raw.select(*cols, *(["ord"] if "ord" in raw.columns else []))
    bad = F.greatest(*(blank(F.col(n)).isNull().cast("int") for n in REQUIRED)) == 1
    message = F.concat(F.lit("gazetteer row lacks a required value: "), F.concat_ws("|", *REQUIRED))
    # As a filter, so that it sees rows that a later filter leaves out.
    return rows.where(F.when(bad, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))).withColumn("USPS", F.upper("USPS"))


def places(raw: DataFrame) -> DataFrame:
    """The incorporated places of gazetteer rows, as places (all rows are checked before any is left out)."""
    rows = gazetteer_rows(raw)
    return rows.where(place_type(F.col("LSAD")) == "incorporated-place").select(
        F.col("GEOID").alias("place_fips"),
        without_place_suffix(F.col("NAME")).alias("city"),
        F.col("USPS").alias("state"),
        F.col("NAME").alias("place_name"),
        place_type(F.col("LSAD")).alias("place_type"),
        blank(F.col("GEOIDFQ")).alias("geoid_fq"),
        blank(F.col("ANSICODE")).alias("ansicode"),
        blank(F.col("FUNCSTAT")).alias("funcstat"),
        coordinate(F.col("INTPTLAT")).alias("latitude"),
        coordinate(F.col("INTPTLONG")).alias("longitude"),
        *(["ord"] if "ord" in raw.columns else []),
    )


def sorted_places(found: DataFrame) -> DataFrame:
    return found.orderBy(F.collate("state", "UNICODE"), F.collate("city", "UNICODE"), *(["ord"] if "ord" in found.columns else []))


def with_city_state(found: DataFrame, city: str, state: str) -> DataFrame:
    """Places of a name in a state given by code or name."""
    return found.where((census_key(F.col("city")) == census_key(F.lit(city))) & (state_code(F.col("state")) == state_code(F.lit(state))))


def with_name(found: DataFrame, city: str) -> DataFrame:
    return found.where(census_key(F.col("city")) == census_key(F.lit(city)))


def with_fips(found: DataFrame, fips: str) -> DataFrame:
    return found.where(F.col("place_fips") == fips)


def in_state(found: DataFrame, state: str) -> DataFrame:
    return found.where(state_code(F.col("state")) == state_code(F.lit(state)))


def first(found: DataFrame, order: str = "ord") -> DataFrame:
    return found.orderBy(order).limit(1)


def chosen(found: DataFrame, city: str = "", state: str = "", place_fips: str = "") -> DataFrame:
    """Places for a discovery run: an empty option doesn't filter; city by lower case alone, state by code alone."""
    if place_fips:
        found = found.where(F.col("place_fips") == place_fips)
    if city:
        found = found.where(F.lower(trimmed(F.col("city"))) == city.strip().lower())
    if state:
        found = found.where(F.upper(F.col("state")) == state.upper())
    return found
