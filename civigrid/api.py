"""The public functions, by the names of the tasks. All take and return DataFrames unless they say otherwise."""

from __future__ import annotations

from pyspark.sql import DataFrame

from civigrid.operators.classify import classified as classify_candidates
from civigrid.operators.fields import inspected as inspect_candidates
from civigrid.operators.geojson import normalised as normalize_geojson
from civigrid.operators.places import first, in_state, with_city_state, with_fips, with_name
from civigrid.operators.registry import first_matching as find_registry_entry
from civigrid.operators.registry import matching as find_registry_entries
from civigrid.operators.selection import group_sources as select_canonical_sources
from civigrid.operators.selection import place_sources as select_municipality_canonical_source
from civigrid.operators.similarity import deduplicated_layers as dedupe_candidates
from civigrid.operators.similarity import grouped_layers as group_equivalent_candidates
from civigrid.operators.similarity import grouped_sources as detect_equivalent_layers
from civigrid.operators.similarity import layer_print as create_layer_fingerprint
from civigrid.operators.similarity import layer_similarity as compare_candidates
from civigrid.plans.discovery import discovered as discover
from civigrid.plans.lookup import lookup as lookup_districts
from civigrid.plans.lookup import lookup_one as lookup_municipal_district
from civigrid.sources.documents import read_boundaries, read_generated, write_registry
from civigrid.sources.documents import read_package as load_registry
from civigrid.sources.gazetteer import generate_places
from civigrid.sources.gazetteer import read_places as load_census_places

search_registry = search_municipal_districts = find_registry_entries
find_municipality = find_registry_entry


def find_municipal_district_sources(entries: DataFrame, city: str, state: str | None = None) -> DataFrame:
    return find_registry_entries(entries, city=city, state=state)


def find_boundary_sources(entries: DataFrame, boundary_type: str, **options) -> DataFrame:
    """The given type stands over one in ``options``."""
    return find_registry_entries(entries, **options | {"boundary_type": boundary_type})


def find_census_place(places: DataFrame, city: str, state: str) -> DataFrame:
    return first(with_city_state(places, city, state))


def find_census_places_by_name(places: DataFrame, city: str) -> DataFrame:
    return with_name(places, city)


def find_census_place_by_fips(places: DataFrame, fips: str) -> DataFrame:
    return first(with_fips(places, fips))


def find_census_places_by_state(places: DataFrame, state: str) -> DataFrame:
    return in_state(places, state)


__all__ = [n for n in dir() if not n.startswith("_") and n not in ("annotations", "DataFrame", "first", "in_state", "with_city_state", "with_fips", "with_name")]
