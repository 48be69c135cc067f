"""Collecting flights: whitelist, carrier and airport attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crosswind.operators.filters import filter_any_missing, filter_country, filter_whitelist
from crosswind.operators.joins import lookup_join
from crosswind.operators.lookups import (
    backfill_missing,
    clean_airports,
    last_wins,
    lookup_airport,
    lookup_carrier,
)
from crosswind.operators.nearest import nearest_place
from crosswind.schemas import FLIGHTS

PLACE_COLUMNS = ["city", "state", "country"]


def prepare_airports(
    airports: DataFrame,
    whitelist: DataFrame,
    places: DataFrame | None = None,
    *,
    country: str = "US",
    radius_km: float = 50.0,
) -> DataFrame:
    """Whitelisted airports of a country, missing place names filled from places."""
    kept = clean_airports(filter_whitelist(filter_country(airports, country), whitelist, "code"))
    if places is None:
        return kept
    found = nearest_place(
        filter_any_missing(kept, PLACE_COLUMNS), places, key="code", radius_km=radius_km
    ).select("code", *[F.col(c).alias(f"found_{c}") for c in [*PLACE_COLUMNS, "town"]])
    return backfill_missing(lookup_join(kept, found, {"code": "code"})).select(*kept.columns)


def enrich_flights(
    flights: DataFrame,
    whitelist: DataFrame,
    carriers: DataFrame,
    airports: DataFrame,
    *,
    carrier_order: list[str] | None = None,
) -> DataFrame:
    """Raw flights from whitelisted airports with the looked-up columns."""
    kept = filter_whitelist(flights, whitelist)
    named = lookup_carrier(kept, carriers, order=carrier_order)
    return lookup_airport(named, airports).select(*FLIGHTS.names)


def airports_in_file_order(airports: DataFrame, position: str) -> DataFrame:
    """One entry per code, the last in the file."""
    return last_wins(airports, "code", [position]).drop(position)
