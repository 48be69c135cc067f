"""Lookups of carriers, airports and weather stations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crosswind.functions.clock import known_zone
from crosswind.operators.joins import BROADCAST_BYTES, fits_broadcast, keyed_join, lookup_join
from crosswind.schemas import AIRPORT_FEATURES


def last_wins(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key, the last one in the given order."""
    return _one_per_key(df, key, F.max_by, order)


def first_wins(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key, the first one in the given order."""
    return _one_per_key(df, key, F.min_by, order)


def _one_per_key(df: DataFrame, key: str, pick, order: list[str]) -> DataFrame:
    values = [c for c in df.columns if c != key]
    chosen = pick(F.struct(*values), F.struct(*order)).alias("chosen")
    return df.groupBy(key).agg(chosen).select(key, "chosen.*")


def lookup_carrier(
    flights: DataFrame,
    carriers: DataFrame,
    *,
    column: str = "OP_CARRIER",
    code: str = "Code",
    name: str = "Carrier",
    order: list[str] | None = None,
    output: str = "OP_CARRIER_NAME",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Flights with the carrier's name, null for unknown codes.

    With ``order`` the last of several entries of a code counts; without it the
    codes are taken to be unique.
    """
    if order:
        carriers = last_wins(carriers.select(code, name, *order), code, order)
    names = carriers.select(code, F.col(name).alias(output))
    return lookup_join(flights, names, {column: code}, limit=limit)


def clean_airports(airports: DataFrame, zone: str = "time_zone") -> DataFrame:
    """Airports whose zone is a real one or null."""
    return airports.withColumn(zone, known_zone(zone))


def lookup_airport(
    flights: DataFrame,
    airports: DataFrame,
    *,
    code: str = "code",
    sides: tuple[str, ...] = ("ORIGIN", "DEST"),
    features: dict[str, str] = AIRPORT_FEATURES,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Flights with each airport feature for both ends, null for unknown codes."""
    airports = airports.select(code, *features)
    small = fits_broadcast(airports, limit)
    for side in sides:
        named = [F.col(source).alias(f"{target}_{side}") for source, target in features.items()]
        flights = lookup_join(flights, airports.select(code, *named), {side: code}, small=small)
    return flights


def lookup_station(
    wanted: DataFrame,
    airports: DataFrame,
    stations: DataFrame,
    *,
    airport: str = "airport",
    code: str = "code",
    icao: str = "icao",
    station: str = "station",
    order: list[str] | None = None,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Wanted airports with their ICAO code and the first station of that code."""
    order = order or [station]
    needed = list(dict.fromkeys([icao, station, *order]))
    first = first_wins(stations.select(*needed), icao, order).select(icao, station)
    coded = lookup_join(wanted, airports.select(code, icao), {airport: code}, limit=limit)
    return lookup_join(
        coded, first.select(F.col(icao).alias("_icao"), station), {icao: "_icao"}, limit=limit
    )


def unmatched_airports(
    wanted: DataFrame,
    obtained: DataFrame,
    column: str = "airport",
    obtained_column: str = "airport",
) -> DataFrame:
    """Wanted airports of which nothing was obtained.

    Both sides are brought down to single keys first, so no key is heavy and
    the join needs no shuffle beyond the ones that did this.
    """
    keys, found = wanted.select(column).distinct(), obtained.select(obtained_column).distinct()
    return keyed_join(keys, found, {column: obtained_column}, "left_anti")


def backfill_missing(
    df: DataFrame,
    *,
    city: str = "city",
    state: str = "state",
    country: str = "country",
    found_city: str = "found_city",
    found_state: str = "found_state",
    found_country: str = "found_country",
    found_town: str = "found_town",
) -> DataFrame:
    """Null place names filled from found ones; a town stands in for a city."""

    def found(name: str) -> Column:
        return F.nullif(F.col(name), F.lit(""))

    return df.withColumns(
        {
            city: F.coalesce(F.col(city), found(found_city), F.col(found_town)),
            state: F.coalesce(F.col(state), found(found_state)),
            country: F.coalesce(F.col(country), found(found_country)),
        }
    )
