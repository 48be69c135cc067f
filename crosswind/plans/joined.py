"""Flights next to the weather at both ends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crosswind.functions.clock import (
    arrival_utc,
    departure_local,
    known_zone,
    to_local,
    to_utc,
)
from crosswind.functions.labels import arrival_delay_band, departure_delay_band
from crosswind.operators.filters import sentinel_to_null
from crosswind.operators.joins import (
    BROADCAST_BYTES,
    copy_lookup,
    fits_broadcast,
    grid_join,
    key_grid,
    keyed_join,
    spread_facts,
)
from crosswind.plans.weather import label_weather, project_weather
from crosswind.schemas import FLIGHTS, JOINED, WEATHER_ROLE

ROLES = {
    "ORIGIN": ["DEP_TIME_UTC", "ORIGIN"],
    "DEST": ["ARR_TIME_UTC", "DEST"],
}

# Columns that tell flights apart; only these are read to spread a heavy hour.
FLIGHT_IDENTITY = ["FL_DATE", "OP_CARRIER", "OP_CARRIER_FL_NUM", "ORIGIN", "DEST", "CRS_DEP_TIME"]


def project_flights(flights: DataFrame) -> DataFrame:
    """The 29 columns the join needs."""
    return flights.select(*FLIGHTS.names)


def add_times(flights: DataFrame, *, roll_midnight: bool = False) -> DataFrame:
    """Flights with departure and arrival times, local and UTC."""
    zones = ["TIME_ZONE_ORIGIN", "TIME_ZONE_DEST"]
    return (
        sentinel_to_null(flights, zones)
        .withColumn(
            "DEP_TIME_LOCAL",
            departure_local(F.col("FL_DATE"), F.col("DEP_TIME"), roll_midnight=roll_midnight),
        )
        .withColumn(
            "DEP_TIME_UTC", to_utc(F.col("DEP_TIME_LOCAL"), known_zone("TIME_ZONE_ORIGIN"))
        )
        .withColumn("ARR_TIME_UTC", arrival_utc(F.col("DEP_TIME_UTC"), F.col("ACTUAL_ELAPSED_TIME")))
        .withColumn(
            "ARR_TIME_LOCAL", to_local(F.col("ARR_TIME_UTC"), known_zone("TIME_ZONE_DEST"))
        )
    )


def add_delay_bands(flights: DataFrame) -> DataFrame:
    return flights.withColumns(
        {
            "DEP_DELAY_CATEGORY": departure_delay_band(F.col("DEP_DELAY")),
            "ARR_DELAY_CATEGORY": arrival_delay_band(F.col("ARR_DELAY")),
        }
    )


def weather_role(weather: DataFrame, role: str) -> DataFrame:
    """Labelled weather as seen from one end of a flight."""
    return weather.withColumnsRenamed({name: f"{role}_{name.upper()}" for name in WEATHER_ROLE})


def join_weather(
    flights: DataFrame,
    weather: DataFrame,
    *,
    roles: tuple[str, ...] = ("ORIGIN", "DEST"),
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Flights with the labelled weather of the departure and arrival hour.

    Every flight is kept. Weather that is measured to fit is broadcast. Else
    both joins shuffle, and one count of the keys of both roles and one of the
    weather tell which airport hours are too heavy for a task, on either side.
    The two roles then read the same copied weather, shuffled once.
    """
    weather = weather.select("time", "airport", *WEATHER_ROLE)
    if fits_broadcast(weather, limit):
        for role in roles:
            on = dict(zip(ROLES[role], ["time", "airport"]))
            flights = keyed_join(flights, F.broadcast(weather_role(weather, role)), on, "left")
        return flights
    grid = key_grid(flights, [ROLES[role] for role in roles], weather, ["time", "airport"])
    copied = copy_lookup(weather, ["time", "airport"], grid)
    identity = [name for name in FLIGHT_IDENTITY if name in flights.columns]
    for role in roles:
        on = dict(zip(ROLES[role], ["time", "airport"]))
        spread = spread_facts(flights, ROLES[role], grid, identity)
        flights = grid_join(spread, weather_role(copied, role).hint("merge"), on, "left")
    return flights


def project_joined(joined: DataFrame) -> DataFrame:
    """The 43 published columns, in order."""
    return joined.select(*JOINED)


def joined_table(
    flights: DataFrame,
    weather: DataFrame,
    *,
    roll_midnight: bool = False,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Enriched flights and delivered weather to the joined table."""
    timed = add_delay_bands(add_times(project_flights(flights), roll_midnight=roll_midnight))
    return project_joined(join_weather(timed, label_weather(project_weather(weather)), limit=limit))
