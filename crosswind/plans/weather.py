"""Collecting weather: bounds, stations, and hours by airport."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crosswind.functions.labels import weather_code_label, weather_rule_label
from crosswind.operators.filters import date_bounds, filter_hour_range
from crosswind.operators.joins import BROADCAST_BYTES, lookup_join
from crosswind.operators.lookups import lookup_station
from crosswind.operators.unions import distinct_keys
from crosswind.schemas import WEATHER, WEATHER_NAMES
from crosswind.session import settle


def collect_weather(
    flights: DataFrame,
    airports: DataFrame,
    stations: DataFrame,
    hourly: DataFrame,
    *,
    station: str = "station",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Hours of each origin's station from the first flight to three days past the last.

    One keyed join for all airports. Stations serving several airports yield
    their hours once for each. The origins take a pass over all flights and are
    needed more than once, so they are written down.
    """
    origins = distinct_keys(flights, "ORIGIN").withColumnRenamed("ORIGIN", "airport")
    wanted = settle(origins, "origins")
    served = lookup_station(wanted, airports, stations, station=station, limit=limit)
    by_station = served.dropna(subset=[station]).select(station, "airport")
    hours = filter_hour_range(hourly, date_bounds(flights))
    tagged = lookup_join(hours, by_station, {station: station}, "inner", limit=limit)
    return tagged.select(*WEATHER.names)


def project_weather(weather: DataFrame) -> DataFrame:
    """Weather columns under the names used from here on."""
    return weather.select(*[F.col(old).alias(new) for old, new in WEATHER_NAMES.items()])


def label_weather(weather: DataFrame) -> DataFrame:
    """Weather with ``weather_condition``: the code's label, else the rules'."""
    rules = weather_rule_label(
        "precipitation", "temperature_deg_c", "relative_humidity", "wind_speed_km_per_hr"
    )
    return weather.withColumn("weather_condition", weather_code_label(F.col("coco"), rules))


def repeated_hours(weather: DataFrame) -> DataFrame:
    """Airport hours that occur more than once; each would multiply flights."""
    counts = weather.groupBy("airport", "time").agg(F.count(F.lit(1)).alias("n"))
    return counts.where("n > 1")
