"""Published tables and views over the joined table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crosswind.functions.calendar import calendar_columns
from crosswind.operators.aggregates import grouped_measures, label_totals, null_ratio
from crosswind.operators.joins import BROADCAST_BYTES, keyed_join, lookup_join

CARRIER = ["op_carrier", "op_carrier_name"]
ORIGIN = ["origin", "airport_name_origin", "longitude_origin", "latitude_origin"]
DEST = ["dest", "airport_name_dest", "longitude_dest", "latitude_dest"]

# The grouping sets of both views.
LOCALE_SETS = [[], ORIGIN, DEST, CARRIER, CARRIER + ORIGIN, CARRIER + ORIGIN + DEST]
TIME_SETS = [["season"], ["dayname"], ["day"], ["month"], ["year"]]

LABELLED = [
    "origin",
    "dest",
    "airport_name_origin",
    "airport_name_dest",
    "op_carrier_name",
    "op_carrier",
]
COORDINATES = ["longitude_origin", "latitude_origin", "longitude_dest", "latitude_dest"]
COUNTS_AND_RATIOS = [
    "total_flight_cnt",
    "delayed_cnt",
    "delay_ratio",
    "cancelled_cnt",
    "cancelled_ratio",
    "diverted_cnt",
    "diverted_ratio",
]


def star_plus(df: DataFrame, time: str = "DEP_TIME_UTC") -> DataFrame:
    """All columns plus the calendar columns of a time, by default UTC departure."""
    return df.withColumns(calendar_columns(F.col(time)))


def measures_by_locale(
    flights: DataFrame, *, keep_grouping_id: bool = False, labels: bool = True
) -> DataFrame:
    """Measures overall, by origin, destination, carrier and their combinations.

    A key that is really null shows the same label as a total; keep the
    grouping id to tell the two apart.
    """
    grouped = grouped_measures(flights, LOCALE_SETS)
    if labels:
        grouped = label_totals(grouped, LABELLED)
    extra = ["grouping_id"] if keep_grouping_id else []
    return grouped.select(*LABELLED, *COORDINATES, *COUNTS_AND_RATIOS, *extra)


def measures_by_time(flights: DataFrame, *, keep_grouping_id: bool = False) -> DataFrame:
    """Measures by season, weekday name, day of month, month and year."""
    extra = ["grouping_id"] if keep_grouping_id else []
    return grouped_measures(flights, TIME_SETS).select(
        "year", "month", "day", "dayname", "season", "avg_dep_delay", *COUNTS_AND_RATIOS, *extra
    )


def airport_profile(
    flights: DataFrame,
    weather: DataFrame,
    traffic: DataFrame,
    names: DataFrame | None = None,
    *,
    airport: str = "ORIGIN",
    time: str = "DEP_TIME_UTC",
    traffic_airport: str = "ORIGIN",
    passengers: str = "PASSENGERS",
    freight: str = "FREIGHT_TONS",
    max_null_ratio: float | None = None,
    min_passengers: float | None = None,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Per airport: share of flights without weather at departure, traffic totals, and its name.

    Flights count once each, however often their hour occurs in the ``weather``,
    of which ``time`` and ``airport`` are read. ``names`` has ``code`` and
    ``name``. The thresholds that make a whitelist of it are the caller's, and
    its columns are those of a whitelist file.
    """
    hours = weather.select("time", "airport").distinct().withColumn("_known", F.lit(1))
    met = lookup_join(
        flights.select(airport, time), hours, {time: "time", airport: "airport"}, limit=limit
    )
    ratios = null_ratio(met, airport, "_known", "WEATHER_NULL_RATIO")
    totals = traffic.groupBy(traffic_airport).agg(
        F.sum(passengers).alias("PASSENGERS"), F.sum(freight).alias("FREIGHT_TONS")
    )
    profile = keyed_join(ratios, totals, {airport: traffic_airport}, "left")
    if names is not None:
        named = names.groupBy("code").agg(F.min("name").alias("AIRPORT"))
        profile = keyed_join(profile, named, {airport: "code"}, "left")
    else:
        profile = profile.withColumn("AIRPORT", F.lit(None).cast("string"))
    if max_null_ratio is not None:
        profile = profile.filter(F.col("WEATHER_NULL_RATIO") <= max_null_ratio)
    if min_passengers is not None:
        profile = profile.filter(F.col("PASSENGERS") >= min_passengers)
    return profile.select(airport, "AIRPORT", "WEATHER_NULL_RATIO", "PASSENGERS", "FREIGHT_TONS")
