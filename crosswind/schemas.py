"""Declared columns of the files and tables."""

from __future__ import annotations

from pyspark.sql.types import StructType


def columns(text: str) -> StructType:
    """A schema from ``name type, name type``; needs no session, unlike DDL."""
    schema = StructType()
    for part in text.split(","):
        name, kind = part.split()
        schema.add(name, kind)
    return schema


# What the yearly flight files hold.
RAW_FLIGHTS = columns("""
    FL_DATE date, OP_CARRIER string, OP_CARRIER_FL_NUM integer, ORIGIN string, DEST string,
    CRS_DEP_TIME double, DEP_TIME double, DEP_DELAY double,
    CRS_ARR_TIME double, ARR_TIME double, ARR_DELAY double,
    CANCELLED double, DIVERTED double, ACTUAL_ELAPSED_TIME double
""")

# Airport attributes looked up for both ends of a flight.
AIRPORT_FEATURES = {
    "time_zone": "TIME_ZONE",
    "city": "CITY",
    "state": "STATE",
    "country": "COUNTRY",
    "longitude": "LONGITUDE",
    "latitude": "LATITUDE",
    "name": "AIRPORT_NAME",
}

# The enriched flight file: the raw columns, then what the lookups add.
FLIGHTS = StructType(
    RAW_FLIGHTS.fields
    + columns("""
    TIME_ZONE_ORIGIN string, TIME_ZONE_DEST string, CITY_ORIGIN string, CITY_DEST string,
    STATE_ORIGIN string, STATE_DEST string, COUNTRY_ORIGIN string, COUNTRY_DEST string,
    LONGITUDE_ORIGIN double, LONGITUDE_DEST double, LATITUDE_ORIGIN double, LATITUDE_DEST double,
    OP_CARRIER_NAME string, AIRPORT_NAME_ORIGIN string, AIRPORT_NAME_DEST string
""").fields
)

# Hourly weather as delivered, and the names it gets.
WEATHER = columns("""
    time timestamp_ntz, temp double, prcp double, rhum double, wspd double, airport string, coco integer
""")
WEATHER_NAMES = {
    "time": "time",
    "temp": "temperature_deg_c",
    "prcp": "precipitation",
    "rhum": "relative_humidity",
    "wspd": "wind_speed_km_per_hr",
    "airport": "airport",
    "coco": "coco",
}

WHITELIST = columns("""
    ORIGIN string, AIRPORT string, WEATHER_NULL_RATIO double, PASSENGERS long, FREIGHT_TONS long
""")
CARRIERS = columns("Code string, Carrier string")
AIRPORTS = columns("""
    code string, icao string, time_zone string, city string, state string, country string,
    name string, latitude double, longitude double
""")

STATIONS = columns("icao string, station string")
# Hourly values by station, from which the weather of each airport is taken.
HOURLY = columns("""
    time timestamp_ntz, station string, temp double, prcp double, rhum double, wspd double, coco integer
""")
# Places that stand in for missing city, state and country names.
PLACES = columns("""
    city string, state string, country string, town string, latitude double, longitude double
""")

# Measures of a weather role in the joined table, in output order.
WEATHER_ROLE = [
    "temperature_deg_c",
    "wind_speed_km_per_hr",
    "relative_humidity",
    "precipitation",
    "weather_condition",
]

# The joined table, in output order.
JOINED = [
    "FL_DATE",
    "ORIGIN",
    "DEST",
    "OP_CARRIER",
    "OP_CARRIER_FL_NUM",
    "OP_CARRIER_NAME",
    "AIRPORT_NAME_ORIGIN",
    "AIRPORT_NAME_DEST",
    "CRS_DEP_TIME",
    "DEP_TIME",
    "DEP_DELAY",
    "DEP_DELAY_CATEGORY",
    "CANCELLED",
    "DIVERTED",
    "CITY_ORIGIN",
    "STATE_ORIGIN",
    "COUNTRY_ORIGIN",
    "LONGITUDE_ORIGIN",
    "LATITUDE_ORIGIN",
    "TIME_ZONE_DEST",
    "TIME_ZONE_ORIGIN",
    "DEP_TIME_LOCAL",
    "DEP_TIME_UTC",
    "ARR_TIME_LOCAL",
    "ARR_TIME_UTC",
    "ARR_TIME",
    "ARR_DELAY",
    "ARR_DELAY_CATEGORY",
    "CITY_DEST",
    "STATE_DEST",
    "COUNTRY_DEST",
    "LONGITUDE_DEST",
    "LATITUDE_DEST",
    "ORIGIN_TEMPERATURE_DEG_C",
    "ORIGIN_WIND_SPEED_KM_PER_HR",
    "ORIGIN_RELATIVE_HUMIDITY",
    "ORIGIN_PRECIPITATION",
    "ORIGIN_WEATHER_CONDITION",
    "DEST_TEMPERATURE_DEG_C",
    "DEST_WIND_SPEED_KM_PER_HR",
    "DEST_RELATIVE_HUMIDITY",
    "DEST_PRECIPITATION",
    "DEST_WEATHER_CONDITION",
]
