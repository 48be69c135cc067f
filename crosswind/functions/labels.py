"""Delay bands and weather labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels of delays by their upper bound in minutes, bound included.
DELAY_BANDS = [
    (15, "On-Time"),
    (30, "Minor Delay"),
    (60, "Moderate Delay"),
    (120, "Severe Delay"),
]
EXTREME_DELAY = "Extreme Delay"
EARLY_DEPARTURE = "Early_Departure"
EARLY_ARRIVAL = "Early_Arrival"

# Weather labels by precipitation p, temperature t (deg C),
# relative humidity h and wind speed w (km/h). The first rule that holds wins.
WEATHER_RULES = [
    ("Clear", "p = 0 AND t BETWEEN -2 AND 35 AND h < 50 AND w < 20"),
    ("Partly Cloudy", "p = 0 AND t BETWEEN -10 AND 45 AND h BETWEEN 50 AND 75 AND w < 30"),
    ("Cloudy", "p = 0 AND t BETWEEN -10 AND 45 AND h > 75"),
    ("Light Rain", "p > 0.01 AND p <= 10 AND t BETWEEN 2 AND 45 AND h > 55 AND w < 25"),
    ("Heavy Rain", "p > 10 AND t BETWEEN 2 AND 45 AND h > 65 AND w < 25"),
    ("Snow", "p > 0.05 AND t BETWEEN -20 AND 2 AND h > 55"),
    ("Heavy Snow", "p > 2 AND t BETWEEN -30 AND 2 AND h > 60"),
    ("Windy Rain", "w BETWEEN 25 AND 35 AND p > 1 AND h > 55"),
    ("Stormy", "w BETWEEN 35 AND 40 AND t > -5 AND p > 2 AND h > 60"),
    ("Blizzard", "t < -5 AND w BETWEEN 40 AND 50 AND p > 2 AND h > 60"),
    ("Severe Storm", "w > 50 AND p > 5 AND h > 70"),
    ("Hot and Dry", "t > 35 AND h < 30 AND w < 20"),
    ("Extreme Cold", "t < -15 AND w < 20"),
]
UNKNOWN_WEATHER = "Unknown"

# Station condition codes that override the rules.
WEATHER_CODES = {
    "Clear": [1, 2],
    "Cloudy": [3, 4, 5, 6],
    "Light Rain": [7, 8, 17],
    "Heavy Rain": [9, 10, 11, 18],
    "Snow": [12, 14, 15, 19, 21, 24],
    "Heavy Snow": [13, 16, 20, 22],
    "Stormy": [23, 25, 27],
    "Severe Storm": [26],
}


def delay_band(minutes: Column, early: str, *, unknown: str = EXTREME_DELAY) -> Column:
    """Band of a delay. A null delay gets ``unknown``, by default the last band."""
    band = F.when(minutes < 0, early)
    for bound, label in DELAY_BANDS:
        band = band.when(minutes <= bound, label)
    return band.when(minutes.isNull(), unknown).otherwise(EXTREME_DELAY)


def departure_delay_band(minutes: Column, *, unknown: str = EXTREME_DELAY) -> Column:
    return delay_band(minutes, EARLY_DEPARTURE, unknown=unknown)


def arrival_delay_band(minutes: Column, *, unknown: str = EXTREME_DELAY) -> Column:
    return delay_band(minutes, EARLY_ARRIVAL, unknown=unknown)


def weather_rule_label(
    precipitation: str, temperature: str, humidity: str, wind: str
) -> Column:
    """Label from measured values, given as column names."""
    names = {"p": precipitation, "t": temperature, "h": humidity, "w": wind}
    rules = " ".join(f"WHEN {_rename(rule, names)} THEN '{label}'" for label, rule in WEATHER_RULES)
    return F.expr(f"CASE {rules} ELSE '{UNKNOWN_WEATHER}' END")


def _rename(rule: str, names: dict[str, str]) -> str:
    return " ".join(f"`{names[word]}`" if word in names else word for word in rule.split(" "))


def weather_code_label(code: Column, rule_label: Column) -> Column:
    """Label of the station's condition code, the rule label where it has none."""
    by_code = F.lit(None).cast("string")
    for label, codes in WEATHER_CODES.items():
        by_code = F.when(code.isin(codes), label).otherwise(by_code)
    return F.coalesce(by_code, rule_label)
