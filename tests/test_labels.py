"""Delay bands, weather labels and calendar columns at every edge."""

from __future__ import annotations

import itertools

import pytest
from pyspark.sql import functions as F

from crosswind.functions import calendar, labels


def test_delay_bands_at_their_bounds(spark):
    expected = {
        None: "Extreme Delay",
        -1.0: "Early_Departure",
        0.0: "On-Time",
        15.0: "On-Time",
        15.5: "Minor Delay",
        30.0: "Minor Delay",
        31.0: "Moderate Delay",
        60.0: "Moderate Delay",
        61.0: "Severe Delay",
        120.0: "Severe Delay",
        121.0: "Extreme Delay",
    }
    df = spark.createDataFrame([(k,) for k in expected], "d double")
    rows = df.select(
        "d",
        labels.departure_delay_band(F.col("d")).alias("departure"),
        labels.arrival_delay_band(F.col("d")).alias("arrival"),
        labels.departure_delay_band(F.col("d"), unknown="No Delay Known").alias("own"),
    ).collect()
    for row in rows:
        label = expected[row.d]
        assert row.departure == label
        assert row.arrival == label.replace("Early_Departure", "Early_Arrival")
        assert row.own == (label if row.d is not None else "No Delay Known")


WEATHER_CASES = [
    # precipitation, temperature, humidity, wind, label
    (0.0, -2.0, 49.0, 19.0, "Clear"),
    (0.0, 35.0, 49.0, 19.0, "Clear"),
    (0.0, 35.5, 49.0, 19.0, "Unknown"),
    (0.0, 20.0, 50.0, 29.0, "Partly Cloudy"),
    (0.0, 45.0, 75.0, 29.0, "Partly Cloudy"),
    (0.0, 45.0, 75.5, 90.0, "Cloudy"),
    (0.01, 2.0, 56.0, 24.0, "Unknown"),
    (0.02, 2.0, 56.0, 24.0, "Light Rain"),
    (10.0, 45.0, 56.0, 24.0, "Light Rain"),
    (10.5, 45.0, 66.0, 24.0, "Heavy Rain"),
    (0.06, 1.9, 56.0, 24.0, "Snow"),
    (0.06, -20.0, 56.0, 99.0, "Snow"),
    (2.5, -20.5, 61.0, 10.0, "Heavy Snow"),
    (2.5, -30.0, 61.0, 10.0, "Heavy Snow"),
    (1.5, 10.0, 56.0, 25.0, "Windy Rain"),
    (2.5, 10.0, 61.0, 35.0, "Windy Rain"),
    (2.5, 10.0, 61.0, 35.5, "Stormy"),
    (2.5, 10.0, 61.0, 40.0, "Stormy"),
    (2.5, -30.5, 61.0, 40.0, "Blizzard"),
    (2.5, -30.5, 61.0, 50.0, "Blizzard"),
    (5.5, 10.0, 71.0, 50.5, "Severe Storm"),
    (0.0, 35.5, 29.0, 19.0, "Hot and Dry"),
    (0.0, -15.5, 40.0, 19.0, "Extreme Cold"),
    (0.0, -15.0, 40.0, 19.0, "Unknown"),
    (None, 20.0, 40.0, 10.0, "Unknown"),
    (0.0, None, 40.0, 10.0, "Unknown"),
    (None, -16.0, None, 10.0, "Extreme Cold"),
]


def test_weather_rules_at_their_edges(spark):
    df = spark.createDataFrame(WEATHER_CASES, "p double, t double, h double, w double, label string")
    rule = labels.weather_rule_label("p", "t", "h", "w")
    wrong = df.withColumn("got", rule).where("NOT got <=> label").collect()
    assert wrong == []


def test_every_weather_label_can_be_reached(spark):
    grid = itertools.product(
        [0.0, 0.06, 1.5, 3.0, 6.0, 11.0],
        [-35.0, -25.0, -16.0, 0.0, 10.0, 40.0],
        [20.0, 60.0, 80.0],
        [10.0, 30.0, 38.0, 45.0, 60.0],
    )
    df = spark.createDataFrame(list(grid), "p double, t double, h double, w double")
    seen = df.select(labels.weather_rule_label("p", "t", "h", "w").alias("l")).distinct().collect()
    assert {r.l for r in seen} == {name for name, _ in labels.WEATHER_RULES} | {"Unknown"}


def test_codes_override_rules(spark):
    codes = [None, 0, *range(1, 28), 28]
    df = spark.createDataFrame([(c,) for c in codes], "code int")
    got = {
        r.code: r.label
        for r in df.select(
            "code", labels.weather_code_label(F.col("code"), F.lit("rule")).alias("label")
        ).collect()
    }
    assert [got[c] for c in (None, 0, 28)] == ["rule"] * 3
    assert all(got[c] == label for label, cs in labels.WEATHER_CODES.items() for c in cs)
    assert sorted(c for cs in labels.WEATHER_CODES.values() for c in cs) == list(range(1, 28))


@pytest.mark.parametrize(
    ("day", "expected"),
    [
        ("2018-01-06", (2018, 1, 6, 6, "Sat", 1, 0, "Winter")),
        ("2018-03-04", (2018, 3, 4, 0, "Sun", 1, 0, "Spring")),
        ("2018-08-31", (2018, 8, 31, 5, "Fri", 0, 1, "Summer")),
        ("2018-09-03", (2018, 9, 3, 1, "Mon", 0, 1, "Autumn")),
        ("2018-12-25", (2018, 12, 25, 2, "Tue", 0, 1, "Winter")),
        (None, (None, None, None, None, None, 0, 0, None)),
    ],
)
def test_calendar_columns(spark, day, expected):
    df = spark.createDataFrame([(day,)], "d string").select(F.col("d").cast("timestamp_ntz").alias("ts"))
    assert tuple(df.select(*[c.alias(n) for n, c in calendar.calendar_columns(F.col("ts")).items()]).first()) == expected
