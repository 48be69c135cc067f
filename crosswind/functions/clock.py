"""Local clock, UTC and arrival times.

All times are ``timestamp_ntz``: a local clock has no zone of its own, and
nothing here then depends on the session's zone.
"""

from __future__ import annotations

import re
from functools import cache

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN_ZONE = "Unknown"


def known_zone(zone: str) -> Column:
    """The zone in a column, or null for the placeholder and names that are no zone.

    A name Spark does not know would fail the whole job at the first row that
    carries it. Known names are one set lookup, case-sensitive as zones are; any
    other form, such as an offset, counts if Spark itself can make a time in it.
    """
    known = F.expr(f"`{zone}` IN ({_zone_list()})")
    numbers = [F.lit(n) for n in (2000, 1, 1, 0, 0, 0)]
    converted = F.try_make_timestamp(*numbers, F.col(f"`{zone}`")).isNotNull()
    return F.when(known, F.col(f"`{zone}`")).when(converted, F.col(f"`{zone}`"))


@cache
def _zone_list() -> str:
    """Region and short names the running Java knows, as SQL literals."""
    zones = SparkContext.getOrCreate()._jvm.java.time.ZoneId
    listed = f"{zones.getAvailableZoneIds().toString()}{zones.SHORT_IDS.keySet().toString()}"
    return ", ".join(f"'{name}'" for name in sorted(set(re.findall(r"[^][, ]+", listed))))


def clock_hour(hhmm: Column, *, roll_midnight: bool = False) -> Column:
    """Hour of an HHMM number; 2400 is null, or 24 when midnight may roll over."""
    hour = F.floor(hhmm / 100).cast("int")
    return F.when(hour.between(0, 24 if roll_midnight else 23), hour)


def departure_local(date: Column, hhmm: Column, *, roll_midnight: bool = False) -> Column:
    """Date plus the full hour of an HHMM number; minutes are dropped."""
    hour = clock_hour(hhmm, roll_midnight=roll_midnight)
    return F.timestamp_add("HOUR", hour, date.cast("timestamp_ntz"))


def to_utc(local: Column, zone: Column) -> Column:
    """Local time to UTC. A repeated autumn hour takes its first occurrence."""
    return F.convert_timezone(zone, F.lit("UTC"), local)


def to_local(utc: Column, zone: Column) -> Column:
    """UTC to the local time of a zone."""
    return F.convert_timezone(F.lit("UTC"), zone, utc)


def arrival_utc(departure: Column, elapsed_minutes: Column) -> Column:
    """Departure plus the elapsed time in whole hours, halves rounded up."""
    hours = F.round(elapsed_minutes / 60).try_cast("int")
    return F.timestamp_add("HOUR", hours, departure)
