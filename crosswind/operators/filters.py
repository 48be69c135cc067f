"""Row filters."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crosswind.functions.clock import UNKNOWN_ZONE
from crosswind.operators.joins import BROADCAST_BYTES, lookup_join


def filter_whitelist(
    facts: DataFrame,
    whitelist: DataFrame,
    column: str = "ORIGIN",
    key: str = "ORIGIN",
    *,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows whose ``column`` is on the list."""
    return lookup_join(facts, whitelist, {column: key}, "left_semi", limit=limit)


def filter_country(airports: DataFrame, country: str = "US", column: str = "country") -> DataFrame:
    return airports.filter(F.col(column) == country)


def any_missing(columns: list[str]) -> Column:
    """True where at least one of the columns is null."""
    return reduce(Column.__or__, (F.col(c).isNull() for c in columns))


def filter_any_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.filter(any_missing(columns))


def sentinel_to_null(df: DataFrame, columns: list[str], sentinel: str = UNKNOWN_ZONE) -> DataFrame:
    """The placeholder text turned into null in each column."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit(sentinel)) for c in columns})


def date_bounds(facts: DataFrame, column: str = "FL_DATE", days_after: int = 3) -> DataFrame:
    """One row: first date, and the last date plus some days."""
    day = F.col(column)
    return facts.agg(
        F.min(day).alias("start_date"), F.date_add(F.max(day), days_after).alias("end_date")
    )


def filter_hour_range(
    hourly: DataFrame,
    start: DataFrame | date | str,
    end: date | str | None = None,
    time: str = "time",
) -> DataFrame:
    """Hours from ``start`` to ``end``, both included.

    ``start`` may be the one-row result of :func:`date_bounds`; it then enters
    the scan as a scalar subquery, so the file reader can skip on it.
    """
    if isinstance(start, DataFrame):
        bounds = start
        low = bounds.select(F.col("start_date").cast("timestamp_ntz")).scalar()
        high = bounds.select(F.col("end_date").cast("timestamp_ntz")).scalar()
    else:
        low, high = (F.lit(str(b)).cast("timestamp_ntz") for b in (start, end))
    return hourly.filter(F.col(time).between(low, high))
