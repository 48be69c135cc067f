"""Delay, cancellation and diversion measures over grouping sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: a departure counts as delayed past this many minutes.
DELAYED_AFTER = 15
# Fixed value: label of a key that a grouping set leaves out.
TOTAL_LABEL = "ALL"


def avg_delay(delay: str) -> Column:
    return F.avg(delay)


def flight_count() -> Column:
    return F.count(F.lit(1))


def delayed_count(delay: str) -> Column:
    """Delayed flights; an unknown delay counts as none."""
    return F.sum(F.when(F.col(delay) > DELAYED_AFTER, 1).otherwise(0))


def flag_sum(flag: str) -> Column:
    return F.sum(flag)


def ratio(part: str, whole: str) -> Column:
    return F.col(part) / F.col(whole)


def grouped_measures(
    flights: DataFrame,
    sets: list[list[str]],
    *,
    delay: str = "DEP_DELAY",
    cancelled: str = "CANCELLED",
    diverted: str = "DIVERTED",
) -> DataFrame:
    """Measures for every grouping set, with ``grouping_id`` of the keys.

    Every measure can be added up from a finer grouping. The flights are thus
    first brought down to the finest keys, by a map-side aggregation that no
    hot key can overload, and only those few rows are multiplied by the sets.
    """
    keys = list(dict.fromkeys(key for group in sets for key in group))
    fine = flights.groupBy(*keys).agg(
        F.sum(delay).alias("delay_sum"),
        F.count(delay).alias("delay_cnt"),
        flight_count().alias("total_flight_cnt"),
        delayed_count(delay).alias("delayed_cnt"),
        flag_sum(cancelled).alias("cancelled_cnt"),
        flag_sum(diverted).alias("diverted_cnt"),
    )
    sums = [c for c in fine.columns if c not in keys]
    rolled = fine.groupingSets([[fine[k] for k in group] for group in sets], *[fine[k] for k in keys])
    totals = rolled.agg(
        F.grouping_id().cast("long").alias("grouping_id"), *[F.sum(c).alias(c) for c in sums]
    )
    return totals.select(
        *keys,
        "grouping_id",
        F.try_divide("delay_sum", "delay_cnt").alias("avg_dep_delay"),
        "total_flight_cnt",
        "delayed_cnt",
        ratio("delayed_cnt", "total_flight_cnt").alias("delay_ratio"),
        "cancelled_cnt",
        ratio("cancelled_cnt", "total_flight_cnt").alias("cancelled_ratio"),
        "diverted_cnt",
        ratio("diverted_cnt", "total_flight_cnt").alias("diverted_ratio"),
    )


def label_totals(df: DataFrame, columns: list[str], label: str = TOTAL_LABEL) -> DataFrame:
    """Null keys shown under the label for totals."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(label)) for c in columns})


def null_ratio(df: DataFrame, key: str, column: str, output: str) -> DataFrame:
    """Per key, the share of rows in which the column is null."""
    return df.groupBy(key).agg(F.avg(F.col(column).isNull().cast("double")).alias(output))
