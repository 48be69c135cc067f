"""Calendar columns of a timestamp."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The months of each season.
SEASONS = {
    "Winter": [12, 1, 2],
    "Spring": [3, 4, 5],
    "Summer": [6, 7, 8],
    "Autumn": [9, 10, 11],
}
# Saturday and Sunday, counted from Sunday = 0.
WEEKEND_DAYS = [0, 6]


def day_of_week(ts: Column) -> Column:
    """Sunday = 0 to Saturday = 6."""
    return F.dayofweek(ts) - 1


def is_weekend(ts: Column) -> Column:
    """1 on Saturdays and Sundays, else 0, also for null."""
    return F.when(day_of_week(ts).isin(WEEKEND_DAYS), 1).otherwise(0)


def is_weekday(ts: Column) -> Column:
    """1 on Mondays to Fridays, else 0, also for null."""
    return F.when(~day_of_week(ts).isin(WEEKEND_DAYS), 1).otherwise(0)


def season(month: Column) -> Column:
    """Season of a month number, null for null and for what is no month."""
    return F.coalesce(*[F.when(month.isin(months), name) for name, months in SEASONS.items()])


def calendar_columns(ts: Column) -> dict[str, Column]:
    """All calendar columns, named as in the published table."""
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "dow": day_of_week(ts),
        "dayname": F.dayname(ts),
        "is_weekend": is_weekend(ts),
        "is_weekday": is_weekday(ts),
        "season": season(F.month(ts)),
    }
