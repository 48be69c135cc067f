"""Times of flights, at the edges of clocks and zones."""

from __future__ import annotations

from pyspark.sql import functions as F

from crosswind.functions import clock
from crosswind.plans.joined import add_times

NEW_YORK, CHICAGO = "America/New_York", "America/Chicago"

FLIGHTS = [
    # date, HHMM, elapsed, zone of both ends, local, departure UTC, arrival UTC, arrival local
    ("2018-01-01", 905.0, 90.0, NEW_YORK, "01-01 09", "01-01 14", "01-01 16", "01-01 11"),
    ("2018-01-01", None, None, NEW_YORK, None, None, None, None),
    ("2018-01-01", 2400.0, 30.0, CHICAGO, None, None, None, None),
    ("2018-01-01", 1530.0, 89.0, None, "01-01 15", None, None, None),
    ("2018-01-01", 1530.0, 89.0, "Unknown", "01-01 15", None, None, None),
    ("2018-01-01", 1530.0, 89.0, "Mars/Base", "01-01 15", None, None, None),
    ("2018-03-11", 230.0, 60.0, NEW_YORK, "03-11 02", "03-11 07", "03-11 08", "03-11 04"),
    ("2018-11-04", 130.0, 60.0, NEW_YORK, "11-04 01", "11-04 05", "11-04 06", "11-04 01"),
    ("2018-01-01", 5.0, 29.0, NEW_YORK, "01-01 00", "01-01 05", "01-01 05", "01-01 00"),
    ("2018-01-01", 2359.0, None, NEW_YORK, "01-01 23", "01-02 04", None, None),
    (None, 905.0, 90.0, NEW_YORK, None, None, None, None),
]


def timed(spark, **options):
    rows = [(i, d, t, e, z, z) for i, (d, t, e, z, *_) in enumerate(FLIGHTS)]
    df = spark.createDataFrame(
        rows,
        "i int, FL_DATE string, DEP_TIME double, ACTUAL_ELAPSED_TIME double,"
        " TIME_ZONE_ORIGIN string, TIME_ZONE_DEST string",
    ).withColumn("FL_DATE", F.col("FL_DATE").cast("date"))
    columns = ["DEP_TIME_LOCAL", "DEP_TIME_UTC", "ARR_TIME_UTC", "ARR_TIME_LOCAL"]
    out = add_times(df, **options)
    assert all(dict(out.dtypes)[c] == "timestamp_ntz" for c in columns)
    shown = out.select("i", *[F.substring(F.col(c).cast("string"), 6, 8).alias(c) for c in columns])
    return {r[0]: tuple(r)[1:] for r in shown.collect()}


def test_times_of_edge_flights(spark):
    got = timed(spark)
    assert [got[i] for i in range(len(FLIGHTS))] == [row[4:] for row in FLIGHTS]


def test_times_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = timed(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [got[i] for i in range(len(FLIGHTS))] == [row[4:] for row in FLIGHTS]


def test_midnight_may_roll_over(spark):
    assert timed(spark, roll_midnight=True)[2] == ("01-02 00", "01-02 06", "01-02 07", "01-02 01")


def test_only_real_zones_are_kept(spark):
    zones = [NEW_YORK, "US/Eastern", "UTC", "EST", "+05:30", "Unknown", "Mars/Base", "america/denver", "", None]
    df = spark.createDataFrame([(z,) for z in zones], "z string")
    kept = [r[0] for r in df.select(clock.known_zone("z")).collect()]
    assert kept == zones[:5] + [None] * 5
    hour = F.lit("2018-06-01 12:00:00").cast("timestamp_ntz")
    known = df.withColumn("z", clock.known_zone("z"))
    assert known.select(clock.to_utc(hour, F.col("z")).alias("u")).where("u IS NOT NULL").count() == 5


def test_elapsed_hours_round_half_up(spark):
    df = spark.createDataFrame([(m,) for m in (29.0, 30.0, 89.0, 90.0, 149.9, 150.0)], "m double")
    start = F.lit("2018-01-01 00:00:00").cast("timestamp_ntz")
    got = df.select(F.hour(clock.arrival_utc(start, F.col("m"))).alias("h")).collect()
    assert [r.h for r in got] == [0, 1, 1, 2, 2, 3]


def test_every_listed_zone_converts(spark):
    names = clock._zone_list()
    df = spark.sql(f"SELECT explode(array({names})) AS z")
    hour = F.lit("2018-06-01 12:00:00").cast("timestamp_ntz")
    known = df.select("z", clock.to_utc(hour, clock.known_zone("z")).alias("u"))
    assert known.where("u IS NULL").count() == 0
    assert known.count() > 500


def test_every_zone_that_spark_converts_is_kept(spark):
    from crosswind.functions.clock import known_zone, to_utc

    good = ["UTC+05:00", "GMT+5", "+18:00", "+5:30", "Z", "-03:15", "Europe/Paris", "EST", "UTC", "+01:02:03"]
    bad = ["Unknown", "Mars/Base", "america/denver", "", "+19:00", "5"]
    zones = spark.createDataFrame([(z,) for z in [*good, *bad, None]], "zone string")
    local = F.lit("2018-07-01 12:00:00").cast("timestamp_ntz")
    kept = zones.select("zone", known_zone("zone").alias("known"), to_utc(local, known_zone("zone")).alias("utc"))
    rows = {r.zone: (r.known, r.utc) for r in kept.collect()}
    assert all(rows[z][0] == z and rows[z][1] is not None for z in good)
    assert all(rows[z] == (None, None) for z in [*bad, None])


def test_months_of_seasons(spark):
    from crosswind.functions.calendar import season

    months = spark.createDataFrame([(m,) for m in [None, *range(-1, 15)]], "m int")
    named = {r.m: r.s for r in months.select("m", season(F.col("m")).alias("s")).collect()}
    assert [named[m] for m in (12, 1, 2, 3, 5, 6, 8, 9, 11)] == ["Winter"] * 3 + ["Spring"] * 2 + ["Summer"] * 2 + ["Autumn"] * 2
    assert {named[m] for m in (None, -1, 0, 13, 14)} == {None}
