"""Whole jobs: invariants of the results, and the shape of the physical plans."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from checks.views import table, view
from crosswind.operators.aggregates import grouped_measures
from crosswind.operators.filters import filter_hour_range, date_bounds, filter_whitelist
from crosswind.plans import joined, measures
from crosswind.plans.flights import prepare_airports
from crosswind.plans.weather import label_weather, project_weather, repeated_hours
from crosswind.schemas import JOINED

SF_DIR = "/root/testdata/sf0.001"


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def flights(spark):
    return view(spark, SF_DIR, "flights")


@pytest.fixture(scope="module")
def weather(spark):
    return view(spark, SF_DIR, "weather")


def test_joined_table_keeps_every_flight(flights, weather):
    assert repeated_hours(weather).count() == 0
    for limit in (0, 1 << 26):
        out = joined.joined_table(flights, weather, limit=limit)
        assert out.columns == JOINED
        assert len(out.columns) == 43
        assert out.count() == flights.count()


def test_repeated_weather_multiplies_flights(spark, flights, weather):
    doubled = weather.unionByName(weather)
    assert repeated_hours(doubled).count() == weather.count()
    once = joined.joined_table(flights, weather)
    matches = once.select(
        F.sum(
            F.when(F.col("ORIGIN_WEATHER_CONDITION").isNull(), 1).otherwise(2)
            * F.when(F.col("DEST_WEATHER_CONDITION").isNull(), 1).otherwise(2)
        )
    ).first()[0]
    for limit in (0, 1 << 26):
        assert joined.joined_table(flights, doubled, limit=limit).count() == matches


def test_a_third_of_the_flights_in_one_hour(spark, flights, weather):
    """One airport hour with a third of all rows joins the same either way."""
    hot = F.col("OP_CARRIER_FL_NUM") % 3 == 0
    skewed = flights.withColumns(
        {
            "FL_DATE": F.when(hot, F.lit("2024-01-10").cast("date")).otherwise(F.col("FL_DATE")),
            "DEP_TIME": F.when(hot, 905.0).otherwise(F.col("DEP_TIME")),
            "ORIGIN": F.when(hot, "click").otherwise(F.col("ORIGIN")),
            "TIME_ZONE_ORIGIN": F.when(hot, "America/Chicago").otherwise(F.col("TIME_ZONE_ORIGIN")),
        }
    )
    small = joined.joined_table(skewed, weather)
    large = joined.joined_table(skewed, weather, limit=0)
    assert small.exceptAll(large).count() == 0
    assert large.exceptAll(small).count() == 0


def test_totals_of_every_grouping_set(flights):
    rows = measures.measures_by_locale(flights, keep_grouping_id=True)
    sums = rows.groupBy("grouping_id").agg(F.sum("total_flight_cnt").alias("n")).collect()
    assert len(sums) == 6
    assert {r.n for r in sums} == {flights.count()}
    by_time = measures.measures_by_time(measures.star_plus(joined.add_times(flights)), keep_grouping_id=True)
    sums = by_time.groupBy("grouping_id").agg(F.sum("total_flight_cnt").alias("n")).collect()
    assert len(sums) == 5
    assert {r.n for r in sums} == {flights.count()}


def test_carrier_and_origin_totals_add_up(flights):
    rows = measures.measures_by_locale(flights, keep_grouping_id=True, labels=False)
    ids = {r.grouping_id: r.n for r in rows.groupBy("grouping_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    finest, pair = sorted(ids)[:2]
    keys = ["op_carrier", "origin"]
    total = {
        level: {
            (r.op_carrier, r.origin): r.n
            for r in rows.where(F.col("grouping_id") == level).groupBy(*keys).agg(F.sum("delayed_cnt").alias("n")).collect()
        }
        for level in (finest, pair)
    }
    assert total[finest] == total[pair]


def test_null_key_is_told_from_a_total(spark):
    df = spark.createDataFrame(
        [(None, 1.0, 0.0, 0.0), ("AA", 20.0, 1.0, 0.0), ("AA", None, None, 0.0)],
        "k string, DEP_DELAY double, CANCELLED double, DIVERTED double",
    )
    rows = {(r.k, r.grouping_id): r for r in grouped_measures(df, [["k"], []]).collect()}
    assert set(rows) == {(None, 0), ("AA", 0), (None, 1)}
    assert (rows["AA", 0].avg_dep_delay, rows["AA", 0].delayed_cnt) == (20.0, 1)
    assert (rows["AA", 0].cancelled_cnt, rows["AA", 0].cancelled_ratio) == (1.0, 0.5)
    assert rows[None, 1].total_flight_cnt == 3
    assert rows[None, 0].total_flight_cnt == 1


def test_missing_place_names_come_from_the_nearest_place(spark):
    airports = spark.createDataFrame(
        [
            ("AAA", "KAAA", "America/Chicago", None, None, None, "A", 40.0, -90.0),
            ("BBB", "KBBB", "bad", None, "TX", "US", "B", 30.0, -95.0),
            ("CCC", "KCCC", "America/Denver", "Own", None, "US", "C", 10.0, 10.0),
            ("DDD", "KDDD", "America/Denver", "Town", "CO", "US", "D", 40.0, -105.0),
            ("EEE", "KEEE", "America/Denver", "Town", "CO", "CA", "E", 40.0, -105.0),
        ],
        "code string, icao string, time_zone string, city string, state string, country string,"
        " name string, latitude double, longitude double",
    ).withColumn("country", F.coalesce("country", F.lit("US")))
    places = spark.createDataFrame(
        [("", "Illinois", "USA", "Smallville", 40.1, -90.1), ("Houston", "Texas", "USA", None, 30.1, -95.1)],
        "city string, state string, country string, town string, latitude double, longitude double",
    )
    whitelist = spark.createDataFrame([("AAA",), ("BBB",), ("CCC",), ("EEE",)], "ORIGIN string")
    rows = {r.code: r for r in prepare_airports(airports, whitelist, places).collect()}
    assert set(rows) == {"AAA", "BBB", "CCC"}
    assert (rows["AAA"].city, rows["AAA"].state) == ("Smallville", "Illinois")
    assert (rows["BBB"].city, rows["BBB"].state, rows["BBB"].time_zone) == ("Houston", "TX", None)
    assert (rows["CCC"].city, rows["CCC"].state) == ("Own", None)


# ------------------------------------------------------------------ plan shapes


def test_whitelist_is_a_broadcast_semi_join(spark, flights):
    plan = physical(filter_whitelist(flights, view(spark, SF_DIR, "whitelist")))
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    assert "Exchange hashpartitioning" not in plan.split("BroadcastExchange")[0]


def test_no_python_and_no_cross_join(flights, weather):
    for df in (
        joined.joined_table(flights, weather, limit=0),
        measures.measures_by_locale(flights),
        measures.measures_by_time(measures.star_plus(joined.add_times(flights))),
    ):
        plan = physical(df)
        assert "Python" not in plan and "Pandas" not in plan
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_sets_are_expanded_after_the_first_aggregation(flights):
    plan = physical(measures.measures_by_locale(flights))
    assert plan.count("Expand") == 1
    # The plan prints from the result down: the expansion stands above the
    # first exchange by the finest keys, not next to the scan.
    lines = plan.splitlines()
    expand = next(i for i, line in enumerate(lines) if "Expand" in line)
    assert any("HashAggregate" in line for line in lines[expand + 1 :])


def test_both_roles_read_one_weather_shuffle(spark, flights, weather):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = joined.joined_table(flights, weather, limit=0)
        out.collect()
        plan = physical(out)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    final = plan[: plan.index("Initial Plan")]
    assert final.count("SortMergeJoin") == 2
    assert "ReusedExchange" in final


def test_date_bounds_reach_the_scan(spark):
    bounds = date_bounds(table(spark, SF_DIR, "orders"), "o_orderdate")
    ranged = filter_hour_range(table(spark, SF_DIR, "lineitem"), bounds, time="l_shipdate")
    plan = physical(ranged.select("l_orderkey"))
    assert re.search(r"ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>", plan)
    assert "NestedLoop" not in plan
    assert "subquery" in plan.lower()


def test_labels_are_put_on_weather_before_the_join(weather):
    plan = physical(label_weather(project_weather(weather)).select("weather_condition"))
    assert plan.count("Clear") >= 1 and "Python" not in plan
