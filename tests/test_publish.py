"""The whole flow over small files."""

from __future__ import annotations

import datetime
import subprocess
import sys
from pathlib import Path

import pytest

from crosswind.plans.publish import publish

FLIGHT_HEADER = (
    "FL_DATE,OP_CARRIER,OP_CARRIER_FL_NUM,ORIGIN,DEST,CRS_DEP_TIME,DEP_TIME,DEP_DELAY,"
    "CRS_ARR_TIME,ARR_TIME,ARR_DELAY,CANCELLED,DIVERTED,ACTUAL_ELAPSED_TIME"
)


@pytest.fixture(scope="module")
def inputs(tmp_path_factory):
    root = tmp_path_factory.mktemp("inputs")
    texts = {
        "years/2017.csv": f"{FLIGHT_HEADER}\n2017-12-31,AA,1,JFK,ORD,900,905,5,1100,1101,1,0,0,120\n",
        "years/2018.csv": f"{FLIGHT_HEADER}\n"
        "2018-01-01,AA,1,JFK,ORD,900,905,5,1100,1101,1,0,0,120\n"
        "2018-01-01,AA,2,JFK,XXX,900,,,1100,,,1,0,\n"
        "2018-01-06,ZZ,3,ORD,JFK,2300,2310,125,300,310,-4,0,0,90\n"
        "2018-01-06,AA,4,LAX,JFK,2300,2310,10,300,310,0,0,0,300\n",
        "whitelist.csv": "ORIGIN,AIRPORT,WEATHER_NULL_RATIO,PASSENGERS,FREIGHT_TONS\n"
        "JFK,Kennedy,0.1,10,1\nORD,O'Hare,0.1,10,1\n",
        "carriers.csv": "Code,Carrier\nAA,OLD\nAA,AMERICAN\n",
        "airports.csv": "code,icao,name,latitude,longitude,time_zone,city,state,country\n"
        "JFK,KJFK,Kennedy,40.6,-73.8,America/New_York,New York,New York,US\n"
        "ORD,KORD,O'Hare,41.9,-87.9,America/Chicago,,Illinois,US\n"
        "LAX,KLAX,Los Angeles,33.9,-118.4,America/Los_Angeles,Los Angeles,California,US\n",
        "stations.csv": "station,icao\n1,KJFK\n",
        "hourly.csv": "station,time,temp,prcp,rhum,wspd,coco\n"
        "1,2018-01-01 14:00:00,0,0,40,10,\n1,2018-01-01 16:00:00,0,0,40,10,5\n"
        "1,2018-01-07 07:00:00,-16,0,40,10,\n1,2018-01-10 00:00:00,1,1,1,1,1\n"
        "1,2018-02-01 00:00:00,1,1,1,1,1\n",
        "places.csv": "city,state,country,town,latitude,longitude\nChicago,IL,USA,,41.9,-87.7\n",
    }
    for name, text in texts.items():
        (root / name).parent.mkdir(exist_ok=True)
        (root / name).write_text(text)
    return root


def arguments(root: Path, out: Path) -> dict[str, str]:
    names = ("whitelist", "carriers", "airports", "stations", "hourly", "places")
    return {n: str(root / f"{n}.csv") for n in names} | {"flights": str(root / "years"), "out": str(out)}


def test_flow(spark, inputs, tmp_path):
    assert publish(spark, **arguments(inputs, tmp_path)) == 3
    rows = {r.OP_CARRIER_FL_NUM: r for r in spark.table("flights_with_weather").collect()}
    assert set(rows) == {1, 2, 3}
    assert rows[1].DEP_TIME_UTC == datetime.datetime(2018, 1, 1, 14)
    assert (rows[1].OP_CARRIER_NAME, rows[1].CITY_DEST, rows[1].COUNTRY_DEST) == ("AMERICAN", "Chicago", "US")
    assert (rows[1].ORIGIN_WEATHER_CONDITION, rows[1].DEST_WEATHER_CONDITION) == ("Clear", None)
    assert (rows[2].DEP_DELAY_CATEGORY, rows[2].DEP_TIME_UTC, rows[2].is_weekday) == ("Extreme Delay", None, 0)
    assert (rows[3].DEP_DELAY_CATEGORY, rows[3].ARR_DELAY_CATEGORY) == ("Extreme Delay", "Early_Arrival")
    assert rows[3].DEST_WEATHER_CONDITION == "Extreme Cold"
    assert (rows[3].dayname, rows[3].is_weekend, rows[3].season) == ("Sun", 1, "Winter")

    weather = spark.read.parquet(str(tmp_path / "weather"))
    assert weather.agg({"time": "max"}).first()[0] == datetime.datetime(2018, 1, 7, 7)
    failed = sorted((tmp_path / "airports_without_weather").glob("part-*"))
    assert "".join(p.read_text() for p in failed) == "ORD\n"
    total = spark.table("measures_by_locale").where("origin = 'ALL' AND dest = 'ALL' AND op_carrier = 'ALL'")
    assert [(r.total_flight_cnt, r.delayed_cnt, r.cancelled_cnt) for r in total.collect()] == [(3, 1, 1.0)]
    assert spark.table("measures_by_time").where("season = 'Winter'").first().avg_dep_delay == 65.0

    # A second run takes the earlier results and gives the same.
    assert publish(spark, **arguments(inputs, tmp_path)) == 3
    assert spark.table("flights_with_weather").count() == 3


def test_other_parameters_give_other_results(spark, inputs, tmp_path):
    publish(spark, **arguments(inputs, tmp_path))
    other = tmp_path / "whitelist.csv"
    other.write_text("ORIGIN,AIRPORT,WEATHER_NULL_RATIO,PASSENGERS,FREIGHT_TONS\nJFK,Kennedy,0.1,10,1\n")
    changed = arguments(inputs, tmp_path) | {"whitelist": str(other)}
    assert publish(spark, **changed, start_year=2017) == 3
    rows = spark.table("flights_with_weather").select("FL_DATE", "ORIGIN").collect()
    assert {r.ORIGIN for r in rows} == {"JFK"} and min(r.FL_DATE.year for r in rows) == 2017


def test_a_year_that_is_added_is_the_only_one_written(spark, inputs, tmp_path):
    years, out = tmp_path / "years", tmp_path / "out"
    years.mkdir()
    (years / "2018.csv").write_text((inputs / "years/2018.csv").read_text())
    given = arguments(inputs, out) | {"flights": str(years)}
    written = lambda: {
        str(p.relative_to(out)): p.stat().st_mtime_ns for p in (out / "flights").rglob("part-*")
    }
    rows = lambda: sorted(map(str, spark.table("flights_with_weather").collect()))
    assert publish(spark, **given) == 3
    first = written()
    assert all(name.startswith("flights/year=2018/") for name in first)

    # Another order of columns, as years may have.
    moved = FLIGHT_HEADER.split(",")[::-1]
    line = "2019-01-05,AA,9,JFK,ORD,900,905,5,1100,1101,1,0,0,120".split(",")[::-1]
    (years / "2019.csv").write_text(f"{','.join(moved)}\n{','.join(line)}\n")
    assert publish(spark, **given) == 4
    second = written()
    assert first.items() <= second.items()
    assert {name.split("/")[1] for name in second.keys() - first.keys()} == {"year=2019"}
    grown = rows()
    assert publish(spark, **(given | {"out": str(tmp_path / "fresh")})) == 4
    assert rows() == grown

    # A year delivered anew, and one that is no longer wanted.
    (years / "2018.csv").write_text((inputs / "years/2017.csv").read_text())
    assert publish(spark, **given) == 2
    third = written()
    assert {name: time for name, time in third.items() if "2019" in name}.items() <= second.items()
    assert not third.keys() & first.keys()
    assert publish(spark, **given, start_year=2019) == 1
    assert {name.split("/")[1] for name in written()} == {"year=2019"}


def test_measures_can_be_read_by_another_program(spark, inputs, tmp_path):
    publish(spark, **arguments(inputs, tmp_path), files=1)
    script = (
        "import sys, pyarrow.parquet as pq\n"
        "print(*[pq.read_table(f'{sys.argv[1]}/measures_by_{x}').num_rows for x in ('locale', 'time')])"
    )
    shown = subprocess.run([sys.executable, "-c", script, str(tmp_path)], capture_output=True, text=True, check=True)
    counts = [spark.table(f"measures_by_{x}").count() for x in ("locale", "time")]
    assert shown.stdout.split() == [str(n) for n in counts]
    assert len(list((tmp_path / "joined").glob("part-*"))) == 1


def test_carriers_from_pages(spark, inputs, tmp_path):
    table = "<table class='wikitable sortable'><tr><th>x<tr><td>-<td>-<td>AA<td>AAL<td>American &amp; Co</table>"
    spark.createDataFrame([(1, table)], "page_id long, html string").write.parquet(str(tmp_path / "pages"))
    given = arguments(inputs, tmp_path / "out")
    del given["carriers"]
    assert publish(spark, **given, pages=str(tmp_path / "pages")) == 3
    names = {r.OP_CARRIER: r.OP_CARRIER_NAME for r in spark.table("flights_with_weather").collect()}
    assert names == {"AA": "American & Co", "ZZ": None}


def test_command_line_names_its_arguments():
    script = Path(__file__).resolve().parent.parent / "crosswind" / "plans" / "publish.py"
    shown = subprocess.run([sys.executable, str(script), "--help"], capture_output=True, text=True, check=True)
    assert "--whitelist" in shown.stdout
