"""The whole flow, from delivered files to the published table and views.

    spark-submit crosswind/plans/publish.py --flights DIR --whitelist FILE … --out DIR
"""

from __future__ import annotations

import argparse
import json
import sys
from functools import partial
from pathlib import Path

if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from pyspark.sql import DataFrame, SparkSession

from crosswind.plans.flights import airports_in_file_order, enrich_flights, prepare_airports
from crosswind.plans.joined import joined_table
from crosswind.plans.measures import measures_by_locale, measures_by_time, star_plus
from crosswind.plans.weather import collect_weather
from crosswind.schemas import AIRPORTS, HOURLY, PLACES, STATIONS
from crosswind.session import files_mark, session
from crosswind.sinks.catalog import publish_view, replace_table_as
from crosswind.sinks.files import (
    load_or_build,
    load_or_build_parts,
    write_counted,
    write_failure_list,
    write_lines,
    write_parquet,
)
from crosswind.operators.lookups import unmatched_airports
from crosswind.sources.files import POSITION, read_table, scan_carriers, scan_paths, scan_whitelist, year_paths
from crosswind.sources.pages import carriers_from_rows, html_rows


def publish(
    spark: SparkSession,
    *,
    flights: str,
    whitelist: str,
    carriers: str | None = None,
    airports: str,
    stations: str,
    hourly: str,
    out: str,
    places: str | None = None,
    pages: str | None = None,
    files: int | None = None,
    start_year: int = 2018,
    table: str = "flights_with_weather",
) -> int:
    """Run the flow and return the number of joined rows.

    Results of earlier steps found under ``out`` are read, not built again, if
    they were made with the same parameters from the same files. Flights are kept
    by year, so a year that is added or delivered anew is the only one that is
    enriched. Carriers come
    from a file, or else from the tables in ``pages``, Parquet with ``page_id``
    and ``html``. ``files`` sets the number of files of the joined rows.

    The measures are written to ``measures_by_locale`` and ``measures_by_time``
    under ``out``, for other programs to read, and are views of these names: of
    the catalog, if it outlives the session, else of the session.
    """
    if not (carriers or pages):
        raise ValueError("carriers are needed, as a file or as pages")
    listed = scan_whitelist(spark, whitelist)

    def recipe(*inputs: str | None, **parameters) -> str:
        marks = [files_mark(spark, path) for path in inputs if path]
        return json.dumps([marks, parameters], sort_keys=True)

    made_airports = recipe(airports, whitelist, places)
    years = year_paths(spark, flights, start_year)
    made_flights = {
        year: recipe(*paths, carriers or pages, airports=made_airports) for year, paths in years.items()
    }
    made_weather = recipe(stations, hourly, flights=made_flights)

    def build_airports() -> DataFrame:
        read = read_table(spark, airports, AIRPORTS, position=True)
        known = read_table(spark, places, PLACES) if places else None
        return prepare_airports(airports_in_file_order(read, POSITION), listed, known)

    ports = load_or_build(spark, f"{out}/airports", build_airports, recipe=made_airports)

    def build_flights(year: int) -> DataFrame:
        raw = scan_paths(spark, years[year])
        if carriers:
            return enrich_flights(raw, listed, scan_carriers(spark, carriers), ports, carrier_order=[POSITION])
        names = carriers_from_rows(html_rows(spark.read.parquet(pages)))
        return enrich_flights(raw, listed, names, ports)

    by_year = {str(year): (made, partial(build_flights, year)) for year, made in made_flights.items()}
    flown = load_or_build_parts(spark, f"{out}/flights", by_year, name="year")
    write_lines(flown, "ORIGIN", f"{out}/airport_ids")

    def build_weather() -> DataFrame:
        known = read_table(spark, stations, STATIONS)
        return collect_weather(flown, ports, known, read_table(spark, hourly, HOURLY))

    weather = load_or_build(spark, f"{out}/weather", build_weather, recipe=made_weather)
    missing = unmatched_airports(flown.withColumnRenamed("ORIGIN", "airport"), weather)
    write_failure_list(missing, "airport", f"{out}/airports_without_weather")

    rows = write_counted(joined_table(flown, weather), f"{out}/joined", files=files)
    calendar = star_plus(spark.read.parquet(f"{out}/joined"))
    replace_table_as(calendar, table, location=f"{out}/{table}")
    for name, measured in (
        ("measures_by_locale", measures_by_locale(spark.table(table))),
        ("measures_by_time", measures_by_time(spark.table(table))),
    ):
        write_parquet(measured, f"{out}/{name}")
        publish_view(spark, name, f"{out}/{name}")
    return rows


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    for name in ("flights", "whitelist", "airports", "stations", "hourly", "out"):
        parser.add_argument(f"--{name}", required=True)
    for name in ("carriers", "pages", "places"):
        parser.add_argument(f"--{name}")
    parser.add_argument("--files", type=int)
    parser.add_argument("--start_year", type=int, default=2018)
    spark = session("crosswind")
    print("rows of the joined table:", publish(spark, **vars(parser.parse_args())))
    spark.stop()


if __name__ == "__main__":
    main()
