"""One query per operator, each next to its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.views import table, view, with_views
from crosswind.functions import clock
from crosswind.functions.calendar import calendar_columns, is_weekday, is_weekend, season
from crosswind.functions.labels import (
    arrival_delay_band,
    departure_delay_band,
    weather_code_label,
    weather_rule_label,
)
from crosswind.functions.text import element
from crosswind.operators import aggregates as agg
from crosswind.operators import filters, lookups, unions
from crosswind.operators.nearest import nearest_place
from crosswind.plans import joined as joined_plan
from crosswind.plans import measures
from crosswind.plans.flights import enrich_flights, prepare_airports
from crosswind.plans.weather import (
    collect_weather,
    label_weather,
    project_weather,
    repeated_hours,
)
from crosswind.schemas import AIRPORT_FEATURES, FLIGHTS, JOINED, RAW_FLIGHTS, WEATHER_NAMES, columns
from crosswind.session import scratch_path
from crosswind.sinks import catalog, files
from crosswind.sources import files as readers
from crosswind.sources.pages import carriers_from_rows, html_rows

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def checked(oracle: str, views: str = "", name: str | None = None) -> Callable[[Query], Query]:
    """Register a query, by default under its function's name, with its oracle."""

    def register(query: Query) -> Query:
        key = name or query.__name__
        QUERIES[key] = query
        ORACLES[key] = with_views(views, oracle) if views else oracle
        return query

    return register


# ---------------------------------------------------------------- oracle parts

TIMED_SQL = """
    timed AS (
        SELECT f.*, dep_local AS DEP_TIME_LOCAL, dep_utc AS DEP_TIME_UTC,
               arr_utc AS ARR_TIME_UTC,
               timezone(NULLIF(TIME_ZONE_DEST, 'Unknown'), timezone('UTC', arr_utc)) AS ARR_TIME_LOCAL
        FROM (SELECT *, dep_utc + to_hours(CAST(round(ACTUAL_ELAPSED_TIME / 60) AS BIGINT)) AS arr_utc
              FROM (SELECT *, timezone('UTC', timezone(NULLIF(TIME_ZONE_ORIGIN, 'Unknown'), dep_local)) AS dep_utc
                    FROM (SELECT *, CASE WHEN DEP_TIME < 2400 THEN
                                 CAST(FL_DATE AS TIMESTAMP) + to_hours(CAST(floor(DEP_TIME / 100) AS BIGINT))
                                 END AS dep_local
                          FROM flights))) AS f
    )"""

LABELLED_SQL = """
    labelled AS (
        SELECT time, airport, temp, prcp, rhum, wspd, coco, rule_label,
               CASE WHEN coco IN (1, 2) THEN 'Clear'
                    WHEN coco BETWEEN 3 AND 6 THEN 'Cloudy'
                    WHEN coco IN (7, 8, 17) THEN 'Light Rain'
                    WHEN coco BETWEEN 9 AND 11 OR coco = 18 THEN 'Heavy Rain'
                    WHEN coco IN (12, 14, 15, 19, 21, 24) THEN 'Snow'
                    WHEN coco IN (13, 16, 20, 22) THEN 'Heavy Snow'
                    WHEN coco IN (23, 25, 27) THEN 'Stormy'
                    WHEN coco = 26 THEN 'Severe Storm'
                    ELSE rule_label END AS label
        FROM (SELECT *,
                CASE WHEN prcp = 0 AND temp >= -2 AND temp <= 35 AND rhum < 50 AND wspd < 20 THEN 'Clear'
                     WHEN prcp = 0 AND temp >= -10 AND temp <= 45 AND rhum >= 50 AND rhum <= 75 AND wspd < 30
                          THEN 'Partly Cloudy'
                     WHEN prcp = 0 AND temp >= -10 AND temp <= 45 AND rhum > 75 THEN 'Cloudy'
                     WHEN prcp > 0.01 AND prcp <= 10 AND temp >= 2 AND temp <= 45 AND rhum > 55 AND wspd < 25
                          THEN 'Light Rain'
                     WHEN prcp > 10 AND temp >= 2 AND temp <= 45 AND rhum > 65 AND wspd < 25 THEN 'Heavy Rain'
                     WHEN prcp > 0.05 AND temp >= -20 AND temp <= 2 AND rhum > 55 THEN 'Snow'
                     WHEN prcp > 2 AND temp >= -30 AND temp <= 2 AND rhum > 60 THEN 'Heavy Snow'
                     WHEN wspd >= 25 AND wspd <= 35 AND prcp > 1 AND rhum > 55 THEN 'Windy Rain'
                     WHEN wspd >= 35 AND wspd <= 40 AND temp > -5 AND prcp > 2 AND rhum > 60 THEN 'Stormy'
                     WHEN temp < -5 AND wspd >= 40 AND wspd <= 50 AND prcp > 2 AND rhum > 60 THEN 'Blizzard'
                     WHEN wspd > 50 AND prcp > 5 AND rhum > 70 THEN 'Severe Storm'
                     WHEN temp > 35 AND rhum < 30 AND wspd < 20 THEN 'Hot and Dry'
                     WHEN temp < -15 AND wspd < 20 THEN 'Extreme Cold'
                     ELSE 'Unknown' END AS rule_label
              FROM weather)
    )"""


def band_sql(column: str, early: str) -> str:
    return f"""CASE WHEN {column} < 0 THEN '{early}' WHEN {column} <= 15 THEN 'On-Time'
        WHEN {column} <= 30 THEN 'Minor Delay' WHEN {column} <= 60 THEN 'Moderate Delay'
        WHEN {column} <= 120 THEN 'Severe Delay' ELSE 'Extreme Delay' END"""


def calendar_sql(time: str) -> str:
    return f"""CAST(year({time}) AS INTEGER) AS year, CAST(month({time}) AS INTEGER) AS month,
        CAST(day({time}) AS INTEGER) AS day, CAST(dayofweek({time}) AS INTEGER) AS dow,
        strftime({time}, '%a') AS dayname,
        CASE WHEN dayofweek({time}) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
        CASE WHEN dayofweek({time}) BETWEEN 1 AND 5 THEN 1 ELSE 0 END AS is_weekday,
        CASE WHEN month({time}) IN (3, 4, 5) THEN 'Spring' WHEN month({time}) IN (6, 7, 8) THEN 'Summer'
             WHEN month({time}) IN (9, 10, 11) THEN 'Autumn' WHEN month({time}) IN (12, 1, 2) THEN 'Winter'
             END AS season"""


MEASURES_SQL = """CAST(count(*) AS BIGINT) AS total_flight_cnt,
    CAST(sum(CASE WHEN DEP_DELAY > 15 THEN 1 ELSE 0 END) AS BIGINT) AS delayed_cnt,
    sum(CASE WHEN DEP_DELAY > 15 THEN 1 ELSE 0 END) / count(*) AS delay_ratio,
    sum(CANCELLED) AS cancelled_cnt, sum(CANCELLED) / count(*) AS cancelled_ratio,
    sum(DIVERTED) AS diverted_cnt, sum(DIVERTED) / count(*) AS diverted_ratio"""

LOCALE_SETS_SQL = """GROUP BY GROUPING SETS ((),
    (ORIGIN, AIRPORT_NAME_ORIGIN, LONGITUDE_ORIGIN, LATITUDE_ORIGIN),
    (DEST, AIRPORT_NAME_DEST, LONGITUDE_DEST, LATITUDE_DEST),
    (OP_CARRIER, OP_CARRIER_NAME),
    (OP_CARRIER, OP_CARRIER_NAME, ORIGIN, AIRPORT_NAME_ORIGIN, LONGITUDE_ORIGIN, LATITUDE_ORIGIN),
    (OP_CARRIER, OP_CARRIER_NAME, ORIGIN, AIRPORT_NAME_ORIGIN, LONGITUDE_ORIGIN, LATITUDE_ORIGIN,
     DEST, AIRPORT_NAME_DEST, LONGITUDE_DEST, LATITUDE_DEST))"""

COORDINATES_SQL = """LONGITUDE_ORIGIN AS longitude_origin, LATITUDE_ORIGIN AS latitude_origin,
    LONGITUDE_DEST AS longitude_dest, LATITUDE_DEST AS latitude_dest"""


def joined_columns_sql() -> str:
    """The 43 columns over t (timed flights), w1 and w2 (labelled weather)."""
    sources = {
        "DEP_DELAY_CATEGORY": band_sql("t.DEP_DELAY", "Early_Departure"),
        "ARR_DELAY_CATEGORY": band_sql("t.ARR_DELAY", "Early_Arrival"),
        "TIME_ZONE_ORIGIN": "NULLIF(t.TIME_ZONE_ORIGIN, 'Unknown')",
        "TIME_ZONE_DEST": "NULLIF(t.TIME_ZONE_DEST, 'Unknown')",
    }
    for role, w in (("ORIGIN", "w1"), ("DEST", "w2")):
        sources[f"{role}_TEMPERATURE_DEG_C"] = f"{w}.temp"
        sources[f"{role}_WIND_SPEED_KM_PER_HR"] = f"{w}.wspd"
        sources[f"{role}_RELATIVE_HUMIDITY"] = f"{w}.rhum"
        sources[f"{role}_PRECIPITATION"] = f"{w}.prcp"
        sources[f"{role}_WEATHER_CONDITION"] = f"{w}.label"
    return ", ".join(f"{sources.get(c, 't.' + c)} AS {c}" for c in JOINED)


JOINED_SQL = f""", {TIMED_SQL}, {LABELLED_SQL}, joined AS (
    SELECT {joined_columns_sql()} FROM timed AS t
    LEFT JOIN labelled AS w1 ON t.DEP_TIME_UTC = w1.time AND t.ORIGIN = w1.airport
    LEFT JOIN labelled AS w2 ON t.ARR_TIME_UTC = w2.time AND t.DEST = w2.airport)"""

FLIGHT_COLUMNS = ", ".join(FLIGHTS.names)


# ------------------------------------------------------------ sources and sinks

ORDERS = columns(
    "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string"
)
ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"


@checked(f"SELECT {FLIGHT_COLUMNS} FROM flights", "flights")
def scan_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "flights.csv")
    files.write_csv(view(spark, sf_dir, "flights"), path)
    return readers.scan_flights(spark, path)


@checked("SELECT time, temp, prcp, rhum, wspd, airport, coco FROM weather", "weather")
def scan_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "weather.csv")
    files.write_csv(view(spark, sf_dir, "weather"), path)
    return readers.scan_weather(spark, path)


@checked(ORDERS_SQL + " WHERE year(o_orderdate) >= 1998")
def scan_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    directory = scratch_path(spark, "years")
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    files.write_csv(orders, directory, partition_by=("year",))
    return readers.scan_years(spark, directory, 1998, ORDERS)


@checked(
    "SELECT code, icao, time_zone, city, state, country, name, latitude, longitude FROM airports",
    "airports",
)
def scan_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "airports.csv")
    files.write_csv(view(spark, sf_dir, "airports"), path)
    return readers.scan_airports(spark, path)


@checked("SELECT Code, Carrier FROM carriers", "carriers")
def scan_carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "carriers.csv")
    files.write_csv(view(spark, sf_dir, "carriers").select("Carrier", "Code"), path)
    return readers.scan_carriers(spark, path).select("Code", "Carrier")


@checked(
    """SELECT ORIGIN, AIRPORT, CAST(NULL AS DOUBLE) AS WEATHER_NULL_RATIO,
              CAST(length(AIRPORT) AS BIGINT) AS PASSENGERS, CAST(NULL AS BIGINT) AS FREIGHT_TONS FROM whitelist""",
    "airports whitelist",
)
def scan_whitelist(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "whitelist.csv")
    listed = view(spark, sf_dir, "whitelist").select(
        "ORIGIN",
        "AIRPORT",
        F.lit(None).cast("double").alias("WEATHER_NULL_RATIO"),
        # Whole numbers written with a fraction.
        F.length("AIRPORT").cast("double").alias("PASSENGERS"),
        F.lit(None).cast("double").alias("FREIGHT_TONS"),
    )
    files.write_csv(listed, path)
    return readers.scan_whitelist(spark, path)


@checked(ORDERS_SQL + " WHERE year(o_orderdate) >= 1998")
def scan_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly folders of all years, whose files differ in the order of their columns."""
    directory = scratch_path(spark, "years")
    orders = table(spark, sf_dir, "orders")
    for side, columns in enumerate((orders.columns, list(reversed(orders.columns)))):
        part = orders.where(F.col("o_orderkey") % 2 == side).select(*columns, F.year("o_orderdate").alias("year"))
        files.write_csv(part, directory, partition_by=("year",), mode="append")
    return readers.scan_years(spark, directory, 1998, ORDERS)


@checked("SELECT conv_id, turn, role, text FROM conversations")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with quotes, blanks and line breaks, written and read back."""
    path = scratch_path(spark, "conversations.csv")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    files.write_csv(turns, path, multiline=True)
    return readers.read_table(spark, path, turns.schema, multiline=True)


PAGE_ROWS_SQL = r"""
    found AS (
        SELECT page_id, block_no, row_no,
               regexp_extract_all(item, '[">]/?([^<>"]+)["<]', 1) AS cell
        FROM (SELECT page_id, block_no, unnest(range(len(items))) AS row_no, unnest(items) AS item
              FROM (SELECT page_id, block_no, regexp_extract_all(block, '(?is)<li\b[^>]*>(.*?)</li\s*>', 1) AS items
                    FROM (SELECT page_id, unnest(range(len(blocks))) AS block_no, unnest(blocks) AS block
                          FROM (SELECT page_id, regexp_extract_all(html, '(?is)<nav\b[^>]*>(.*?)</nav\s*>', 1) AS blocks
                                FROM pages))))
        WHERE row_no >= 1
    ),
    rows_found AS (
        SELECT page_id, CAST(block_no AS INTEGER) AS block_no, CAST(row_no AS INTEGER) AS row_no,
               trim(replace(cell[1], '&amp;', '&')) AS href, trim(replace(cell[2], '&amp;', '&')) AS text
        FROM found WHERE len(cell) > 1
    )"""


def page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links in the navigation of each page, but for the first."""
    return html_rows(
        table(spark, sf_dir, "pages"),
        block=element("nav"),
        row=element("li"),
        cell=r'[">]/?([^<>"]+)["<]',
        cells={"href": 0, "text": 1},
    )


@checked(f"WITH {PAGE_ROWS_SQL} SELECT page_id, block_no, row_no, href, text FROM rows_found", name="html_rows")
def html_rows_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_rows(spark, sf_dir)


@checked(
    """SELECT page_id, CAST(0 AS INTEGER) AS block_no, CAST(row_no AS INTEGER) AS row_no,
              CAST(page_id AS VARCHAR) AS iata, 'x' AS icao,
              CASE row_no WHEN 1 THEN 'n' || page_id ELSE 'last' END AS name
       FROM pages, (SELECT unnest([1, 2]) AS row_no)"""
)
def html_deep_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page numbers in tables inside up to eleven others, and a row behind them."""
    number = F.col("page_id").cast("string")
    depth = (F.col("page_id") % 12).cast("int")
    start, end = F.repeat(F.lit("<table class=inner><tr><td>"), depth), F.repeat(F.lit("</td></tr></table>"), depth)

    def row(*cells):
        return F.concat(F.lit("<tr>"), *[part for cell in cells for part in (F.lit("<td>"), cell, F.lit("</td>"))], F.lit("</tr>"))

    first = row(F.lit("-"), F.lit("-"), number, F.lit("x"), F.concat(start, F.lit("n"), number, end))
    last = row(F.lit("-"), F.lit("-"), number, F.lit("x"), F.lit("last"))
    html = F.concat(
        F.lit('<p>text<table class="wikitable sortable"><tr><th>a</th></tr>'), first, last, F.lit("</table>")
    )
    return html_rows(table(spark, sf_dir, "pages").select("page_id", html.alias("html")))


@checked(
    f"""WITH {PAGE_ROWS_SQL}
    SELECT Code, Carrier FROM (
        SELECT href AS Code, text AS Carrier,
               row_number() OVER (PARTITION BY href
                                  ORDER BY page_id DESC, block_no DESC, row_no DESC) AS place
        FROM rows_found) WHERE place = 1 AND Code NOT IN ('VX', 'EV')
    UNION ALL SELECT 'VX', 'Virgin America' UNION ALL SELECT 'EV', 'ExpressJet Airlines'"""
)
def html_carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = page_rows(spark, sf_dir)
    return carriers_from_rows(rows.withColumnsRenamed({"href": "iata", "text": "name"}))


@checked("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def sink_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "customer.csv")
    customer = table(spark, sf_dir, "customer")
    files.write_csv(customer, path)
    return readers.read_table(spark, path, customer.schema)


@checked(
    f"""SELECT CAST(month(FL_DATE) AS INTEGER) AS month, CAST(day(FL_DATE) AS INTEGER) AS day, {MEASURES_SQL}
    FROM flights GROUP BY 1, 2""",
    "flights",
)
def sink_parquet_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result of at most one row per day of the year, as one file."""
    path = scratch_path(spark, "daily")
    daily = agg.grouped_measures(
        view(spark, sf_dir, "flights").withColumns(
            {"month": F.month("FL_DATE"), "day": F.dayofmonth("FL_DATE")}
        ),
        [["month", "day"]],
    ).drop("grouping_id", "avg_dep_delay")
    files.write_parquet(daily, path, files=1)
    return spark.read.parquet(path)


@checked("SELECT DISTINCT ORIGIN AS value FROM flights", "flights")
def sink_text_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "airport_ids")
    files.write_lines(view(spark, sf_dir, "flights"), "ORIGIN", path)
    return spark.read.text(path)


@checked(
    """SELECT CASE WHEN value = max(value) OVER () THEN value ELSE value || ',' END AS value
    FROM (SELECT DISTINCT OP_CARRIER AS value FROM flights)""",
    "flights",
)
def sink_failure_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "failed")
    files.write_failure_list(view(spark, sf_dir, "flights"), "OP_CARRIER", path)
    return spark.read.text(path)


def new_table(spark: SparkSession, name: str) -> tuple[str, str]:
    """A table name not in use, and where its files go."""
    location = scratch_path(spark, name)
    return f"{name}_{location.split('/')[-2][-12:]}", location


@checked(ORDERS_SQL + " WHERE false")
def table_from_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, location = new_table(spark, "orders_like")
    catalog.table_from_parquet(spark, name, f"{sf_dir}/orders.parquet", location=location)
    return spark.table(name)


@checked(ORDERS_SQL)
def load_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with columns in another order and case, into a table made from the file."""
    name, location = new_table(spark, "orders_loaded")
    catalog.table_from_parquet(spark, name, f"{sf_dir}/orders.parquet", location=location)
    orders = table(spark, sf_dir, "orders")
    shuffled = orders.select(*[F.col(c).alias(c.upper()) for c in reversed(orders.columns)])
    catalog.load_by_name(shuffled, name)
    return spark.table(name)


@checked("SELECT * FROM orders")
def load_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders delivered in two parts of different column order, each asked for twice and loaded once."""
    name, location = new_table(spark, "orders_delivered")
    orders, source = table(spark, sf_dir, "orders"), scratch_path(spark, "deliveries")
    catalog.loaded_table(orders, name, location)
    for part, columns in enumerate((orders.columns, orders.columns[::-1])):
        delivered = orders.where(F.pmod(F.hash("o_orderkey"), 2) == part)
        delivered.select(*columns).write.parquet(f"{source}/part-{part}")
        for _ in range(2):
            catalog.load_files(spark, name, source)
    return spark.table(name).drop(catalog.LOAD)


@checked(f"SELECT *, {calendar_sql('ts')} FROM events")
def replace_table_as(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, location = new_table(spark, "events_calendar")
    events = table(spark, sf_dir, "events")
    catalog.replace_table_as(events, name, location=location)
    catalog.replace_table_as(measures.star_plus(events, "ts"), name, location=location)
    return spark.table(name)


@checked(
    "SELECT event_type, CAST(count(*) AS BIGINT) AS n, sum(event_id) / count(*) AS mean_id FROM events GROUP BY event_type"
)
def replace_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog.replace_view(table(spark, sf_dir, "events"), "crosswind_events")
    catalog.replace_sql_view(
        spark,
        "crosswind_event_counts",
        """WITH totals AS (SELECT event_type, count(1) AS n, sum(event_id) AS ids
                          FROM crosswind_events GROUP BY event_type)
           SELECT event_type, n, ids / n AS mean_id FROM totals""",
    )
    return spark.table("crosswind_event_counts")


@checked("SELECT event_id, ts AS departure_time_utc FROM events")
def rename_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("Departure_Time_UTC"))
    return catalog.rename_column(events, "Departure_Time_UTC", "departure_time_utc")


@checked("SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def load_or_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Built on the first call, read on the second."""
    path = scratch_path(spark, "nations")

    def build() -> DataFrame:
        nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
        joined = nation.join(region, nation.n_regionkey == region.r_regionkey)
        return joined.select("n_nationkey", "n_name", "r_name")

    files.load_or_build(spark, path, build)
    return files.load_or_build(spark, path, build)


@checked("SELECT * FROM orders")
def load_or_build_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders kept by year: all years but one first, then all, where one more is written."""
    orders, path = table(spark, sf_dir, "orders"), scratch_path(spark, "orders_by_year")
    listed = orders.select(F.year("o_orderdate")).distinct().orderBy(F.year("o_orderdate")).collect()
    parts = {
        str(year): ("as delivered", lambda year=year: orders.where(F.year("o_orderdate").eqNullSafe(F.lit(year))))
        for (year,) in listed
    }
    files.load_or_build_parts(spark, path, dict(list(parts.items())[:-1]) or parts, name="year")
    return files.load_or_build_parts(spark, path, parts, name="year")


@checked("SELECT CAST(count(*) AS BIGINT) AS n_rows FROM flights", "flights")
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unions.row_count(joined_rows(spark, sf_dir))


@checked("SELECT event_id, ts, user_id, event_type FROM events ORDER BY ts, event_id LIMIT 10")
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return unions.preview(events, ["ts", "event_id"])


# ---------------------------------------------- projections, filters, predicates


@checked(f"SELECT {FLIGHT_COLUMNS} FROM flights", "flights")
def project_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined_plan.project_flights(view(spark, sf_dir, "flights"))


@checked(
    "SELECT " + ", ".join(f"{old} AS {new}" for old, new in WEATHER_NAMES.items()) + " FROM weather",
    "weather",
    name="project_weather",
)
def project_weather_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project_weather(view(spark, sf_dir, "weather"))



def joined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined_plan.joined_table(view(spark, sf_dir, "flights"), view(spark, sf_dir, "weather"))


@checked(f"{JOINED_SQL} SELECT {', '.join(JOINED)} FROM joined", "flights weather")
def project_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined_rows(spark, sf_dir)


@checked(f"SELECT *, {calendar_sql('ts')} FROM events")
def star_plus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.star_plus(table(spark, sf_dir, "events"), "ts")


@checked("SELECT event_id, ts, user_id, event_type, value FROM events")
def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A name that is no column is passed over."""
    return table(spark, sf_dir, "events").drop("props", "minute")


@checked(
    """SELECT FL_DATE, ORIGIN, DEST, OP_CARRIER_FL_NUM, NULLIF(TIME_ZONE_ORIGIN, 'Unknown') AS TIME_ZONE_ORIGIN,
              NULLIF(TIME_ZONE_DEST, 'Unknown') AS TIME_ZONE_DEST FROM flights""",
    "flights",
)
def sentinel_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = view(spark, sf_dir, "flights").select(
        "FL_DATE", "ORIGIN", "DEST", "OP_CARRIER_FL_NUM", "TIME_ZONE_ORIGIN", "TIME_ZONE_DEST"
    )
    return filters.sentinel_to_null(flights, ["TIME_ZONE_ORIGIN", "TIME_ZONE_DEST"])


@checked(
    f"SELECT {FLIGHT_COLUMNS} FROM flights WHERE ORIGIN IN (SELECT ORIGIN FROM whitelist)",
    "whitelist flights",
)
def filter_whitelist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.filter_whitelist(view(spark, sf_dir, "flights"), view(spark, sf_dir, "whitelist"))


@checked("SELECT * FROM customer WHERE c_mktsegment = 'MACHINERY'")
def filter_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.filter_country(table(spark, sf_dir, "customer"), "MACHINERY", "c_mktsegment")


@checked(
    """SELECT FL_DATE, ORIGIN, DEST, COUNTRY_DEST, OP_CARRIER_NAME, DEP_TIME FROM flights
    WHERE COUNTRY_DEST IS NULL OR OP_CARRIER_NAME IS NULL OR DEP_TIME IS NULL""",
    "flights",
)
def filter_any_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = view(spark, sf_dir, "flights").select(
        "FL_DATE", "ORIGIN", "DEST", "COUNTRY_DEST", "OP_CARRIER_NAME", "DEP_TIME"
    )
    return filters.filter_any_missing(flights, ["COUNTRY_DEST", "OP_CARRIER_NAME", "DEP_TIME"])


@checked(
    """SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
    WHERE l_shipdate >= (SELECT min(o_orderdate) FROM orders)
      AND l_shipdate <= (SELECT max(o_orderdate) + INTERVAL 3 DAY FROM orders)"""
)
def filter_hour_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    bounds = filters.date_bounds(table(spark, sf_dir, "orders"), "o_orderdate")
    return filters.filter_hour_range(shipped, bounds, time="l_shipdate")


@checked(
    """SELECT l_orderkey, l_linenumber, l_quantity = 25 AS same, l_quantity < 25 AS less,
              l_quantity <= 25 AS at_most, l_quantity > 25 AS more, l_quantity >= 25 AS at_least,
              l_discount >= 0.03 AND l_discount <= 0.07 AS in_range,
              l_returnflag IN ('A', 'R') AND l_linestatus = 'O' AS listed,
              l_linenumber NOT IN (1, 7) AS unlisted
       FROM lineitem"""
)
def predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (quantity == 25).alias("same"),
        (quantity < 25).alias("less"),
        (quantity <= 25).alias("at_most"),
        (quantity > 25).alias("more"),
        (quantity >= 25).alias("at_least"),
        F.col("l_discount").between(0.03, 0.07).alias("in_range"),
        (F.col("l_returnflag").isin("A", "R") & (F.col("l_linestatus") == "O")).alias("listed"),
        (~F.col("l_linenumber").isin(1, 7)).alias("unlisted"),
    )


# ------------------------------------------------------------- joins and lookups


def timed_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined_plan.add_times(view(spark, sf_dir, "flights"))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_weather(project_weather(view(spark, sf_dir, "weather")))


@checked(
    f""", {TIMED_SQL}, {LABELLED_SQL}
    SELECT t.FL_DATE, t.ORIGIN, t.OP_CARRIER, t.OP_CARRIER_FL_NUM, t.DEP_TIME_UTC,
           w.temp AS ORIGIN_TEMPERATURE_DEG_C, w.label AS ORIGIN_WEATHER_CONDITION
    FROM timed AS t LEFT JOIN labelled AS w ON t.DEP_TIME_UTC = w.time AND t.ORIGIN = w.airport""",
    "flights weather",
)
def join_origin_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = joined_plan.join_weather(
        timed_flights(spark, sf_dir), labelled(spark, sf_dir), roles=("ORIGIN",)
    )
    return joined.select(
        "FL_DATE",
        "ORIGIN",
        "OP_CARRIER",
        "OP_CARRIER_FL_NUM",
        "DEP_TIME_UTC",
        "ORIGIN_TEMPERATURE_DEG_C",
        "ORIGIN_WEATHER_CONDITION",
    )


@checked(
    f""", {TIMED_SQL}, {LABELLED_SQL}
    SELECT t.FL_DATE, t.DEST, t.OP_CARRIER, t.OP_CARRIER_FL_NUM, t.ARR_TIME_UTC,
           w.temp AS DEST_TEMPERATURE_DEG_C, w.label AS DEST_WEATHER_CONDITION
    FROM timed AS t LEFT JOIN labelled AS w ON t.ARR_TIME_UTC = w.time AND t.DEST = w.airport""",
    "flights weather",
)
def join_dest_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = joined_plan.join_weather(
        timed_flights(spark, sf_dir), labelled(spark, sf_dir), roles=("DEST",)
    )
    return joined.select(
        "FL_DATE",
        "DEST",
        "OP_CARRIER",
        "OP_CARRIER_FL_NUM",
        "ARR_TIME_UTC",
        "DEST_TEMPERATURE_DEG_C",
        "DEST_WEATHER_CONDITION",
    )


ROLE_PLAYING_SQL = f"""{JOINED_SQL}
    SELECT ORIGIN_WEATHER_CONDITION, DEST_WEATHER_CONDITION, CAST(count(*) AS BIGINT) AS flights
    FROM joined GROUP BY 1, 2"""


@checked(ROLE_PLAYING_SQL, "flights weather")
def role_playing_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of conditions at both ends, one weather table in both roles."""
    return (
        joined_rows(spark, sf_dir)
        .groupBy("ORIGIN_WEATHER_CONDITION", "DEST_WEATHER_CONDITION")
        .agg(F.count(F.lit(1)).alias("flights"))
    )


@checked(ROLE_PLAYING_SQL, "flights weather")
def join_weather_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pairs, joined as when the weather is too large to broadcast."""
    joined = joined_plan.joined_table(
        view(spark, sf_dir, "flights"), view(spark, sf_dir, "weather"), limit=0
    )
    return joined.groupBy("ORIGIN_WEATHER_CONDITION", "DEST_WEATHER_CONDITION").agg(
        F.count(F.lit(1)).alias("flights")
    )


@checked(
    """SELECT airport, time, CAST(count(*) AS BIGINT) AS n
    FROM (SELECT CAST(l_suppkey AS VARCHAR) AS airport, l_shipdate AS time FROM lineitem)
    GROUP BY airport, time HAVING count(*) > 1"""
)
def repeated_weather_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return repeated_hours(
        lines.select(F.col("l_suppkey").cast("string").alias("airport"), F.col("l_shipdate").alias("time"))
    )


LAST_CARRIER_SQL = """last_carriers AS (
    SELECT Code, Carrier FROM (
        SELECT *, row_number() OVER (PARTITION BY Code ORDER BY seq DESC) AS place FROM carriers)
    WHERE place = 1)"""


@checked(
    f""", {LAST_CARRIER_SQL}
    SELECT f.OP_CARRIER, f.FL_DATE, f.OP_CARRIER_FL_NUM, c.Carrier AS CARRIER_NAME
    FROM flights AS f LEFT JOIN last_carriers AS c ON f.OP_CARRIER = c.Code""",
    "flights carriers",
)
def lookup_carrier(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = view(spark, sf_dir, "flights").select("OP_CARRIER", "FL_DATE", "OP_CARRIER_FL_NUM")
    return lookups.lookup_carrier(
        flights, view(spark, sf_dir, "carriers"), order=["seq"], output="CARRIER_NAME"
    )


CLEAN_AIRPORTS_SQL = """clean_airports AS (
    SELECT * REPLACE (CASE WHEN time_zone NOT IN ('Mars/Base', 'america/denver') THEN time_zone END AS time_zone)
    FROM airports)"""
RAW_FLIGHT_COLUMNS = RAW_FLIGHTS.names


def airport_sides_sql() -> str:
    return ", ".join(
        f"{alias}.{source} AS {target}_{side}"
        for alias, side in (("o", "ORIGIN"), ("d", "DEST"))
        for source, target in AIRPORT_FEATURES.items()
    )


@checked(
    f""", {CLEAN_AIRPORTS_SQL}
    SELECT f.FL_DATE, f.OP_CARRIER, f.OP_CARRIER_FL_NUM, f.ORIGIN, f.DEST, {airport_sides_sql()}
    FROM flights AS f LEFT JOIN clean_airports AS o ON f.ORIGIN = o.code
    LEFT JOIN clean_airports AS d ON f.DEST = d.code""",
    "flights airports",
)
def lookup_airport(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = view(spark, sf_dir, "flights").select(
        "FL_DATE", "OP_CARRIER", "OP_CARRIER_FL_NUM", "ORIGIN", "DEST"
    )
    return lookups.lookup_airport(flights, lookups.clean_airports(view(spark, sf_dir, "airports")))


FIRST_STATION_SQL = """served AS (
    SELECT a.code AS airport, a.icao, s.station
    FROM airports AS a LEFT JOIN (
        SELECT icao, station FROM (
            SELECT *, row_number() OVER (PARTITION BY icao ORDER BY seq) AS place FROM stations)
        WHERE place = 1) AS s ON a.icao = s.icao)"""


@checked(
    f""", {FIRST_STATION_SQL}
    SELECT w.airport, s.icao, s.station FROM (SELECT DISTINCT ORIGIN AS airport FROM flights) AS w
    LEFT JOIN served AS s ON w.airport = s.airport""",
    "flights airports stations",
)
def lookup_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = unions.distinct_keys(view(spark, sf_dir, "flights"), "ORIGIN")
    return lookups.lookup_station(
        wanted.withColumnRenamed("ORIGIN", "airport"),
        view(spark, sf_dir, "airports"),
        view(spark, sf_dir, "stations"),
        order=["seq"],
    )


@checked(
    """SELECT DISTINCT OP_CARRIER AS airport FROM flights
    WHERE OP_CARRIER NOT IN (SELECT Code FROM carriers)""",
    "flights carriers",
)
def unmatched_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = view(spark, sf_dir, "flights").select(F.col("OP_CARRIER").alias("airport"))
    return lookups.unmatched_airports(wanted, view(spark, sf_dir, "carriers"), obtained_column="Code")


@checked(
    """, gaps AS (
        SELECT p.c_custkey, q.city, q.state, q.country, q.town,
               2 * 6371.0088 * asin(least(1, sqrt(
                   power(sin(radians(q.latitude - p.latitude) / 2), 2)
                   + cos(radians(p.latitude)) * cos(radians(q.latitude))
                     * power(sin(radians(q.longitude - p.longitude) / 2), 2)))) AS km
        FROM points AS p, places AS q)
    SELECT p.c_custkey, b.city, b.state, b.country, b.town, round(b.km, 3) AS distance_km
    FROM points AS p LEFT JOIN (
        SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY km, city) AS place
        FROM gaps WHERE km <= 250) AS b ON p.c_custkey = b.c_custkey AND b.place = 1""",
    "points places",
    name="nearest_place",
)
def nearest_place_of_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = nearest_place(
        view(spark, sf_dir, "points"), view(spark, sf_dir, "places"), "c_custkey", radius_km=250
    )
    return found.withColumn("distance_km", F.round("distance_km", 3))



@checked(
    """SELECT c_custkey,
              coalesce(city, NULLIF(found_city, ''), found_town) AS city,
              coalesce(state, NULLIF(found_state, '')) AS state,
              coalesce(country, NULLIF(found_country, '')) AS country
       FROM (SELECT c_custkey,
                    CASE WHEN c_nationkey % 3 = 0 THEN c_mktsegment END AS city,
                    CASE WHEN c_nationkey % 4 = 0 THEN c_mktsegment END AS state,
                    CASE WHEN c_nationkey % 2 = 0 THEN c_mktsegment END AS country,
                    CASE WHEN c_nationkey % 5 = 0 THEN '' ELSE n_name END AS found_city,
                    CASE WHEN c_nationkey % 7 = 0 THEN '' ELSE n_name END AS found_state,
                    r_name AS found_country, c_name AS found_town
             FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
)
def backfill_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation, region = (table(spark, sf_dir, n) for n in ("customer", "nation", "region"))
    key = F.col("c_nationkey")
    found = customer.join(nation, customer.c_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey
    )
    shaped = found.select(
        "c_custkey",
        F.when(key % 3 == 0, F.col("c_mktsegment")).alias("city"),
        F.when(key % 4 == 0, F.col("c_mktsegment")).alias("state"),
        F.when(key % 2 == 0, F.col("c_mktsegment")).alias("country"),
        F.when(key % 5 == 0, "").otherwise(F.col("n_name")).alias("found_city"),
        F.when(key % 7 == 0, "").otherwise(F.col("n_name")).alias("found_state"),
        F.col("r_name").alias("found_country"),
        F.col("c_name").alias("found_town"),
    )
    return lookups.backfill_missing(shaped).select("c_custkey", "city", "state", "country")


@checked(
    f""", {CLEAN_AIRPORTS_SQL}, {LAST_CARRIER_SQL}, kept AS (
        SELECT * FROM clean_airports WHERE country = 'US' AND code IN (SELECT ORIGIN FROM whitelist))
    SELECT {', '.join('f.' + c for c in RAW_FLIGHT_COLUMNS)}, c.Carrier AS OP_CARRIER_NAME, {airport_sides_sql()}
    FROM flights AS f LEFT JOIN last_carriers AS c ON f.OP_CARRIER = c.Code
    LEFT JOIN kept AS o ON f.ORIGIN = o.code LEFT JOIN kept AS d ON f.DEST = d.code
    WHERE f.ORIGIN IN (SELECT ORIGIN FROM whitelist)""",
    "flights airports whitelist carriers",
)
def enriched_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw flights through whitelist, carrier and airport lookups."""
    whitelist = view(spark, sf_dir, "whitelist")
    return enrich_flights(
        view(spark, sf_dir, "flights").select(*RAW_FLIGHT_COLUMNS),
        whitelist,
        view(spark, sf_dir, "carriers"),
        prepare_airports(view(spark, sf_dir, "airports"), whitelist),
        carrier_order=["seq"],
    )


# ------------------------------------------------------------------ aggregations


@checked("SELECT DISTINCT o_custkey FROM orders")
def distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unions.distinct_keys(table(spark, sf_dir, "orders"), "o_custkey")


@checked(
    "SELECT min(FL_DATE) AS start_date, CAST(max(FL_DATE) + INTERVAL 3 DAY AS DATE) AS end_date FROM flights",
    "flights",
)
def date_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.date_bounds(view(spark, sf_dir, "flights"))


@checked("SELECT ORIGIN, avg(DEP_DELAY) AS avg_dep_delay FROM flights GROUP BY ORIGIN", "flights")
def avg_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = view(spark, sf_dir, "flights")
    return flights.groupBy("ORIGIN").agg(agg.avg_delay("DEP_DELAY").alias("avg_dep_delay"))


@checked(
    "SELECT ORIGIN, DEST, CAST(count(*) AS BIGINT) AS total_flight_cnt FROM flights GROUP BY ORIGIN, DEST",
    "flights",
)
def flight_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = view(spark, sf_dir, "flights")
    return flights.groupBy("ORIGIN", "DEST").agg(agg.flight_count().alias("total_flight_cnt"))


@checked(
    """SELECT FL_DATE, CAST(count(*) FILTER (WHERE DEP_DELAY > 15) AS BIGINT) AS delayed_cnt
    FROM flights GROUP BY FL_DATE""",
    "flights",
)
def delayed_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = view(spark, sf_dir, "flights")
    return flights.groupBy("FL_DATE").agg(agg.delayed_count("DEP_DELAY").alias("delayed_cnt"))


@checked(
    "SELECT OP_CARRIER, sum(CANCELLED) AS cancelled_cnt, sum(DIVERTED) AS diverted_cnt FROM flights GROUP BY OP_CARRIER",
    "flights",
)
def flag_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = view(spark, sf_dir, "flights")
    return flights.groupBy("OP_CARRIER").agg(
        agg.flag_sum("CANCELLED").alias("cancelled_cnt"), agg.flag_sum("DIVERTED").alias("diverted_cnt")
    )


@checked(
    """SELECT DEST, count(*) FILTER (WHERE DEP_DELAY > 15) / count(*) AS delay_ratio,
              sum(CANCELLED) / count(*) AS cancelled_ratio, sum(DIVERTED) / count(*) AS diverted_ratio
    FROM flights GROUP BY DEST""",
    "flights",
)
def ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = view(spark, sf_dir, "flights").groupBy("DEST").agg(
        agg.flight_count().alias("total"),
        agg.delayed_count("DEP_DELAY").alias("delayed"),
        agg.flag_sum("CANCELLED").alias("cancelled"),
        agg.flag_sum("DIVERTED").alias("diverted"),
    )
    return counts.select(
        "DEST",
        agg.ratio("delayed", "total").alias("delay_ratio"),
        agg.ratio("cancelled", "total").alias("cancelled_ratio"),
        agg.ratio("diverted", "total").alias("diverted_ratio"),
    )


LABELS_SQL = ", ".join(
    f"coalesce({c}, 'ALL') AS {c}"
    for c in ("origin", "dest", "airport_name_origin", "airport_name_dest", "op_carrier_name", "op_carrier")
)


@checked(
    f"""SELECT {LABELS_SQL}, longitude_origin, latitude_origin, longitude_dest, latitude_dest,
               total_flight_cnt, delayed_cnt, delay_ratio, cancelled_cnt, cancelled_ratio,
               diverted_cnt, diverted_ratio
        FROM (SELECT ORIGIN AS origin, DEST AS dest, AIRPORT_NAME_ORIGIN AS airport_name_origin,
                     AIRPORT_NAME_DEST AS airport_name_dest, OP_CARRIER_NAME AS op_carrier_name,
                     OP_CARRIER AS op_carrier, {COORDINATES_SQL}, {MEASURES_SQL}
              FROM flights {LOCALE_SETS_SQL})""",
    "flights",
)
def measures_by_locale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.measures_by_locale(view(spark, sf_dir, "flights"))


@checked(
    f""", {TIMED_SQL}
    SELECT year, month, day, dayname, season, avg(DEP_DELAY) AS avg_dep_delay, {MEASURES_SQL}
    FROM (SELECT *, {calendar_sql('DEP_TIME_UTC')} FROM timed)
    GROUP BY GROUPING SETS ((season), (dayname), (day), (month), (year))""",
    "flights",
)
def measures_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.measures_by_time(measures.star_plus(timed_flights(spark, sf_dir)))


@checked(
    f""", {TIMED_SQL}
    SELECT year, month, day, dayname, season, avg(DEP_DELAY) AS avg_dep_delay, {MEASURES_SQL}
    FROM (SELECT *, {calendar_sql('DEP_TIME_UTC')} FROM timed)
    GROUP BY GROUPING SETS ((season), (dayname), (day), (month), (year))""",
    "flights",
)
def published_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The measures by time as published: written, and read back through their view."""
    path = scratch_path(spark, "measures_by_time")
    files.write_parquet(measures_by_time(spark, sf_dir), path)
    catalog.publish_view(spark, "crosswind_measures_by_time", path)
    return spark.table("crosswind_measures_by_time")


@checked(
    f"""SELECT coalesce(op_carrier_name, 'ALL') AS op_carrier_name, coalesce(origin, 'ALL') AS origin,
               grouping_id, total_flight_cnt
        FROM (SELECT OP_CARRIER_NAME AS op_carrier_name, ORIGIN AS origin,
                     CAST(GROUPING(OP_CARRIER_NAME, ORIGIN) AS BIGINT) AS grouping_id,
                     CAST(count(*) AS BIGINT) AS total_flight_cnt
              FROM flights
              GROUP BY GROUPING SETS ((OP_CARRIER_NAME), (OP_CARRIER_NAME, ORIGIN), ()))""",
    "flights",
)
def label_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights without a carrier name also read ALL; the grouping id tells them apart."""
    grouped = agg.grouped_measures(
        view(spark, sf_dir, "flights"), [["op_carrier_name"], ["op_carrier_name", "origin"], []]
    )
    labelled_rows = agg.label_totals(grouped, ["op_carrier_name", "origin"])
    return labelled_rows.select("op_carrier_name", "origin", "grouping_id", "total_flight_cnt")


@checked(
    f"""{JOINED_SQL}, traffic AS (
        SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 'click' WHEN o_orderpriority = '2-HIGH' THEN 'error'
                    WHEN o_orderpriority = '3-MEDIUM' THEN 'purchase'
                    WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'signup' ELSE 'view' END AS ORIGIN,
               CAST(sum(o_custkey) AS BIGINT) AS PASSENGERS, CAST(sum(o_orderkey) AS BIGINT) AS FREIGHT_TONS
        FROM orders GROUP BY 1)
    SELECT p.ORIGIN, a.name AS AIRPORT, round(p.ratio, 6) AS WEATHER_NULL_RATIO, t.PASSENGERS, t.FREIGHT_TONS
    FROM (SELECT ORIGIN, avg(CASE WHEN ORIGIN_WEATHER_CONDITION IS NULL THEN 1 ELSE 0 END) AS ratio
          FROM joined GROUP BY ORIGIN) AS p LEFT JOIN traffic AS t ON p.ORIGIN = t.ORIGIN
          LEFT JOIN airports AS a ON p.ORIGIN = a.code
    WHERE p.ratio <= 0.9 AND t.PASSENGERS >= 1000""",
    "flights weather airports",
)
def airport_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = {"1-URGENT": "click", "2-HIGH": "error", "3-MEDIUM": "purchase", "4-NOT SPECIFIED": "signup"}
    code = F.lit("view")
    for priority, airport in codes.items():
        code = F.when(F.col("o_orderpriority") == priority, airport).otherwise(code)
    traffic = table(spark, sf_dir, "orders").select(
        code.alias("ORIGIN"),
        F.col("o_custkey").alias("PASSENGERS"),
        F.col("o_orderkey").alias("FREIGHT_TONS"),
    )
    profile = measures.airport_profile(
        timed_flights(spark, sf_dir),
        view(spark, sf_dir, "weather"),
        traffic,
        view(spark, sf_dir, "airports"),
        max_null_ratio=0.9,
        min_passengers=1000,
    )
    return profile.withColumn("WEATHER_NULL_RATIO", F.round("WEATHER_NULL_RATIO", 6))


# ---------------------------------------------------------------- set operations


@checked(
    """SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority,
              CASE WHEN year(o_orderdate) >= 1998 THEN o_orderstatus END AS o_orderstatus FROM orders"""
)
def union_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two spans of years, the earlier without the status column."""
    orders = table(spark, sf_dir, "orders")
    # A date bound reaches the scan, a year taken of the date does not.
    turn = F.lit("1998-01-01").cast("timestamp_ntz")
    early = orders.where(F.col("o_orderdate") < turn).drop("o_orderstatus")
    late = orders.where(F.col("o_orderdate") >= turn).select(*reversed(orders.columns))
    return unions.union_files([early, late])


@checked("SELECT event_id, ts, value, event_type AS airport FROM events")
def union_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dataset per kind of event, read back in one scan."""
    folder = scratch_path(spark, "events")
    events = table(spark, sf_dir, "events").withColumn("kind", F.col("event_type"))
    files.write_parquet(events, folder, partition_by=("kind",))
    kinds = ["click", "error", "purchase", "signup", "view"]
    paths = {kind: f"{folder}/kind={kind}" for kind in kinds}
    return unions.scan_tagged(spark, paths, columns=["event_id", "ts", "value"])


@checked("""SELECT event_id, value, event_type AS kind, CASE WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END AS airport FROM events""")
def union_tagged_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two datasets in folders by kind, under paths with a blank and with letters beyond ASCII."""
    folder = scratch_path(spark, "events")
    paths = {"even": f"{folder}/even numbers", "odd": f"{folder}/ungerade Größe"}
    events = table(spark, sf_dir, "events").select("event_id", "value", F.col("event_type").alias("kind"))
    for rest, path in enumerate(paths.values()):
        files.write_parquet(events.where(F.col("event_id") % 2 == rest), path, partition_by=("kind",))
    return unions.scan_tagged(spark, paths, columns=["event_id", "value"], folders=("kind",))


@checked(
    f""", {FIRST_STATION_SQL}
    SELECT h.time, h.temp, h.prcp, h.rhum, h.wspd, s.airport, h.coco
    FROM hourly AS h JOIN served AS s ON h.station = s.station
    WHERE s.airport IN (SELECT ORIGIN FROM flights)
      AND h.time >= (SELECT min(FL_DATE) FROM flights)
      AND h.time <= (SELECT max(FL_DATE) + INTERVAL 3 DAY FROM flights)""",
    "flights airports stations hourly",
)
def collected_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours of each origin's station, tagged with the airport."""
    stations = view(spark, sf_dir, "stations")
    first = lookups.first_wins(stations, "icao", ["seq"])
    return collect_weather(
        view(spark, sf_dir, "flights"),
        view(spark, sf_dir, "airports"),
        first,
        view(spark, sf_dir, "hourly"),
    )


# --------------------------------------------------------------- derived columns

TIME_KEYS = ["FL_DATE", "OP_CARRIER", "OP_CARRIER_FL_NUM", "DEP_TIME"]


def time_oracle(column: str) -> str:
    return f", {TIMED_SQL} SELECT {', '.join(TIME_KEYS)}, {column} FROM timed"


@checked(time_oracle("DEP_TIME_LOCAL"), "flights")
def departure_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    local = clock.departure_local(F.col("FL_DATE"), F.col("DEP_TIME"))
    return view(spark, sf_dir, "flights").select(*TIME_KEYS, local.alias("DEP_TIME_LOCAL"))


@checked(time_oracle("DEP_TIME_UTC"), "flights")
def departure_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timed_flights(spark, sf_dir).select(*TIME_KEYS, "DEP_TIME_UTC")


@checked(time_oracle("ARR_TIME_UTC"), "flights")
def arrival_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timed_flights(spark, sf_dir).select(*TIME_KEYS, "ARR_TIME_UTC")


@checked(time_oracle("ARR_TIME_LOCAL"), "flights")
def arrival_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timed_flights(spark, sf_dir).select(*TIME_KEYS, "ARR_TIME_LOCAL")


@checked(
    f"SELECT OP_CARRIER, FL_DATE, DEP_DELAY, {band_sql('DEP_DELAY', 'Early_Departure')} AS DEP_DELAY_CATEGORY FROM flights",
    "flights",
    name="departure_delay_band",
)
def departure_delay_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = view(spark, sf_dir, "flights").select("OP_CARRIER", "FL_DATE", "DEP_DELAY")
    return flights.withColumn("DEP_DELAY_CATEGORY", departure_delay_band(F.col("DEP_DELAY")))


@checked(
    f"SELECT OP_CARRIER, FL_DATE, ARR_DELAY, {band_sql('ARR_DELAY', 'Early_Arrival')} AS ARR_DELAY_CATEGORY FROM flights",
    "flights",
    name="arrival_delay_band",
)
def arrival_delay_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = view(spark, sf_dir, "flights").select("OP_CARRIER", "FL_DATE", "ARR_DELAY")
    return flights.withColumn("ARR_DELAY_CATEGORY", arrival_delay_band(F.col("ARR_DELAY")))


MEASURED = ["time", "airport", "temp", "prcp", "rhum", "wspd", "coco"]


def rule_label():
    return weather_rule_label("prcp", "temp", "rhum", "wspd")


@checked(f", {LABELLED_SQL} SELECT {', '.join(MEASURED)}, rule_label FROM labelled", "weather", name="weather_rule_label")
def weather_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "weather").withColumn("rule_label", rule_label())


@checked(f", {LABELLED_SQL} SELECT {', '.join(MEASURED)}, label FROM labelled", "weather", name="weather_code_label")
def weather_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = weather_code_label(F.col("coco"), rule_label())
    return view(spark, sf_dir, "weather").withColumn("label", label)



@checked(f"SELECT o_orderkey, {calendar_sql('o_orderdate')} FROM orders")
def calendar_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.withColumns(calendar_columns(F.col("o_orderdate"))).drop(*orders.columns[1:])


@checked(
    f""", {TIMED_SQL}
    SELECT {', '.join(TIME_KEYS)},
           CASE WHEN dayofweek(DEP_TIME_UTC) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
           CASE WHEN dayofweek(DEP_TIME_UTC) BETWEEN 1 AND 5 THEN 1 ELSE 0 END AS is_weekday
    FROM timed""",
    "flights",
)
def weekend_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    departure = F.col("DEP_TIME_UTC")
    return timed_flights(spark, sf_dir).select(
        *TIME_KEYS, is_weekend(departure).alias("is_weekend"), is_weekday(departure).alias("is_weekday")
    )


@checked(
    """SELECT o_orderkey, CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'Winter'
        WHEN month(o_orderdate) <= 5 THEN 'Spring' WHEN month(o_orderdate) <= 8 THEN 'Summer'
        WHEN month(o_orderdate) <= 11 THEN 'Autumn' END AS season FROM orders""",
    name="season",
)
def seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", season(F.month("o_orderdate")).alias("season")
    )

