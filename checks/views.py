"""Flight-shaped views of the given tables.

The texts are SQL that Spark and DuckDB both read, so the queries and their
oracles start from the same rows. ``{name}`` stands for a given table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VIEWS = {
    # One flight per event: airports are event types, carriers are users.
    "flights": """
        SELECT CAST(ts AS DATE) AS FL_DATE,
               CAST(user_id AS STRING) AS OP_CARRIER,
               CAST(event_id % 5000 AS INT) AS OP_CARRIER_FL_NUM,
               event_type AS ORIGIN,
               CASE event_id % 5 WHEN 0 THEN 'click' WHEN 1 THEN 'error' WHEN 2 THEN 'purchase'
                    WHEN 3 THEN 'signup' ELSE 'view' END AS DEST,
               CAST(hour(ts) * 100 + minute(ts) AS DOUBLE) AS CRS_DEP_TIME,
               CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 97 = 0 THEN CAST(2400 AS DOUBLE)
                    ELSE CAST(hour(ts) * 100 + minute(ts) AS DOUBLE) END AS DEP_TIME,
               CASE WHEN event_id % 50 = 0 THEN NULL
                    ELSE CAST(event_id % 200 - 20 AS DOUBLE) END AS DEP_DELAY,
               CAST((hour(ts) + 2) % 24 * 100 + minute(ts) AS DOUBLE) AS CRS_ARR_TIME,
               CASE WHEN event_id % 50 = 0 THEN NULL
                    ELSE CAST((hour(ts) + 3) % 24 * 100 + minute(ts) AS DOUBLE) END AS ARR_TIME,
               CASE WHEN event_id % 50 = 0 THEN NULL
                    ELSE CAST(event_id % 210 - 30 AS DOUBLE) END AS ARR_DELAY,
               CAST(CASE WHEN event_id % 40 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS CANCELLED,
               CAST(CASE WHEN event_id % 61 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS DIVERTED,
               CASE WHEN event_id % 50 = 0 THEN NULL
                    ELSE CAST(event_id % 300 AS DOUBLE) END AS ACTUAL_ELAPSED_TIME,
               CASE event_id % 4 WHEN 0 THEN 'America/New_York' WHEN 1 THEN 'America/Chicago'
                    WHEN 2 THEN 'Pacific/Honolulu' ELSE 'Unknown' END AS TIME_ZONE_ORIGIN,
               CASE event_id % 3 WHEN 0 THEN 'America/Denver' WHEN 1 THEN 'America/Los_Angeles'
                    ELSE 'Unknown' END AS TIME_ZONE_DEST,
               concat('City of ', event_type) AS CITY_ORIGIN,
               CAST(NULL AS STRING) AS CITY_DEST,
               substring(event_type, 1, 2) AS STATE_ORIGIN,
               CAST(NULL AS STRING) AS STATE_DEST,
               'US' AS COUNTRY_ORIGIN,
               CASE WHEN event_id % 5 = 4 THEN NULL ELSE 'US' END AS COUNTRY_DEST,
               CAST(length(event_type) * -20 AS DOUBLE) AS LONGITUDE_ORIGIN,
               CAST(event_id % 5 * -20 AS DOUBLE) AS LONGITUDE_DEST,
               CAST(length(event_type) * 5 AS DOUBLE) AS LATITUDE_ORIGIN,
               CASE WHEN event_id % 5 = 4 THEN NULL
                    ELSE CAST(event_id % 5 * 5 AS DOUBLE) END AS LATITUDE_DEST,
               CASE WHEN user_id % 7 = 0 THEN NULL
                    ELSE concat('Carrier ', CAST(user_id AS STRING)) END AS OP_CARRIER_NAME,
               concat('Airport of ', event_type) AS AIRPORT_NAME_ORIGIN,
               CASE WHEN event_id % 5 = 4 THEN NULL
                    ELSE concat('Field ', CAST(event_id % 5 AS STRING)) END AS AIRPORT_NAME_DEST
        FROM {events}
    """,
    # One weather row for every hour and event type that has events.
    "weather": """
        SELECT time,
               CAST(k % 81 - 35 AS DOUBLE) AS temp,
               CASE WHEN k % 3 = 0 THEN CAST(0 AS DOUBLE)
                    ELSE CAST((k * 5) % 97 AS DOUBLE) / 8 END AS prcp,
               CAST((k * 11) % 101 AS DOUBLE) AS rhum,
               CAST((k * 17) % 61 AS DOUBLE) AS wspd,
               airport,
               CASE WHEN k % 2 = 0 THEN NULL ELSE CAST((k * 3) % 31 AS INT) END AS coco
        FROM (SELECT date_trunc('hour', ts) AS time,
                     event_type AS airport,
                     max(day(ts) * 24 + hour(ts)) * 7 + count(*) * 13 + max(length(event_type)) * 5 AS k
              FROM {events}
              GROUP BY date_trunc('hour', ts), event_type) AS slots
    """,
    # One airport per region.
    "airports": """
        SELECT CASE r_regionkey WHEN 0 THEN 'click' WHEN 1 THEN 'error' WHEN 2 THEN 'purchase'
                    WHEN 3 THEN 'signup' ELSE 'view' END AS code,
               concat('IC', CAST(r_regionkey AS STRING)) AS icao,
               CASE r_regionkey WHEN 0 THEN 'America/New_York' WHEN 1 THEN 'America/Chicago'
                    WHEN 2 THEN 'Mars/Base' WHEN 3 THEN 'america/denver'
                    ELSE 'America/Los_Angeles' END AS time_zone,
               CASE WHEN r_regionkey IN (1, 3) THEN NULL ELSE concat('City ', r_name) END AS city,
               CASE WHEN r_regionkey = 3 THEN NULL ELSE substring(r_name, 1, 2) END AS state,
               CASE WHEN r_regionkey = 4 THEN 'CA' ELSE 'US' END AS country,
               r_name AS name,
               CAST(30 + 3 * r_regionkey AS DOUBLE) AS latitude,
               CAST(-80 - 7 * r_regionkey AS DOUBLE) AS longitude
        FROM {region}
    """,
    "whitelist": """
        SELECT code AS ORIGIN, name AS AIRPORT FROM ({airports}) AS a WHERE name <> 'ASIA'
    """,
    # Carriers are customers; codes repeat, and seq tells which entry comes last.
    "carriers": """
        SELECT CAST(c_custkey % 1000 AS STRING) AS Code, c_name AS Carrier, c_custkey AS seq
        FROM {customer} WHERE c_mktsegment <> 'BUILDING'
    """,
    # Stations are nations; several share the code of their region.
    "stations": """
        SELECT concat('IC', CAST(n_regionkey AS STRING)) AS icao,
               concat('S', CAST(n_nationkey AS STRING)) AS station,
               n_nationkey AS seq
        FROM {nation} WHERE n_regionkey <> 2
    """,
    # Hourly values by station, one station per block of users.
    "hourly": """
        SELECT time,
               concat('S', CAST(block AS STRING)) AS station,
               CAST(n AS DOUBLE) AS temp,
               CAST(n % 3 AS DOUBLE) AS prcp,
               CAST(50 + n AS DOUBLE) AS rhum,
               CAST(5 * n AS DOUBLE) AS wspd,
               CAST(n % 30 AS INT) AS coco
        FROM (SELECT date_trunc('hour', ts) AS time, user_id % 25 AS block, count(*) AS n
              FROM {events} GROUP BY date_trunc('hour', ts), user_id % 25) AS slots
    """,
    # Points and places on the globe, scattered by their keys.
    "points": """
        SELECT c_custkey,
               CAST(c_custkey * 7919 % 17011 AS DOUBLE) / 170.11 - 50 AS latitude,
               CAST(c_custkey * 104729 % 36007 AS DOUBLE) / 100.0193 - 180 AS longitude
        FROM {customer}
    """,
    "places": """
        SELECT concat('City ', CAST(p_partkey AS STRING)) AS city,
               p_brand AS state,
               p_type AS country,
               p_name AS town,
               CAST(p_partkey * 6007 % 17021 AS DOUBLE) / 170.21 - 50 AS latitude,
               CAST(p_partkey * 90001 % 36011 AS DOUBLE) / 100.0308 - 180 AS longitude
        FROM {part}
    """,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view in Spark."""
    text = _expanded(VIEWS[name])
    names = sorted(set(re.findall(r"\{(\w+)\}", text)))
    df = spark.sql(text, **{n: table(spark, sf_dir, n) for n in names})
    if "time" in df.columns:
        df = df.withColumn("time", F.col("time").cast("timestamp_ntz"))
    return df


def with_views(names: str, query: str) -> str:
    """An oracle query that may use the named views."""
    parts = [f"{n} AS ({re.sub(r'[{}]', '', _expanded(VIEWS[n]))})" for n in names.split()]
    return f"WITH {', '.join(parts)} {query}"


def _expanded(text: str) -> str:
    """Views named inside a view put in place."""
    for name, body in VIEWS.items():
        if "{" + name + "}" in text:
            text = text.replace("{" + name + "}", body)
    return text
