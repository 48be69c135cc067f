"""Lookup joins: the broadcast and the shuffled way give the same rows, under skew too."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from crosswind.operators import joins
from crosswind.operators.lookups import first_wins, last_wins, lookup_airport, lookup_carrier, lookup_station


@pytest.fixture(scope="module")
def skewed(spark):
    """9000 facts: a third on one key, a third without key, the rest on many keys."""
    n = F.col("id")
    key = F.when(n % 3 == 0, F.lit(7)).when(n % 3 == 1, None).otherwise(n % 500 + 1000)
    return spark.range(9000).select(n.alias("row"), key.cast("int").alias("k"))


@pytest.fixture(scope="module")
def lookup(spark):
    """Names of most keys; key 7 occurs twice, one entry has no key."""
    many = spark.range(1000, 1400).select(F.col("id").cast("int").alias("code"), F.concat(F.lit("n"), "id").alias("name"))
    few = spark.createDataFrame([(7, "a"), (7, "b"), (None, "none")], "code int, name string")
    return many.unionByName(few)


def rows(df):
    return sorted(tuple(r) for r in df.selectExpr("row", "coalesce(k, -1)", "coalesce(name, '')").collect())


@pytest.mark.parametrize("how", ["left", "inner"])
def test_spread_join_equals_plain_join(skewed, lookup, how):
    plain = skewed.join(lookup, skewed.k == lookup.code, how).drop("code")
    assert rows(joins.lookup_join(skewed, lookup, {"k": "code"}, how, limit=0)) == rows(plain)
    assert rows(joins.lookup_join(skewed, lookup, {"k": "code"}, how)) == rows(plain)


@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
def test_semi_and_anti_keep_each_row_once(skewed, lookup, how):
    plain = sorted(r.row for r in skewed.join(lookup, skewed.k == lookup.code, how).collect())
    for limit in (0, joins.BROADCAST_BYTES):
        got = joins.lookup_join(skewed, lookup, {"k": "code"}, how, limit=limit)
        assert got.columns == ["row", "k"]
        assert sorted(r.row for r in got.collect()) == plain


def heavy_grid(facts):
    return joins.heavy_keys(facts, [["k"]]).withColumn("parts", F.lit(1))


def test_heavy_keys_are_few_and_cut(spark, skewed):
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    heavy = joins.heavy_keys(skewed, [["k"]]).collect()
    assert [r.key_0 for r in heavy] == [7]
    assert heavy[0].pieces == partitions / 2
    pieces = joins.spread_facts(skewed, ["k"], heavy_grid(skewed))
    largest = pieces.groupBy("k", "_piece").count().agg(F.max("count")).first()[0]
    assert largest < 1.3 * 9000 / partitions


def test_pieces_follow_from_the_row_alone(skewed):
    heavy = heavy_grid(skewed)
    once = joins.spread_facts(skewed, ["k"], heavy)
    again = joins.spread_facts(skewed.repartition(5).orderBy(F.desc("row")), ["k"], heavy)
    assert once.exceptAll(again).count() == 0


def test_key_sets_are_counted_together(spark):
    df = spark.range(1000).select(
        F.lit("a").alias("one"), F.when(F.col("id") < 900, "a").otherwise("b").alias("two")
    )
    heavy = {r.key_0: r.pieces for r in joins.heavy_keys(df, [["one"], ["two"]]).collect()}
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert heavy["a"] == -(-1900 * 2 * partitions // 2000)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_keys_heavy_on_both_sides(spark, how):
    """One key with a third of the facts and of the lookup rows, one heavy on each side alone, and some without a match."""
    n = F.col("id")
    key = F.when(n % 3 == 0, 1).when(n % 30 == 1, 2).when(n % 50 == 2, 4).otherwise(n + 100)
    facts = spark.range(6000).select(n.alias("row"), key.alias("k"))
    code = F.when(n % 3 == 0, 1).when(n % 3 == 1, 3).when(n % 50 == 2, 4).otherwise(n + 100_000)
    lookup = spark.range(3000).select(code.alias("code"), n.alias("value"))
    sides = facts.where("k IS NOT NULL"), lookup
    plain = facts.join(lookup, F.col("k") == F.col("code"), how).drop("code")
    joined = joins.spread_join(*sides, {"k": "code"}, how)
    counted = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("row", "k", "value").cast("decimal(38,0)"))).first()
    assert counted(joined) == counted(plain)
    assert joined.columns == plain.columns


def test_no_task_gets_a_heavy_hour_whole(spark):
    """100,000 facts and as many lookup rows of one key, which is a third of each side."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = F.col("id")
    facts = spark.range(300_000).select(n.alias("row"), F.when(n % 3 == 0, -1).otherwise(n).alias("k"))
    lookup = spark.range(300_000).select(F.when(n % 3 == 0, -1).otherwise(n).alias("code"), n.alias("value"))
    grid = joins.key_grid(facts, [["k"]], lookup, ["code"])
    assert [tuple(r) for r in grid.collect()] == [(-1, -(-partitions // 3), -(-partitions // 3))]
    left = joins.spread_facts(facts, ["k"], grid).where("k = -1").groupBy("_piece", "_part").agg(F.count("*").alias("n"))
    right = joins.copy_lookup(lookup, ["code"], grid).where("code = -1").groupBy("_piece", "_part").agg(F.count("*").alias("m"))
    cells = left.join(right, ["_piece", "_part"]).selectExpr("n", "m", "n * m AS pairs").collect()
    # Every pair is made in one cell, and no cell has much more than its share.
    assert sum(r.pairs for r in cells) == 100_000**2
    assert len(cells) == (-(-partitions // 3)) ** 2
    assert max(r.pairs for r in cells) < 1.05 * 100_000**2 / len(cells)
    assert max(r.n for r in cells) < 1.05 * 300_000 / partitions


def test_table_bytes_counts_text(spark):
    df = spark.createDataFrame([("abc", 1), (None, 2)], "s string, i int")
    size = 2 * (16 + joins.ROW_BYTES) + 3
    assert joins.table_bytes(df) == size
    assert joins.fits_broadcast(df, size)
    assert not joins.fits_broadcast(df, size - 1)
    assert joins.table_bytes(df.limit(0)) == 0


def test_table_bytes_counts_nested_values(spark):
    rows = [(("x" * 10_000, [1]), ["y" * 100] * 10, {"k": "z" * 500}, bytearray(2000), None)] * 50
    kinds = "s struct<t: string, a: array<int>>, a array<string>, m map<string, string>, b binary, n struct<t: string>"
    held = 50 * (10_000 + 1000 + 500 + 2000)
    assert held < joins.table_bytes(spark.createDataFrame(rows, kinds)) < 1.2 * held


@pytest.mark.parametrize("limit", [0, joins.BROADCAST_BYTES])
def test_facts_of_any_type_on_both_sides_of_the_limit(spark, limit):
    rows = [(i % 3, {"a": i, "b": 1}, [i, None], (i, {"c": 2}), bytearray([i % 256])) for i in range(300)]
    kinds = "k int, m map<string, int>, a array<int>, s struct<i: int, m: map<string, int>>, b binary"
    facts = spark.createDataFrame(rows, kinds)
    lookup = spark.createDataFrame([(0, "zero"), (1, "one")], "key int, name string")
    out = joins.lookup_join(facts, lookup, {"k": "key"}, limit=limit)
    assert sorted((r.k, r.m["a"], r.a[0], r.s.m["c"], r.name or "") for r in out.collect()) == sorted(
        (k, m["a"], a[0], 2, {0: "zero", 1: "one"}.get(k, "")) for k, m, a, *_ in rows
    )


def test_beyond_the_limit_nothing_is_broadcast_but_the_heavy_keys(spark):
    # A third of the facts share one key.
    facts = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k")
    lookup = spark.range(3000).selectExpr("id AS key", "id * 2 AS twice")
    grid = joins.key_grid(facts, [["k"]], lookup, ["key"])
    assert [(r.key_0, r.pieces > 1, r.parts) for r in grid.collect()] == [(0, True, 1)]
    out = joins.lookup_join(facts, lookup, {"k": "key"}, limit=0)
    assert out.where("twice = 2 * k").count() == 3000
    plan = out._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan


def test_last_and_first_entries(spark):
    df = spark.createDataFrame(
        [("a", "x", 1), ("a", "y", 3), ("a", "z", 2), ("b", None, 5), ("b", "q", 4)], "k string, v string, n int"
    )
    assert {r.k: r.v for r in last_wins(df, "k", ["n"]).collect()} == {"a": "y", "b": None}
    assert {r.k: r.v for r in first_wins(df, "k", ["n"]).collect()} == {"a": "x", "b": "q"}


def test_carrier_lookup_edges(spark):
    carriers = spark.createDataFrame(
        [("AA", "AMERICAN", 1), (None, "JUSTICE", 2), ("S6", None, 3), ("AA", "LATER", 4)],
        "Code string, Carrier string, seq int",
    )
    flights = spark.createDataFrame([("AA",), ("S6",), ("ZZ",), (None,)], "OP_CARRIER string")
    got = {r[0]: r[1] for r in lookup_carrier(flights, carriers, order=["seq"]).collect()}
    assert got == {"AA": "LATER", "S6": None, "ZZ": None, None: None}


def test_airport_lookup_names_both_ends(spark):
    airports = spark.createDataFrame(
        [("JFK", "America/New_York", "New York", "NY", "US", -73.8, 40.6, "Kennedy")],
        "code string, time_zone string, city string, state string, country string,"
        " longitude double, latitude double, name string",
    )
    flights = spark.createDataFrame([("JFK", "XXX"), ("XXX", "JFK")], "ORIGIN string, DEST string")
    got = lookup_airport(flights, airports)
    assert len(got.columns) == 16
    values = {r.ORIGIN: (r.CITY_ORIGIN, r.CITY_DEST, r.LATITUDE_DEST, r.AIRPORT_NAME_ORIGIN) for r in got.collect()}
    assert values == {"JFK": ("New York", None, None, "Kennedy"), "XXX": (None, "New York", 40.6, None)}


def test_first_station_of_a_code(spark):
    airports = spark.createDataFrame([("JFK", "KJFK"), ("ATL", "KATL"), ("NIL", None)], "code string, icao string")
    stations = spark.createDataFrame([("KJFK", "2"), ("KJFK", "1"), (None, "3")], "icao string, station string")
    wanted = spark.createDataFrame([("JFK",), ("ATL",), ("NIL",), ("ZZZ",)], "airport string")
    got = {r.airport: (r.icao, r.station) for r in lookup_station(wanted, airports, stations).collect()}
    assert got == {"JFK": ("KJFK", "1"), "ATL": ("KATL", None), "NIL": (None, None), "ZZZ": (None, None)}
