"""Nearest places against brute force, with crowded spots, poles and the date line."""

from __future__ import annotations

import math
import random

import pytest

from crosswind.functions.geo import EARTH_RADIUS_KM
from crosswind.operators import nearest
from crosswind.operators.nearest import nearest_place
from crosswind.session import settle


def km(a, b, c, d):
    a, b, c, d = map(math.radians, (a, b, c, d))
    h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
    return 2 * EARTH_RADIUS_KM * math.asin(math.sqrt(h))


def scattered(rng, n):
    """A third of the positions within about a kilometre of each other."""
    return [
        (i, 40 + rng.random() / 100, -70 + rng.random() / 100)
        if i % 3 == 0
        else (i, rng.uniform(-90, 90), rng.uniform(-180, 180))
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def positions():
    rng = random.Random(5)
    points = scattered(rng, 150) + [(900, 89.99, 0.0), (901, 89.99, 179.0), (902, 0.0, 179.99)]
    places = scattered(rng, 600) + [(5000, 89.99, -170.0), (5001, 0.0, -179.9)]
    return points, places


@pytest.mark.parametrize(("crowd", "limit"), [(1000, 1 << 26), (60, 1 << 26), (4, 1 << 26), (1000, 0), (4, 0)])
def test_nearest_equals_brute_force(spark, positions, crowd, limit):
    points, places = positions
    p = spark.createDataFrame(points + [(999, None, 1.0)], "id int, latitude double, longitude double")
    q = spark.createDataFrame(places, "city int, latitude double, longitude double")
    found = nearest_place(p, q, "id", columns=["city"], radius_km=400, crowd=crowd, limit=limit)
    got = {r.id: (r.city, r.distance_km) for r in found.collect()}
    assert got.pop(999) == (None, None)
    assert len(got) == len(points)
    for i, lat, lon in points:
        distance, city = min((km(lat, lon, a, b), c) for c, a, b in places)
        if distance > 400:
            assert got[i] == (None, None)
        else:
            assert got[i][0] == city
            assert got[i][1] == pytest.approx(distance, abs=1e-6)


def test_equal_places_resolve_to_the_smallest(spark):
    p = spark.createDataFrame([(1, 10.0, 20.0), (2, 10.0, 20.0)], "id int, latitude double, longitude double")
    q = spark.createDataFrame(
        [("b", 10.0, 20.0), ("a", 10.0, 20.0)], "city string, latitude double, longitude double"
    )
    got = nearest_place(p, q, "id", columns=["city"]).collect()
    assert sorted((r.id, r.city, r.distance_km) for r in got) == [(1, "a", 0.0), (2, "a", 0.0)]


def jobs_of(spark, name, work):
    spark.sparkContext.setJobGroup(name, name)
    try:
        return work(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_crowded_cubes_of_any_depth(spark):
    """Towns of a kilometre, a metre and a millimetre beside scattered places: exact, and by as many jobs."""
    rng = random.Random(8)
    jobs = []
    for degrees in (1e-2, 1e-5, 1e-8):
        town = [(i, 40 + rng.random() * degrees, -70 + rng.random() * degrees) for i in range(3000)]
        wide = [(5000 + i, rng.uniform(39, 41), rng.uniform(-71, -69)) for i in range(150)]
        points = [(i, 40 + rng.uniform(-1, 2) * degrees, -70 + rng.uniform(-1, 2) * degrees) for i in range(40)]
        points += [(100 + i, rng.uniform(39, 41), rng.uniform(-71, -69)) for i in range(40)]
        p = spark.createDataFrame(points, "id int, latitude double, longitude double")
        q = spark.createDataFrame(town + wide, "city int, latitude double, longitude double")
        found, n = jobs_of(spark, f"town-{degrees}", lambda: nearest_place(p, q, "id", columns=["city"], radius_km=300, crowd=8).collect())
        jobs.append(n)
        got = {r.id: r for r in found}
        place = {c: (a, b) for c, a, b in town + wide}
        for i, lat, lon in points:
            least = min(km(lat, lon, a, b) for a, b in place.values())
            assert km(lat, lon, *place[got[i].city]) == pytest.approx(least, abs=1e-7)
    assert len(set(jobs)) == 1


def test_places_packed_along_the_curve(spark):
    """Every leaf holds no more places than it should, however crowded its cube, and sparse cubes are one leaf."""
    rng = random.Random(9)
    town = [(i, 40 + rng.random() * 1e-9, -70 + rng.random() * 1e-9) for i in range(5000)]
    lone = [(5000 + i, -40.0 + i, 100.0) for i in range(20)]
    sites = nearest._in_cubes(spark.createDataFrame(town + lone, "place int, lat double, lon double"), 0.01)
    ordered = nearest._in_order(sites, 0.01)
    leaves = ordered.groupBy(*nearest.CUBE, "part", nearest._node(50).alias("node")).count().collect()
    assert max(r["count"] for r in leaves) <= 50
    assert sum(r["count"] for r in leaves) == 5020
    assert len(leaves) <= 5000 / 50 + 20 + 2 * 8


def test_rows_grow_with_the_points_alone(spark, monkeypatch):
    """However dense the places, a point goes on with few nodes, and its pairs with places are never rows."""
    rng = random.Random(10)
    points = [(i, rng.uniform(38, 42), rng.uniform(-72, -68)) for i in range(400)]
    p = spark.createDataFrame(points, "id int, latitude double, longitude double")
    kept = []
    monkeypatch.setattr(nearest, "settle", lambda df, name: kept.append((name, settle(df, name))) or kept[-1][1])
    rows = []
    for n in (1500, 6000):
        q = spark.createDataFrame([(i, rng.uniform(38, 42), rng.uniform(-72, -68)) for i in range(n)], "city int, latitude double, longitude double")
        kept.clear()
        assert nearest_place(p, q, "id", columns=["city"], radius_km=50, limit=0).where("city IS NOT NULL").count() == 400
        rows.append([df.count() for name, df in kept if name == "near"])
        # A leaf is one row, which holds its places.
        leaves = next(df for name, df in kept if name == "leaves")
        assert leaves.count() < n / 4
        assert leaves.selectExpr("sum(size(held))").first()[0] == n
    assert max(map(max, rows)) <= 3 * 400


def test_equal_gaps_across_leaves_and_cubes(spark):
    """Places equally far on all sides of a point, in different cubes: the smallest counts, however they are packed."""
    sides = [("d", 0.0, 0.5), ("c", 0.0, -0.5), ("b", 0.0, 0.5), ("a", 0.0, -0.5)]
    q = spark.createDataFrame(sides, "city string, latitude double, longitude double")
    p = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 0.5), (3, 0.0, 9.0)], "id int, latitude double, longitude double")
    for crowd in (1, 200):
        got = nearest_place(p, q, "id", columns=["city"], radius_km=60, crowd=crowd).collect()
        assert sorted((r.id, r.city) for r in got) == [(1, "a"), (2, "b"), (3, None)]
