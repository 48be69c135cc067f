"""The nearest place to each point.

Space is cut into cubes whose side is the largest distance allowed, so a point
needs to look only into its own cube and the 26 around it. The places of a cube
are put in order along a curve that keeps neighbours together, and packed into
leaves of a set number of places, leaves into larger nodes of so many leaves, and
so on, each with the box around its places. A sparse cube is one leaf; a
crowded one gets as many as it needs, and nothing elsewhere changes. Points are
put on the same curve, and the places just before and after a point bound how far
away its nearest one can be. With that bound it goes from the few cubes within it
down to those leaves that can still hold its nearest place, and meets a leaf's places
within one row. The result is exact; a point never meets all places of a crowded cube,
the rows grow with the points however dense the places are, and the rounds only
with the logarithm of the places to the base of a node's size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crosswind.functions.geo import AXES, chord_of_km, km_of_chord, squared_chord, unit_vector, z_order
from crosswind.operators.joins import BROADCAST_BYTES, lookup_join
from crosswind.session import settle

# Places of a leaf, and parts of a larger node.
CROWD = 200
CUBE = [f"cube_{a}" for a in AXES]
ORDER = [*CUBE, "_z", *AXES]
PLACE_COLUMNS = ["city", "state", "country", "town"]


def nearest_place(
    points: DataFrame,
    places: DataFrame,
    key: str,
    *,
    latitude: str = "latitude",
    longitude: str = "longitude",
    columns: list[str] | None = None,
    radius_km: float = 50.0,
    crowd: int = CROWD,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """``key`` of each point with ``columns`` of its nearest place and ``distance_km``.

    Places beyond ``radius_km`` do not count; points without one get nulls. Of
    places equally near the one with the smallest values counts.
    """
    columns = columns or PLACE_COLUMNS
    chord = chord_of_km(radius_km)
    spots = _in_cubes(
        points.select(F.col(latitude).alias("lat"), F.col(longitude).alias("lon")).distinct(), chord
    )
    values = F.min(F.struct(*columns)).alias("place")
    sites = _in_cubes(
        places.groupBy(F.col(latitude).alias("lat"), F.col(longitude).alias("lon")).agg(values),
        chord,
    ).drop("lat", "lon")
    # Once written, the places keep their numbers.
    sites = settle(_in_order(sites, chord), "sites")
    # Measuring joins must not bound the points again.
    near = _around(settle(_bounded(spots, sites, chord), "bounds"), chord)
    above: list[str] = []
    for rank in range(_ranks(sites, crowd), 0, -1):
        near = settle(_descend(near, sites, above, crowd**rank, limit), "near")
        sites = sites.withColumn("node", _node(crowd**rank))
        above = ["part", "node"]
    leaf = [*CUBE, "part", "node"]
    held = settle(sites.groupBy(*leaf).agg(F.collect_list(F.struct(*AXES, "place")).alias("held")), "leaves")
    pairs = lookup_join(near, held, {c: c for c in leaf}, "inner", limit=limit)

    def measured(site):
        return F.struct(squared_chord(F.col, site.getField).alias("gap"), site.getField("place").alias("place"))

    # One row for a point and a leaf, so few are sorted for the least of them.
    found = (
        pairs.select("lat", "lon", F.array_min(F.transform("held", measured)).alias("best"))
        .groupBy("lat", "lon")
        .agg(F.min("best").alias("best"))
        .where(F.col("best.gap") <= chord * chord)
        .select("lat", "lon", "best.place.*", km_of_chord(F.col("best.gap")).alias("distance_km"))
    )
    # Measuring the result for the last join must not compute it twice.
    found = settle(found, "found")
    keyed = points.select(key, F.col(latitude).alias("_lat"), F.col(longitude).alias("_lon"))
    joined = lookup_join(keyed, found, {"_lat": "lat", "_lon": "lon"}, limit=limit)
    return joined.drop("_lat", "_lon")


def _in_cubes(df: DataFrame, side: float) -> DataFrame:
    """Coordinates as a vector, with the number of its cube on each axis."""
    df = df.dropna(subset=["lat", "lon"])
    df = df.withColumns(unit_vector(F.col("lat"), F.col("lon")))
    return df.withColumns({name: F.floor(F.col(a) / side) for a, name in zip(AXES, CUBE)})


def _dealt(df: DataFrame, side: float) -> DataFrame:
    """Rows with their place along the curve, ``_z`` within the cube, dealt to partitions by ranges of it."""
    shares = [F.col(a) / side - F.col(name) for a, name in zip(AXES, CUBE)]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.withColumn("_z", z_order(shares)).repartitionByRange(parts, *ORDER)


def _in_order(sites: DataFrame, side: float) -> DataFrame:
    """Places along the curve, dealt to parts by ranges of it, with their ``row`` within the ``part``."""
    number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return _dealt(sites, side).sortWithinPartitions(*ORDER).select(
        *CUBE, *AXES, "place", F.spark_partition_id().alias("part"), number.alias("row")
    )


def _node(size: int) -> Column:
    """Number of the node of so many places that a place is in, within its part and cube."""
    return F.floor(F.col("row") / size)


def _ranks(sites: DataFrame, crowd: int) -> int:
    """How many times places must be packed until a cube's places within a part are one or two nodes."""
    counts = sites.groupBy("part", *CUBE).count()
    most = counts.agg(F.max("count")).first()[0] or 0
    return max(1, math.ceil(math.log(max(most, 1), max(crowd, 2)) - 1e-9))


def _bounded(spots: DataFrame, sites: DataFrame, chord: float) -> DataFrame:
    """Points with ``reach``: the squared chord to a place beside them on the curve, at most that of the radius."""
    marks = spots.withColumn("site", F.lit(None)).unionByName(
        sites.select(*AXES, *CUBE, F.struct(*AXES).alias("site")), allowMissingColumns=True
    )
    dealt = _dealt(marks, chord).withColumn("part", F.spark_partition_id())
    part = Window.partitionBy("part")
    ways = {"before": part.orderBy(*ORDER), "after": part.orderBy(*[F.desc(c) for c in ORDER])}
    so_far = (Window.unboundedPreceding, Window.currentRow)
    beside = dealt.withColumns({name: F.last("site", True).over(way.rowsBetween(*so_far)) for name, way in ways.items()})
    gaps = [F.when(F.col(name).isNotNull(), squared_chord(F.col, F.col(name).getField)) for name in ways]
    return beside.where("site IS NULL").select(
        "lat", "lon", *AXES, *CUBE, F.least(F.lit(chord * chord), *gaps).alias("reach")
    )


def _within_reach() -> Column:
    """Rounding must not lose the box that holds the answer."""
    return F.col("at_least") <= F.col("reach") * (1 + 1e-9) + 1e-18


def _nearest_in_box(a: str) -> Column:
    return F.least(F.greatest(F.col(a), F.col(f"low_{a}")), F.col(f"high_{a}"))


def _farthest_in_box(a: str) -> Column:
    middle = (F.col(f"low_{a}") + F.col(f"high_{a}")) / 2
    return F.when(F.col(a) < middle, F.col(f"high_{a}")).otherwise(F.col(f"low_{a}"))


def _around(spots: DataFrame, side: float) -> DataFrame:
    """Each point with those of the 27 cubes in and around which it lies that are within its reach."""
    for name in CUBE:
        spots = spots.withColumn(name, F.explode(F.array(F.col(name) - 1, F.col(name), F.col(name) + 1)))
    for a, name in zip(AXES, CUBE):
        spots = spots.withColumns({f"low_{a}": F.col(name) * side, f"high_{a}": (F.col(name) + 1) * side})
    apart = spots.withColumn("at_least", squared_chord(F.col, _nearest_in_box))
    return apart.where(_within_reach()).select("lat", "lon", *AXES, *CUBE, "reach")


def _descend(near: DataFrame, sites: DataFrame, above: list[str], size: int, limit: int) -> DataFrame:
    """From cubes, or nodes, to those nodes of ``size`` places in them that may hold the nearest place."""
    within = [F.col(c).alias(f"upper_{c}") for c in above]
    boxes = sites.groupBy(*CUBE, *within, "part", _node(size).alias("node")).agg(
        *[F.min(a).alias(f"low_{a}") for a in AXES],
        *[F.max(a).alias(f"high_{a}") for a in AXES],
    )
    outer = near.withColumnsRenamed({c: f"upper_{c}" for c in above})
    keys = [*CUBE, *[f"upper_{c}" for c in above]]
    pairs = lookup_join(outer, boxes, {c: c for c in keys}, "inner", limit=limit)
    point = Window.partitionBy("lat", "lon")
    bounded = pairs.select(
        "lat",
        "lon",
        *AXES,
        *CUBE,
        "part",
        "node",
        "reach",
        squared_chord(F.col, _nearest_in_box).alias("at_least"),
        squared_chord(F.col, _farthest_in_box).alias("at_most"),
    ).where(_within_reach())
    return (
        bounded.withColumn("reach", F.least("reach", F.min("at_most").over(point)))
        .where(_within_reach())
        .select("lat", "lon", *AXES, *CUBE, "part", "node", "reach")
    )
