"""Geometry on the unit sphere.

Places are compared by their chord, the straight line through the sphere. It
grows with the surface distance, has no seam at the date line or the poles, and
lets plain boxes in x, y and z bound it.
"""

from __future__ import annotations

from math import asin, sin

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0088
AXES = ("x", "y", "z")


def unit_vector(latitude: Column, longitude: Column) -> dict[str, Column]:
    lat, lon = F.radians(latitude), F.radians(longitude)
    return {"x": F.cos(lat) * F.cos(lon), "y": F.cos(lat) * F.sin(lon), "z": F.sin(lat)}


def chord_of_km(km: float) -> float:
    return 2 * sin(min(km / (2 * EARTH_RADIUS_KM), asin(1)))


def km_of_chord(squared: Column) -> Column:
    return F.asin(F.least(F.sqrt(squared) / 2, F.lit(1.0))) * (2 * EARTH_RADIUS_KM)


def squared_chord(axis_of_a, axis_of_b) -> Column:
    """Squared chord of two points, each given as a function from axis to column."""
    return sum((F.pow(axis_of_a(a) - axis_of_b(a), F.lit(2)) for a in AXES), F.lit(0.0))


# Shifts and masks that leave two free bits behind every bit of a number of 21 bits.
SPREADING = (
    (32, 0x1F00000000FFFF),
    (16, 0x1F0000FF0000FF),
    (8, 0x100F00F00F00F00F),
    (4, 0x10C30C30C30C30C3),
    (2, 0x1249249249249249),
)
Z_BITS = 21


def z_order(shares: list[Column]) -> Column:
    """Place of a point on the curve through its cube, from how far along each of three axes it lies, 0 to 1."""
    code = F.lit(0).cast("long")
    for axis, share in enumerate(shares):
        number = F.floor(share * (1 << Z_BITS)).cast("long")
        number = F.greatest(F.least(number, F.lit((1 << Z_BITS) - 1)), F.lit(0)).cast("long")
        for shift, mask in SPREADING:
            number = number.bitwiseOR(F.shiftleft(number, shift)).bitwiseAND(F.lit(mask).cast("long"))
        code = code.bitwiseOR(F.shiftleft(number, axis))
    return code
