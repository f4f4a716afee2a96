"""Distances as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: metres.
EARTH_RADIUS_M = 6_371_000.0


def haversine_radians(rlat1: Column, rlng1: Column, rlat2: Column, rlng2: Column,
                      clat1: Column, clat2: Column) -> Column:
    """Great-circle metres from radians and latitude cosines computed beforehand."""
    sin_lat = F.sin((rlat2 - rlat1) / 2)
    sin_lng = F.sin((rlng2 - rlng1) / 2)
    a = sin_lat * sin_lat + clat1 * clat2 * (sin_lng * sin_lng)
    # rounding can lift the root of antipodal points just above one
    return EARTH_RADIUS_M * (2 * F.asin(F.least(F.lit(1.0), F.sqrt(a))))


def haversine(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance in metres between two points given in degrees."""
    r = [F.radians(c) for c in (lat1, lng1, lat2, lng2)]
    return haversine_radians(r[0], r[1], r[2], r[3], F.cos(r[0]), F.cos(r[2]))


def planar(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Euclidean distance in degrees, as density clustering and k-means use it."""
    dy, dx = lat1 - lat2, lng1 - lng2
    return F.sqrt(dy * dy + dx * dx)


def unit_vector(lat: Column, lng: Column) -> list[Column]:
    """Position on the unit sphere; straight-line distance there orders points
    exactly as the great-circle distance does, also across poles and date line."""
    rlat, rlng = F.radians(lat), F.radians(lng)
    return [F.cos(rlat) * F.cos(rlng), F.cos(rlat) * F.sin(rlng), F.sin(rlat)]


def chord(metres: Column) -> Column:
    """Straight-line length on the unit sphere of a great-circle distance."""
    return 2 * F.sin(metres / (2 * EARTH_RADIUS_M))
