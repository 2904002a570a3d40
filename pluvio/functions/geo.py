"""Geodesy as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6373.0  # fixed value
MERCATOR_M = 6378137.0  # radius of EPSG:3857


def haversine_km(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    dlat = F.radians(lat_b) - F.radians(lat_a)
    dlon = F.radians(lon_b) - F.radians(lon_a)
    h = F.pow(F.sin(dlat / 2), F.lit(2)) + F.cos(F.radians(lat_a)) * F.cos(
        F.radians(lat_b)
    ) * F.pow(F.sin(dlon / 2), F.lit(2))
    return F.lit(2.0) * EARTH_KM * F.atan2(F.sqrt(h), F.sqrt(F.lit(1.0) - h))


def mercator_x(lon: Column) -> Column:
    return F.lit(MERCATOR_M) * F.radians(lon)


def mercator_y(lat: Column) -> Column:
    return F.lit(MERCATOR_M) * F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2))


def lon_of(x: Column) -> Column:
    return F.degrees(x / MERCATOR_M)


def lat_of(y: Column) -> Column:
    return F.degrees(2 * F.atan(F.exp(y / MERCATOR_M)) - math.pi / 2)


def mercator_point(lon: float, lat: float) -> tuple[float, float]:
    """The same projection for a pair of job parameters."""
    return (
        MERCATOR_M * math.radians(lon),
        MERCATOR_M * math.log(math.tan(math.pi / 4 + math.radians(lat) / 2)),
    )
