"""Coordinate features: rounding to a grid and great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in km used for haversine distance.
EARTH_RADIUS_KM = 6371.0


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_coordinate(x: Column | str, step: float = 0.01) -> Column:
    """Floor a coordinate to a grid of ``step`` degrees (negatives go down)."""
    return F.floor(_c(x) / F.lit(step)) * F.lit(step)


def haversine_km(lat1: Column | str, lon1: Column | str,
                 lat2: Column | str, lon2: Column | str) -> Column:
    """Great-circle distance in km; argument of asin is clamped to [0, 1]."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dlat = p2 - p1
    dlon = F.radians(_c(lon2)) - F.radians(_c(lon1))
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))
