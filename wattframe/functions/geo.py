"""Great-circle distance as a native Column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattframe.constants import EARTH_RADIUS_KM


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine distance in km between two points given in degrees.

    ``a`` is clamped to [0, 1] so rounding can never produce NaN in sqrt(1 - a).
    """
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dlat = p2 - p1
    dlon = F.radians(lon2) - F.radians(lon1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlon / 2), 2)
    a = F.least(F.greatest(a, F.lit(0.0)), F.lit(1.0))
    return F.lit(EARTH_RADIUS_KM) * (F.lit(2.0) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a)))


def is_valid_coordinate(lat: Column, lon: Column) -> Column:
    """True only for non-NULL, non-NaN coordinates."""
    return lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)
