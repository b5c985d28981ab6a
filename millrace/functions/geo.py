"""Distances on the globe."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Radius in miles and the factor to kilometres.
EARTH_RADIUS_MILES = 3961
KM_PER_MILE = 1.60934


def haversine_distance(
    lat1: str | Column, lon1: str | Column, lat2: str | Column, lon2: str | Column, unit: str = "mi"
) -> Column:
    """Great-circle distance between two points given in degrees, in ``mi`` or ``km``."""
    if unit not in ("mi", "km"):
        raise ValueError(f"unit must be 'mi' or 'km', not {unit!r}")
    phi1, lambda1, phi2, lambda2 = (
        F.radians(F.col(c) if isinstance(c, str) else c) for c in (lat1, lon1, lat2, lon2)
    )
    half_chord = (
        F.pow(F.sin((phi2 - phi1) / 2), 2)
        + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin((lambda2 - lambda1) / 2), 2)
    )
    miles = 2 * EARTH_RADIUS_MILES * F.asin(F.sqrt(half_chord))
    return miles * KM_PER_MILE if unit == "km" else miles
