"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import ColumnOrName, as_column

# Earth radii in miles (fixed values; two are in use).
EARTH_RADIUS_MILES = 3959.0
EARTH_RADIUS_MILES_ON_DEMAND = 3956.0


def haversine_miles(
    lat1: ColumnOrName,
    lon1: ColumnOrName,
    lat2: ColumnOrName,
    lon2: ColumnOrName,
    radius: float = EARTH_RADIUS_MILES,
) -> Column:
    """Distance in miles between two points in degrees; NULL when a coordinate is NULL.

    The haversine term is clamped to [0, 1]: rounding can push antipodes above 1, where
    ``asin`` gives NaN and NaN compares greater than every distance.
    """
    lat1, lon1, lat2, lon2 = (F.radians(as_column(c).cast("double")) for c in (lat1, lon1, lat2, lon2))
    half_chord_squared = (
        F.pow(F.sin((lat2 - lat1) / 2), F.lit(2.0))
        + F.cos(lat1) * F.cos(lat2) * F.pow(F.sin((lon2 - lon1) / 2), F.lit(2.0))
    )
    # least/greatest skip NULLs, so the clamp is a CASE
    clamped = F.when(half_chord_squared > 1, F.lit(1.0)).otherwise(half_chord_squared)
    return F.lit(2.0 * radius) * F.asin(F.sqrt(clamped))
