"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col_or_lit

# Earth radius in miles and the mile->km factor of the formula.
EARTH_RADIUS_MI = 3961
KM_PER_MILE = 1.60934


def haversine_distance(lat1, lon1, lat2, lon2, unit: str = "mi") -> Column:
    """Haversine distance in miles (``unit='mi'``) or kilometres (``'km'``)."""
    if unit == "mi":
        rate = 1.0
    elif unit == "km":
        rate = KM_PER_MILE
    else:
        raise ValueError(f"haversine_distance: unknown unit {unit!r}, use mi or km")
    la1, lo1, la2, lo2 = (as_col_or_lit(c).cast("double") for c in (lat1, lon1, lat2, lon2))
    a = (F.pow(F.sin(F.radians((la2 - la1) / 2)), 2)
         + F.cos(F.radians(la1)) * F.cos(F.radians(la2))
         * F.pow(F.sin(F.radians((lo2 - lo1) / 2)), 2))
    dist = F.lit(2 * EARTH_RADIUS_MI) * F.asin(F.sqrt(a))
    return dist * F.lit(rate) if unit == "km" else dist
