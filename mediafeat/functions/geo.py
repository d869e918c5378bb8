"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: mean Earth radius in metres (IUGG)
EARTH_RADIUS_M = 6371008.8


def haversine_m(lat1, lng1, lat2, lng2) -> Column:
    """Haversine distance in metres between two points given in degrees."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dp = F.radians(lat2) - F.radians(lat1)
    dl = F.radians(lng2) - F.radians(lng1)
    a = F.pow(F.sin(dp / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def haversine_sql(lat1: str, lng1: str, lat2: str, lng2: str) -> str:
    """The same formula as SQL text (used by the DuckDB oracle)."""
    return (f"({2 * EARTH_RADIUS_M!r} * asin(sqrt(least(1.0, "
            f"pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + "
            f"cos(radians({lat1})) * cos(radians({lat2})) * "
            f"pow(sin((radians({lng2}) - radians({lng1})) / 2), 2)))))")
