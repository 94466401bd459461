"""Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_000.0


def column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def haversine(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in metres between two points in degrees."""
    p1, p2 = F.radians(column(lat1)), F.radians(column(lat2))
    dp, dl = p2 - p1, F.radians(column(lon2)) - F.radians(column(lon1))
    h = F.pow(F.sin(dp / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def within_box(lat, lon, lat0: float, lon0: float, radius_m: float) -> Column:
    """Cheap bounding box that holds the whole circle; plain comparisons that reach the file scan.

    A circle that reaches a pole takes all longitudes; across the 180th meridian the box has two parts.
    Longitudes run from -180 to 180.
    """
    slack = 1e-9
    dlat = math.degrees(radius_m / EARTH_RADIUS_M) + slack
    low, high = lat0 - dlat, lat0 + dlat
    box = column(lat).between(low, high)
    if low <= -90 or high >= 90:
        return box
    # The circle touches its extreme meridians at asin(sin(radius) / cos(latitude)).
    dlon = math.degrees(math.asin(min(1.0, math.sin(radius_m / EARTH_RADIUS_M) / math.cos(math.radians(lat0))))) + slack
    west, east = lon0 - dlon, lon0 + dlon
    if east - west >= 360:
        return box
    around = column(lon).between(west, east)
    if west < -180:
        around = around | (column(lon) >= west + 360)
    if east > 180:
        around = around | (column(lon) <= east - 360)
    return box & around


def weekday_name(ts) -> Column:
    return F.date_format(column(ts), "EEEE")


def flag(condition: Column) -> Column:
    """Predicate as 0.0 / 1.0; NULL stays NULL."""
    return condition.cast("int").cast("double")


def ratio(numerator, denominator) -> Column:
    """Quotient that is NULL where the denominator is 0."""
    return F.try_divide(column(numerator), column(denominator))
