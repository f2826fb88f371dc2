"""Geometry on columns: great-circle distance, port zones, local projection."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Earth radius, kilometres per degree, zone rectangles
# (lat_max, lat_min, lon_max, lon_min).
EARTH_KM = 6371.0
KM_PER_DEGREE_LON = 111.320
KM_PER_DEGREE_LAT = 110.574
ZONES = (
    (53.8, 53.5, 8.6, 8.14),
    (53.66, 53.0, 11.0, 9.5),
    (54.45, 54.2, 10.3, 10.0),
    (54.71, 54.25, 19.0, 18.35),
)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in kilometres."""
    half_dlat = F.sin((F.radians(lat2) - F.radians(lat1)) / 2)
    half_dlon = F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    a = half_dlat * half_dlat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_dlon * half_dlon
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(a))


def in_zones(lat: Column, lon: Column, zones: Sequence[Sequence[float]] = ZONES) -> Column:
    """True inside any rectangle, bounds included; unknown coordinates are outside."""
    hits = [lat.between(lat_min, lat_max) & lon.between(lon_min, lon_max) for lat_max, lat_min, lon_max, lon_min in zones]
    return F.coalesce(reduce(lambda a, b: a | b, hits, F.lit(False)), F.lit(False))


def zone_label(lat: Column, lon: Column, zones: Sequence[Sequence[float]] = ZONES) -> Column:
    """0 inside a port zone, 1 on open water."""
    return F.when(in_zones(lat, lon, zones), 0).otherwise(1)


def local_x_km(lon: Column, lat0: Column, lon0: Column) -> Column:
    return (lon - lon0) * F.lit(KM_PER_DEGREE_LON) * F.cos(F.radians(lat0))


def local_y_km(lat: Column, lat0: Column) -> Column:
    return (lat - lat0) * F.lit(KM_PER_DEGREE_LAT)


def planar_degrees(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Euclidean distance in degrees."""
    return F.hypot(lat1 - lat2, lon1 - lon2)
