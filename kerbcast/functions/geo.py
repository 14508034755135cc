"""Geometry on columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from kerbcast import settings as S

EARTH_RADIUS_KM = 6371.0


def in_service_area(lat: Column, lng: Column) -> Column:
    """Inside the service bounding box, borders included."""
    return lat.between(S.LAT_MIN, S.LAT_MAX) & lng.between(S.LNG_MIN, S.LNG_MAX)


def great_circle_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Haversine distance."""
    half_dlat = F.radians(lat2 - lat1) / 2
    half_dlng = F.radians(lng2 - lng1) / 2
    chord = F.sin(half_dlat) * F.sin(half_dlat) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.sin(half_dlng) * F.sin(half_dlng)
    return 2 * EARTH_RADIUS_KM * F.asin(F.least(F.lit(1.0), F.sqrt(chord)))


def squared_distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return (x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2)


def nearest_centre(lat: Column, lng: Column, centres: Sequence[tuple[float, float]]) -> Column:
    """``struct(d2, zone)`` of the closest centre, the lowest zone on ties; NULL without
    a point.

    The centres are a model's few coordinates, so they are literals of one expression: no
    join and no shuffle, whatever the number of points.  Searching an array keeps the
    expression the same size for any number of centres; one term per centre outgrows the
    generated method and then runs many times slower.
    """
    lats = F.array(*[F.lit(c_lat) for c_lat, _ in centres])
    lngs = F.array(*[F.lit(c_lng) for _, c_lng in centres])
    distances = F.zip_with(lats, lngs, lambda y, x: squared_distance(lat, lng, y, x))
    closest = F.array_min(distances)
    zone = (F.array_position(distances, closest) - 1).cast("int")
    return F.struct(closest.alias("d2"), zone.alias("zone"))
