"""Great-circle distances as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The earth radius in both units.
EARTH_KM = 6371
EARTH_M = 6371000


def _angle(value: Column | str, units: str) -> Column:
    col = F.col(value) if isinstance(value, str) else value
    return F.radians(col) if units == "degrees" else col


def _known(value: Column, *inputs) -> Column:
    """Null unless all inputs are there; least and greatest alone would skip a null."""
    there = F.lit(True)
    for i in inputs:
        there = there & (F.col(i) if isinstance(i, str) else i).isNotNull()
    return F.when(there, value)


def unit_vector(lat, lon, units: str = "degrees") -> tuple[Column, Column, Column]:
    """The point on the unit sphere; products of two such vectors order points by distance."""
    a, o = _angle(lat, units), _angle(lon, units)
    return F.cos(a) * F.cos(o), F.cos(a) * F.sin(o), F.sin(a)


def haversine(lat1, lon1, lat2, lon2, radius=EARTH_KM, units: str = "degrees") -> Column:
    """Great-circle distance; ``units='radians'`` feeds the coordinates to sin/cos unconverted."""
    a1, o1, a2, o2 = (_angle(v, units) for v in (lat1, lon1, lat2, lon2))
    d_lat, d_lon = F.sin((a2 - a1) / 2), F.sin((o2 - o1) / 2)
    h = d_lat * d_lat + F.cos(a2) * F.cos(a1) * d_lon * d_lon
    arc = F.asin(F.sqrt(F.least(F.lit(1.0), F.greatest(F.lit(0.0), h))))
    return _known(F.lit(2 * radius) * arc, lat1, lon1, lat2, lon2)


def cosine_distance(lat1, lon1, lat2, lon2, radius=EARTH_KM, units: str = "degrees") -> Column:
    """The same distance by the spherical law of cosines."""
    a1, o1, a2, o2 = (_angle(v, units) for v in (lat1, lon1, lat2, lon2))
    c = F.sin(a1) * F.sin(a2) + F.cos(a1) * F.cos(a2) * F.cos(o1 - o2)
    arc = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), c)))
    return _known(F.lit(radius) * arc, lat1, lon1, lat2, lon2)
