"""Plane geometry in columns: points and inverse Web Mercator."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS = 6_378_137.0


def point(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def from_web_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    """Longitude and latitude in degrees of metres in EPSG:3857."""
    return F.degrees(x / EARTH_RADIUS), F.degrees(F.atan(F.sinh(y / EARTH_RADIUS)))


def to_degrees(rings: Column, srid: Column) -> Column:
    """Rings in EPSG:4326; those of 3857 are projected, all others stay."""
    moved = F.transform(
        rings, lambda ring: F.transform(ring, lambda p: point(*from_web_mercator(p["x"], p["y"])))
    )
    return F.when(srid == 3857, moved).otherwise(rings)
