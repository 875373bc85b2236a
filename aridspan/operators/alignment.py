"""Grids that meet by labels: cells of files whose axes differ by noise, or whose boxes are shifted, are the same cells.

An axis is an origin and a step; a coordinate within a tolerance of a label takes the label's value, so that all joins and
groups by lat and lon meet it. Files then align as an outer join does: a cell that some files lack has the others.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: How far a coordinate may lie from a label, in steps; and decimal places within which axes differ by noise alone.
TOLERANCE, PLACES = 0.05, 4


@dataclass(frozen=True)
class Axis:
    origin: float
    step: float

    def number(self, x: Column) -> Column:
        """Which label is nearest, 0 at the origin."""
        return F.bround((x - self.origin) / self.step).cast("long")

    def label(self, x: Column, tolerance: float = TOLERANCE) -> Column:
        """The nearest label; a coordinate that is farther from it stays as it is."""
        label = F.round(self.number(x) * F.lit(self.step) + self.origin, 9)
        return F.when(F.abs(x - label) <= tolerance * self.step, label).otherwise(x)


def axis_of(rows: DataFrame, column: str) -> Axis:
    """The axis of a column: its smallest value, to PLACES, and the most common gap between neighbours. One row for
    each distinct value reaches the window: as many as a grid is high or wide."""
    values = rows.select(F.round(column, PLACES).alias("x")).filter("x IS NOT NULL").distinct()
    gaps = values.select("x", (F.lead("x").over(Window.orderBy("x")) - F.col("x")).alias("gap"))
    common = gaps.groupBy(F.round("gap", PLACES).alias("gap")).agg(F.count("*").alias("n"), F.min("x").alias("x"))
    found = common.agg(F.min("x").alias("origin"), F.max_by("gap", F.when(F.col("gap").isNotNull(), F.struct("n", -F.col("gap")))).alias("step")).first()
    if found.origin is None:
        raise ValueError(f"there is no value of {column}")
    return Axis(found.origin, found.step or 1.0)


def axes_of_files(files: DataFrame) -> tuple[Axis, Axis] | None:
    """The axes of lat and lon of a catalogue's files (sources.file_catalogue), from their headers; None without files."""
    out = []
    for low, high, n in (("south", "north", "n_lat"), ("west", "east", "n_lon")):
        step = F.round((F.col(high) - F.col(low)) / F.nullif(F.col(n) - 1, F.lit(0)), PLACES)
        found = files.filter(F.col(low).isNotNull()).agg(F.min(F.round(low, PLACES)).alias("origin"), F.mode(step, True).alias("step")).first()
        if found.origin is None:
            return None
        out.append(Axis(found.origin, found.step or 1.0))
    return out[0], out[1]


def on_labels(rows: DataFrame, lat: Axis, lon: Axis, tolerance: float = TOLERANCE) -> DataFrame:
    """rows with lat and lon on the labels of the axes."""
    return rows.withColumns({"lat": lat.label(F.col("lat"), tolerance), "lon": lon.label(F.col("lon"), tolerance)})


def off_labels(rows: DataFrame, lat: Axis, lon: Axis, tolerance: float = TOLERANCE) -> DataFrame:
    """The rows with a coordinate that no label is near to: they meet no cell of other grids."""
    far = lambda axis, c: F.abs(F.col(c) - axis.number(F.col(c)) * F.lit(axis.step) - axis.origin) > tolerance * axis.step
    return rows.filter(far(lat, "lat") | far(lon, "lon"))
