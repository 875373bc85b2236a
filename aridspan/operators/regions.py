"""Regions: which cell lies in which polygon, means by region, ranks, and tables ready for a map."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Degrees of the rows by which edges meet latitudes, and of the columns by which stretches of a latitude meet its cells.
ROW, COLUMN = 0.5, 2.0
#: Latitudes are broadcast while their counted number is under this (8 bytes each).
MAX_BROADCAST_LATITUDES = 100_000


def edges(regions: DataFrame) -> DataFrame:
    """region_id, x1, y1, x2, y2: a row for each edge of regions (region_id, rings); a ring's last point meets its first."""
    points = regions.select("region_id", F.explode("rings").alias("ring")).withColumn("n", F.size("ring"))
    ends = F.transform("ring", lambda p, i: F.struct(p.alias("a"), F.get("ring", F.when(i + 1 < F.col("n"), i + 1).otherwise(0)).alias("b")))
    pairs = points.select("region_id", F.explode(ends).alias("e"))
    return pairs.select("region_id", F.col("e.a.x").alias("x1"), F.col("e.a.y").alias("y1"), F.col("e.b.x").alias("x2"), F.col("e.b.y").alias("y2"))


def crossings(edges: DataFrame, lats: DataFrame) -> DataFrame:
    """region_id, lat, x: where edges meet the latitudes of lats (lat, each once); an edge owns its lower end alone. Edges meet
    latitudes by the rows that they touch, an equi-join, so an edge costs as much as it is high."""
    row = lambda c: F.floor(c / ROW).cast("int")
    few = lats.withColumn("_row", row(F.col("lat")))
    if lats.limit(MAX_BROADCAST_LATITUDES + 1).count() <= MAX_BROADCAST_LATITUDES:
        few = F.broadcast(few)
    sloped = edges.filter("y1 <> y2").withColumn("_row", F.explode(F.sequence(row(F.least("y1", "y2")), row(F.greatest("y1", "y2")))))
    y, y1, y2, x1, x2 = (F.col(c) for c in ("lat", "y1", "y2", "x1", "x2"))
    met = sloped.join(few, "_row").filter((y2 > y) != (y1 > y))
    return met.select("region_id", "lat", ((x2 - x1) * (y - y1) / (y2 - y1) + x1).alias("x"))


def stretches(crossed: DataFrame) -> DataFrame:
    """region_id, lat, low, high: the half-open stretches of each latitude inside a region, by the even-odd rule over all of
    its rings: from its first crossing to the second, from the third to the fourth, and so on."""
    along = Window.partitionBy("region_id", "lat").orderBy("x")
    placed = crossed.withColumns({"at": F.row_number().over(along), "high": F.lead("x").over(along)})
    return placed.filter("at % 2 = 1 AND high > x").select("region_id", "lat", F.col("x").alias("low"), "high")


def cell_region(cells: DataFrame, regions: DataFrame) -> DataFrame:
    """lat, lon, region_id of each cell (distinct lat, lon) inside a polygon of regions (region_id, rings). An edge
    belongs to the polygon above or right of it; where polygons overlap the smallest region_id counts. No polygon moves
    as a whole: it is a row for each edge, then for each crossing of a latitude, then for each stretch and column."""
    cells = cells.select("lat", "lon").distinct()
    column = lambda c: F.floor(c / COLUMN).cast("int")
    inner = stretches(crossings(edges(regions), cells.select("lat").distinct()))
    inner = inner.withColumn("_column", F.explode(F.sequence(column(F.col("low")), column(F.col("high")))))
    hit = cells.withColumn("_column", column(F.col("lon"))).join(inner, ["lat", "_column"]).filter("lon >= low AND lon < high")
    return hit.groupBy("lat", "lon").agg(F.min("region_id").alias("region_id"))


def region_mean(index_file: DataFrame, mask: DataFrame, weight: str = "none") -> DataFrame:
    """experiment, region_id, value: each file's mean over a region's cells, then the mean over files. weight: ``none``
    or ``coslat``, by the area of a cell. Cells outside all regions drop out."""
    rows = index_file.join(mask, ["lat", "lon"])
    if weight == "coslat":
        w = F.when(F.col("value").isNotNull(), F.cos(F.radians("lat")))
        mean = F.sum(F.col("value") * w) / F.nullif(F.sum(w), F.lit(0.0))
    elif weight == "none":
        mean = F.avg("value")
    else:
        raise ValueError(f"unknown weight {weight!r}")
    files = rows.groupBy("experiment", "file_id", "region_id").agg(mean.alias("value"))
    return files.groupBy("experiment", "region_id").agg(F.avg("value").alias("value"))


def with_names(means: DataFrame, regions: DataFrame) -> DataFrame:
    """regions (region_id, name) with their means, by key: a region without a cell has a null value."""
    return regions.select("region_id", "name").join(means, "region_id", "left")


def rank_regions(named: DataFrame, value: str = "value", within: list[str] | None = None) -> DataFrame:
    """Adds rank: the largest value first, nulls last, ties by name."""
    window = Window.partitionBy(*(within or [])) if within else Window.partitionBy(F.lit(0))
    return named.withColumn("rank", F.row_number().over(window.orderBy(F.desc_nulls_last(value), "name")).cast("long"))


def top_regions(named: DataFrame, k: int, value: str = "value") -> DataFrame:
    return named.orderBy(F.desc_nulls_last(value), "name").limit(k)


def merge_regions(regions: DataFrame, stats: DataFrame, on: str = "name") -> DataFrame:
    """Polygons with their statistics; a name that repeats meets each of its rows."""
    return regions.join(stats, on)


def legend_ticks(values: DataFrame, value: str = "value", step: int = 10) -> DataFrame:
    """tick: 0, step, ... up to the first beyond the largest value."""
    top = values.agg(F.max(value).alias("top"))
    last = F.ceil(F.col("top") + step).cast("int") - 1
    return top.filter("top IS NOT NULL").select(F.explode(F.sequence(F.lit(0), last, F.lit(step))).alias("tick"))


def town_labels(towns: DataFrame, offset: float = 0.1) -> DataFrame:
    """city, point and the place of its label."""
    return towns.select("city", F.struct(F.col("lng").alias("x"), F.col("lat").alias("y")).alias("point"), (F.col("lng") + offset).alias("label_x"), (F.col("lat") + offset).alias("label_y"))
