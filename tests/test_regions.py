from __future__ import annotations

import math
import random

from pyspark.sql import functions as F

from aridspan.functions.geometry import from_web_mercator, to_degrees
from aridspan.operators import regions as reg
from aridspan.schemas import REGIONS

SQUARE = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]
HOLE = [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 2.0)]
CONCAVE = [(10.0, 0.0), (14.0, 0.0), (14.0, 4.0), (12.0, 1.0), (10.0, 4.0)]


def made(spark, *rings):
    return spark.createDataFrame([(i, f"r{i}", 4326, [list(r) for r in rs]) for i, rs in enumerate(rings)], REGIONS)


def where(spark, regions, points):
    cells = spark.createDataFrame([(y, x) for x, y in points], "lat double, lon double")
    return {(r.lon, r.lat): r.region_id for r in reg.cell_region(cells, regions).collect()}


def test_points_in_polygons(spark):
    regions = made(spark, [SQUARE, HOLE], [CONCAVE])
    got = where(spark, regions, [(0.5, 0.5), (1.5, 1.5), (3.0, 3.0), (5.0, 5.0), (12.0, 0.5), (12.0, 3.0), (13.5, 3.0), (-9.0, 0.5)])
    assert got == {(0.5, 0.5): 0, (3.0, 3.0): 0, (12.0, 0.5): 1, (13.5, 3.0): 1}


def test_shared_edges_belong_to_one_polygon_and_overlaps_to_the_first(spark):
    right = [(4.0, 0.0), (8.0, 0.0), (8.0, 4.0), (4.0, 4.0)]
    got = where(spark, made(spark, [SQUARE], [right]), [(4.0, 2.0), (0.0, 2.0), (8.0, 2.0), (2.0, 0.0), (2.0, 4.0)])
    assert got == {(4.0, 2.0): 1, (0.0, 2.0): 0, (2.0, 0.0): 0}
    assert where(spark, made(spark, [right], [right]), [(5.0, 1.0)]) == {(5.0, 1.0): 0}


def cast(x, y, rings):
    """Even-odd rule by one ray to the east."""
    n = 0
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, [*ring[1:], *ring[:1]]):
            n += (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax
    return n % 2 == 1


def star(rng, n, x, y, r):
    turns = sorted(rng.random() * 2 * math.pi for _ in range(n))
    return [(x + r * rng.uniform(0.2, 1) * math.cos(t), y + r * rng.uniform(0.2, 1) * math.sin(t)) for t in turns]


def test_masks_of_any_polygons(spark, monkeypatch):
    rng = random.Random(6)
    shapes = [[star(rng, rng.randint(3, 40), rng.uniform(-20, 20), rng.uniform(-9, 9), rng.uniform(0.3, 12)) for _ in range(rng.randint(1, 3))] for _ in range(8)]
    shapes += [[SQUARE, HOLE], [CONCAVE], [[(0.0, 0.0), (0.0, 0.0)]], [[(3.0, 3.0)]], [[]], []]
    points = [(x / 2, y / 2) for x in range(-50, 50) for y in range(-24, 24)]
    want = {}
    for p in points:
        inside = [i for i, rings in enumerate(shapes) if cast(*p, rings)]
        if inside:
            want[p] = inside[0]
    assert where(spark, made(spark, *shapes), points) == want
    monkeypatch.setattr(reg, "MAX_BROADCAST_LATITUDES", 0)
    assert where(spark, made(spark, *shapes), points) == want


def test_a_polygon_of_many_vertices_is_a_row_for_each_edge(spark):
    n = 200_000
    turn = F.col("id") * (2 * math.pi / n)
    ring = spark.range(n).select(F.struct((F.cos(turn) * 10 * (1 + F.sin(turn * 500) / 50)).alias("x"), (F.sin(turn) * 10).alias("y")).alias("p"), "id")
    rings = ring.agg(F.transform(F.sort_array(F.collect_list(F.struct("id", "p"))), lambda s: s["p"]).alias("ring"))
    shape = rings.select(F.lit(7).alias("region_id"), F.array("ring").alias("rings")).cache()
    lats = spark.range(-40, 41).select((F.col("id") / 4).alias("lat"))
    assert reg.edges(shape).count() == n
    assert reg.crossings(reg.edges(shape), lats).count() < 50 * 81  # not a row for each edge and latitude
    cells = lats.crossJoin(spark.range(-48, 49).select((F.col("id") / 4).alias("lon")))
    got = reg.cell_region(cells, shape)
    near = {(r.lat, r.lon) for r in got.collect()}
    assert all(((y, x) in near) == (x * x + y * y < 100) for y in (0.0, 2.5, -7.25) for x in (0.0, 3.0, -11.5, 11.5) if abs(x * x + y * y - 100) > 12)


def test_means_ranks_and_merges(spark):
    regions = made(spark, [SQUARE], [CONCAVE], [[(50.0, 50.0), (51.0, 50.0), (51.0, 51.0)]])
    mask = reg.cell_region(spark.createDataFrame([(0.5, 0.5), (3.0, 3.5), (0.5, 12.0)], "lat double, lon double"), regions)
    rows = [("e", "a", 0.5, 0.5, 2.0), ("e", "a", 3.0, 3.5, 4.0), ("e", "b", 0.5, 0.5, 10.0), ("e", "b", 3.0, 3.5, None), ("e", "a", 0.5, 12.0, 1.0)]
    frame = spark.createDataFrame(rows, "experiment string, file_id string, lat double, lon double, value double")
    means = reg.region_mean(frame, mask)
    assert {r.region_id: r.value for r in means.collect()} == {0: 6.5, 1: 1.0}
    weighed = {r.region_id: r.value for r in reg.region_mean(frame, mask, "coslat").collect()}
    a, b = math.cos(math.radians(0.5)), math.cos(math.radians(3.0))
    assert math.isclose(weighed[0], ((2 * a + 4 * b) / (a + b) + 10.0) / 2)
    named = reg.with_names(means, regions)
    assert [(r.name, r.value, r["rank"]) for r in reg.rank_regions(named).orderBy("rank").collect()] == [("r0", 6.5, 1), ("r1", 1.0, 2), ("r2", None, 3)]
    assert [r.name for r in reg.top_regions(named, 2).collect()] == ["r0", "r1"]
    twice = regions.unionByName(regions)
    assert reg.merge_regions(twice, named.select("name", "value")).count() == 6
    assert [r.tick for r in reg.legend_ticks(named).collect()] == [0, 10]


def test_labels_and_projection(spark):
    towns = spark.createDataFrame([("X", -30.0, 20.0)], "city string, lat double, lng double")
    row = reg.town_labels(towns).first()
    assert (row.point.x, round(row.label_x, 6), round(row.label_y, 6)) == (20.0, 20.1, -29.9)
    lon, lat = spark.range(1).select(*from_web_mercator(F.lit(2_226_389.8), F.lit(-3_503_549.8))).first()
    assert abs(lon - 20.0) < 1e-5 and abs(lat + 30.0) < 1e-5
    rings = made(spark, [SQUARE]).select(to_degrees(F.col("rings"), F.col("srid")).alias("r")).first().r
    assert rings[0][1].x == 4.0
