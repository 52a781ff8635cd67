"""Cells of regions: the same answers as ray casting everything, with few points cast."""

import math
import random

import pytest

from feedlens.operators import geo
from feedlens.operators.cells import with_level
from pyspark.sql import functions as F

RINGS = "loc_id int, name string, rings array<array<struct<x:double,y:double>>>"


def star(rng, x, y, size, n):
    turns = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
    return [(x + size * rng.uniform(0.6, 1) * math.cos(t), y + size * rng.uniform(0.6, 1) * math.sin(t)) for t in turns]


def round_ring(x, y, size, n=90):
    return [(x + size * math.cos(2 * math.pi * i / n), y + size * math.sin(2 * math.pi * i / n)) for i in range(n)]


@pytest.fixture(scope="module")
def shapes():
    rng = random.Random(5)
    rows = [
        (1, "holed", [round_ring(10, 10, 8), round_ring(11, 10, 2)]),
        (2, "two parts", [round_ring(-30, -20, 5), round_ring(-18, -20, 3)]),
        (3, "square", [[(0.0, 0.0), (16.0, 0.0), (16.0, 16.0), (0.0, 16.0)]]),
        (4, "needle", [[(-5.0, -5.0), (25.0, 24.9), (25.0, 25.0)]]),
        (5, "tiny", [[(3.0, 3.0), (3.00001, 3.0), (3.0, 3.00001)]]),
        (6, "flat", [[(1.0, 1.0), (2.0, 1.0), (1.0, 1.0)]]),
        (7, "none", []),
    ]
    return rows + [(10 + i, f"star {i}", [star(rng, rng.uniform(-20, 20), rng.uniform(-20, 20), 6, 40)]) for i in range(6)]


def inside(x, y, rings):
    odd = False
    for ring in rings:
        for (px, py), (qx, qy) in zip(ring, ring[1:] + ring[:1]):
            if (py > y) != (qy > y) and x < (qx - px) * (y - py) / (qy - py) + px:
                odd = not odd
    return odd


def test_grid_equals_brute_force(make, spark, shapes):
    rng = random.Random(7)
    points = [(rng.uniform(-40, 30), rng.uniform(-30, 30)) for _ in range(3000)]
    points += [p for _, _, rings in shapes for ring in rings for p in ring]  # corners
    points += [(float(x), float(y)) for x in range(-2, 19) for y in range(-2, 19)]  # borders of cells
    regions = spark.createDataFrame(shapes, RINGS)
    rows = make(*[{"lon": x, "lat": y} for x, y in points])
    got = sorted((int(r.id_), r.loc_id) for r in geo.match_regions(rows, regions, ["id_"], force_grid=True).collect())
    assert got == [(i, n) for i, (x, y) in enumerate(points) for n, _, rings in shapes if inside(x, y, rings)]


def test_few_points_are_cast(spark, shapes):
    regions = spark.createDataFrame([s for s in shapes if s[1] in ("holed", "two parts", "square")], RINGS)
    found = geo._shapes(regions, ["name"])
    points = spark.range(0, 40000).select(
        "id", (F.rand(1) * 70 - 40).alias("lon"), (F.rand(2) * 60 - 30).alias("lat"))
    boxes = points.join(found, geo.in_box(F.col("lon"), F.col("lat"), F.col("box"))).count()
    located = with_level(found.withColumn("_shape", F.xxhash64("loc_id", "rings")))
    cast = geo.region_candidates(points, located, ["id"]).where("not _sure").count()
    assert 0 < cast < boxes / 10


def test_no_regions(make, spark):
    empty = spark.createDataFrame([], RINGS)
    assert geo.match_regions(make({"lon": 1.0, "lat": 1.0}), empty, force_grid=True).count() == 0
