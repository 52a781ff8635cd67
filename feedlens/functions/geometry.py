"""Rings as arrays of ``struct<x,y>``; the last point joins the first.

A shape is an array of rings: the outlines of its parts and of its holes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _edges(ring: Column, start: Column, step: Callable[[Column, Column, Column], Column]) -> Column:
    """Fold ``step(acc, point, next_point)`` over the closed ring."""
    n = F.size(ring)

    def visit(acc: Column, i: Column) -> Column:
        return step(acc, F.get(ring, i), F.get(ring, F.pmod(i + 1, n)))

    return F.aggregate(F.sequence(F.lit(0), n - 1), start, visit)


def in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Ray casting with half-open edges: each edge owns its lower end."""

    def cross(odd: Column, p: Column, q: Column) -> Column:
        straddles = (p["y"] > y) != (q["y"] > y)
        # a flat edge never straddles, so the division is only reached when it is safe
        at = (q["x"] - p["x"]) * (y - p["y"]) / F.nullif(q["y"] - p["y"], F.lit(0.0)) + p["x"]
        return F.when(straddles & (x < at), ~odd).otherwise(odd)

    return _edges(ring, F.lit(False), cross)


def in_rings(x: Column, y: Column, rings: Column) -> Column:
    """Inside an odd number of rings: in a part and in none of its holes."""
    return F.aggregate(rings, F.lit(False), lambda odd, ring: odd != in_ring(x, y, ring))


def bounding_box(ring: Column) -> Column:
    xs = F.transform(ring, lambda p: p["x"])
    ys = F.transform(ring, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("x0"),
        F.array_min(ys).alias("y0"),
        F.array_max(xs).alias("x1"),
        F.array_max(ys).alias("y1"),
    )


def in_box(x: Column, y: Column, box: Column) -> Column:
    return (x >= box["x0"]) & (x <= box["x1"]) & (y >= box["y0"]) & (y <= box["y1"])


def _shoelace(ring: Column) -> Column:
    """Twice the signed area, and the sums of x and y that it weighs."""
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("cx"), F.lit(0.0).alias("cy"))

    def add(acc: Column, p: Column, q: Column) -> Column:
        w = p["x"] * q["y"] - q["x"] * p["y"]
        return F.struct(
            (acc["a"] + w).alias("a"),
            (acc["cx"] + (p["x"] + q["x"]) * w).alias("cx"),
            (acc["cy"] + (p["y"] + q["y"]) * w).alias("cy"),
        )

    return _edges(ring, zero, add)


def oriented(ring: Column, hole: Column) -> Column:
    """The ring counter-clockwise, or clockwise for a hole, so that areas of a shape add up."""
    clockwise = _shoelace(ring)["a"] < 0
    return F.when(clockwise != hole, F.reverse(ring)).otherwise(ring)


def centroid(ring: Column) -> Column:
    """Area centroid by the shoelace sums; the mean of the points when the area is 0."""
    return rings_centroid(F.array(ring))


def rings_centroid(rings: Column) -> Column:
    """Area centroid of a shape of oriented rings; the mean of the points when the area is 0."""
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("cx"), F.lit(0.0).alias("cy"))
    sums = F.aggregate(
        F.transform(rings, _shoelace), zero,
        lambda acc, s: F.struct((acc["a"] + s["a"]).alias("a"), (acc["cx"] + s["cx"]).alias("cx"),
                                (acc["cy"] + s["cy"]).alias("cy")),
    )
    points = F.flatten(rings)
    n = F.size(points).cast("double")
    mean_x = F.aggregate(points, F.lit(0.0), lambda a, p: a + p["x"]) / F.nullif(n, F.lit(0.0))
    mean_y = F.aggregate(points, F.lit(0.0), lambda a, p: a + p["y"]) / F.nullif(n, F.lit(0.0))
    area3 = F.nullif(F.lit(3.0) * sums["a"], F.lit(0.0))
    return F.struct(
        F.coalesce(sums["cx"] / area3, mean_x).alias("x"),
        F.coalesce(sums["cy"] / area3, mean_y).alias("y"),
    )
