"""Plane geometry as column expressions; points are x and y, lines and rings arrays of struct<x, y>."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.sqrt((x1 - x2) ** 2 + (y1 - y2) ** 2)


def axial_bearing(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Direction of a line without a sense: degrees from north, in [0, 180)."""
    return F.pmod(F.degrees(F.atan2(x2 - x1, y2 - y1)), F.lit(180.0))


def axis_difference(a: Column, b: Column) -> Column:
    """Angle between two axes, 0 to 90."""
    d = F.pmod(a - b, F.lit(180.0))
    return F.least(d, 180 - d)


def heading(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.pmod(F.degrees(F.atan2(x2 - x1, y2 - y1)), F.lit(360.0))


def turn(h1: Column, h2: Column) -> Column:
    """Degrees turned between two headings, 0 to 180."""
    d = F.pmod(h2 - h1, F.lit(360.0))
    return F.least(d, 360 - d)


def side(ax: Column, ay: Column, bx: Column, by: Column, px: Column, py: Column) -> Column:
    """1 if the point lies left of the line from a to b, -1 right of it, 0 on it."""
    return F.signum((bx - ax) * (py - ay) - (by - ay) * (px - ax))


def to_segment(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Distance from a point to a straight segment."""
    dx, dy = bx - ax, by - ay
    n = dx * dx + dy * dy
    t = F.when(n > 0, F.greatest(F.least(((px - ax) * dx + (py - ay) * dy) / n, F.lit(1.0)), F.lit(0.0))).otherwise(0.0)
    return distance(px, py, ax + t * dx, ay + t * dy)


def _pairs(line: Column) -> Column:
    """Numbers of the segments of a line."""
    return F.when(F.size(line) > 1, F.sequence(F.lit(0), F.size(line) - 2)).otherwise(F.array().cast("array<int>"))


def line_length(line: Column) -> Column:
    def step(total, i):
        a, b = F.get(line, i), F.get(line, i + 1)
        return total + distance(a["x"], a["y"], b["x"], b["y"])

    return F.aggregate(_pairs(line), F.lit(0.0), step)


def inside(px: Column, py: Column, ring: Column) -> Column:
    """Even-odd test of a point in a closed or open ring; a point on a left or lower edge counts as inside."""

    def step(odd, i):
        a, b = F.get(ring, i), F.get(ring, F.pmod(i + 1, F.size(ring)))
        crosses = (a["y"] > py) != (b["y"] > py)
        return odd != (crosses & (px < (b["x"] - a["x"]) * (py - a["y"]) / F.nullif(b["y"] - a["y"], F.lit(0.0)) + a["x"]))

    return F.aggregate(F.sequence(F.lit(0), F.size(ring) - 1), F.lit(False), lambda odd, i: F.coalesce(step(odd, i), odd))


def ring_area(ring: Column) -> Column:
    def step(total, i):
        a, b = F.get(ring, i), F.get(ring, F.pmod(i + 1, F.size(ring)))
        return total + a["x"] * b["y"] - b["x"] * a["y"]

    return F.abs(F.aggregate(F.sequence(F.lit(0), F.size(ring) - 1), F.lit(0.0), step)) / 2


def points_along(x1: Column, y1: Column, x2: Column, y2: Column, step: float) -> Column:
    """Points of a straight segment every so many units, both ends among them."""
    n = F.greatest(F.ceil(distance(x1, y1, x2, y2) / step), F.lit(1)).cast("int")
    return F.transform(F.sequence(F.lit(0), n), lambda i: F.struct((x1 + (x2 - x1) * i / n).alias("x"), (y1 + (y2 - y1) * i / n).alias("y")))


def box(x: Column, y: Column, xmin: float, ymin: float, xmax: float, ymax: float) -> Column:
    """Whether a point is in a box, its edges included."""
    return x.between(xmin, xmax) & y.between(ymin, ymax)
